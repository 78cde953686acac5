"""Compression of vectors to short codes by ball k-means on their parts.

A vector is cut into equal consecutive parts; each part position has a codebook, and a part is coded by its
codebook's nearest entry. Components are integers, so every distance, sum and tie is exact.

An entry and the parts assigned to it are a ball: its radius is the distance of its farthest part. Only entries at
most two radii away are neighbours of the ball. A part at distance r of its own entry can move to an entry at most
2 r away from that one, so parts within half the way to the nearest neighbour (the stable core) are not compared at
all, and others with the neighbours of their ring only: those whose distance from the own entry is at most 2 r. The
first assignment has no balls yet and compares with all entries.

The codebooks (parts x entries x width integers) are a parameter-sized table and go to the tasks; vectors stay in
their partitions: each round reads them, writes them with their codes, and adds up one row per task and entry.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, saved

#: Parts compared with candidate entries at once.
_BLOCK = 1 << 13


@dataclass(frozen=True)
class Codec:
    """Production parameters: parts of a vector, entries of a codebook, rounds of moving the entries, and the factor
    that makes integers of components."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


class Balls:
    """One part position's entries with their neighbours, nearest first.

    ``reach`` holds for each entry a number not below the squared distance of its farthest part.
    """

    def __init__(self, entries: np.ndarray, reach: np.ndarray):
        between = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(between, np.iinfo(np.int64).max)
        self.entries = entries
        # dist <= 2 r, squared; the quotient cannot overflow where the product could
        near = (between + 3) // 4 <= reach[:, None]
        self.order = [np.flatnonzero(near[i])[np.argsort(between[i][near[i]], kind="stable")] for i in range(len(entries))]
        self.apart = [between[i][o] for i, o in enumerate(self.order)]

    def assign(self, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of each point that was at ``home``, and how many distances were computed."""
        best = ((points - self.entries[home]) ** 2).sum(axis=1)
        code, compared = home.copy(), len(points)
        ring = np.zeros(len(points), np.int64)
        for i in np.unique(home):
            own = np.flatnonzero(home == i)
            ring[own] = np.searchsorted(self.apart[i], 4 * best[own], side="right")
        for i in np.unique(home[ring > 0]):
            moving = np.flatnonzero((home == i) & (ring > 0))
            moving = moving[np.argsort(ring[moving], kind="stable")]  # parts of like rings share a block
            for at in range(0, len(moving), _BLOCK):
                block = moving[at : at + _BLOCK]
                n = ring[block]
                row = np.repeat(np.arange(len(block)), n)
                first = np.cumsum(n) - n
                entry = self.order[i][np.arange(len(row)) - first[row]]
                d = ((points[block[row]] - self.entries[entry]) ** 2).sum(axis=1)
                least = np.minimum.reduceat(d, first)
                which = np.minimum.reduceat(np.where(d == least[row], entry, len(self.entries)), first)
                better = (least < best[block]) | ((least == best[block]) & (which < i))
                code[block[better]], best[block[better]] = which[better], least[better]
                compared += len(row)
        return code, best, compared


def nearest_of_all(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) with every entry compared; ties to the lower index."""
    codes, best = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for at in range(0, len(points), _BLOCK):
        d = ((points[at : at + _BLOCK, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        codes[at : at + _BLOCK] = d.argmin(axis=1)
        best[at : at + _BLOCK] = d.min(axis=1)
    return codes, best


def _whole(rows: DataFrame, codec: Codec) -> tuple[DataFrame, int]:
    """(vec_id, label, v) with integer components as doubles, and the padded length of the vectors."""
    rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull()).where(finite)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    length = common.d if common else 0
    padded = max(1, -(-length // codec.parts)) * codec.parts
    limit = math.isqrt((1 << 62) // (4 * padded))
    scaled = F.transform("v", lambda x: F.floor(x * float(codec.scale)).cast("double"))
    small = F.forall("v", lambda x: F.abs(x) * float(codec.scale) < float(limit))
    kept = rows.where(F.size("v") == length).where(small)
    fill = F.array_repeat(F.lit(0.0), padded - length)
    return kept.select("vec_id", "label", F.concat(scaled, fill).alias("v")), padded


def _points(column: pa.Array, parts: int) -> np.ndarray:
    """Arrow lists of doubles -> integers (rows x parts x width)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), parts, -1)


def _coded(state: DataFrame, codebooks: np.ndarray, reach: np.ndarray | None) -> DataFrame:
    """``state`` with the codes of the nearest entries and their squared distances per part."""
    parts = len(codebooks)
    sent = state.sparkSession.sparkContext.broadcast((codebooks, reach))
    label = state.schema["label"].dataType.simpleString()
    vec_id = state.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, far = sent.value
        balls = None if far is None else [Balls(books[p], far[p]) for p in range(parts)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch.column(2), parts)
            codes, gaps = np.empty((len(x), parts), np.int64), np.empty((len(x), parts), np.int64)
            before = None if balls is None else np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u2").reshape(len(x), parts).astype(np.int64)
            for p in range(parts):
                if balls is None:
                    codes[:, p], gaps[:, p] = nearest_of_all(x[:, p], books[p])
                else:
                    codes[:, p], gaps[:, p], _ = balls[p].assign(x[:, p], before[:, p])
            packed = [row.tobytes() for row in codes.astype("<u2")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(list(gaps), pa.list_(pa.int64()))],
                ["vec_id", "label", "v", "codes", "gaps"],
            )

    columns = ["vec_id", "label", "v"] + ([] if reach is None else ["codes"])
    return state.select(*columns).mapInArrow(run, f"vec_id {vec_id}, label {label}, v array<double>, codes binary, gaps array<long>")


def _moved(state: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries moved to the floored means of their parts, and a bound of each entry's reach after the move."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(parts * entries, np.int64)
        far = np.zeros(parts * entries, np.int64)
        total = np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _points(batch.column(0), parts).reshape(-1, width)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, parts).astype(np.int64)
            place = (codes + entries * np.arange(parts)).ravel()
            gaps = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            n += np.bincount(place, minlength=parts * entries)
            np.maximum.at(far, place, gaps)
            np.add.at(total, place, x)
        used = np.flatnonzero(n)
        arrays = [pa.array(used), pa.array(n[used]), pa.array(far[used]), pa.array(list(total[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["place", "n", "far", "total"])

    parts_sums = state.select("v", "codes", "gaps").mapInArrow(run, "place long, n long, far long, total array<long>")
    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    after = codebooks.copy()
    reach = np.full((parts, entries), -1, np.int64)
    for r in parts_sums.groupBy("place").agg(F.sum("n").alias("n"), F.max("far").alias("far"), *sums).collect():
        p, e = divmod(r.place, entries)
        after[p, e] = [int(r[f"s{i}"]) // r.n for i in range(width)]
        step = int(((after[p, e] - codebooks[p, e]) ** 2).sum())
        bound = math.isqrt(r.far) + 1 + math.isqrt(step) + 1
        reach[p, e] = min(bound * bound, np.iinfo(np.int64).max)
    return after, reach


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", codec: Codec = Codec()
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the final codebooks (parts x entries x width).

    Rows (vec_id, label, codes array<int>, error): the entry of each part and the squared distances summed. Codebooks
    start as the parts of the vectors with the smallest ids (of equal ids, the smaller vectors; null ids last); with
    fewer vectors than entries, the codebooks are as small. Ties go to the lower entry. Vectors that are null or
    hold null or non-finite components take no part, nor do those of another length than most, or with components so
    large that a squared distance could pass a long (for 64 components: half a million). Lengths that the parts do
    not divide are filled up with zeros. Repeated rows and ids count as rows of their own; other columns are ignored.
    An empty input gives an empty result.
    """
    rows, length = _whole(keyed(vectors, vec_id=id_col, v=vector_col, label=label_col), codec)
    state = saved(rows, "vectors")
    first = state.orderBy(F.col("vec_id").isNull(), "vec_id", "v").limit(codec.entries).select("v").collect()
    start = np.array([r.v for r in first], np.float64).reshape(len(first), codec.parts, length // codec.parts)
    books, reach = start.astype(np.int64).transpose(1, 0, 2).copy(), None
    if len(first):
        for _ in range(codec.rounds):
            state = saved(_coded(state, books, reach), "coded")
            books, reach = _moved(state, books)
        state = saved(_coded(state, books, reach).drop("v"), "codes")
    else:
        state = state.select("vec_id", "label", F.lit(b"").alias("codes"), F.array().cast("array<long>").alias("gaps"))
    # two bytes a part, low byte first
    octets = F.transform(F.sequence(F.lit(0), F.lit(codec.parts - 1)), lambda p: F.conv(F.hex(F.substring(F.col("codes"), p * 2 + 2, 1)), 16, 10).cast("int") * 256 + F.conv(F.hex(F.substring(F.col("codes"), p * 2 + 1, 1)), 16, 10).cast("int"))
    return state.select("vec_id", "label", octets.alias("codes"), F.aggregate("gaps", F.lit(0).cast("long"), lambda s, x: s + x).alias("error")), books


def code_digests(vectors: DataFrame, codec: Codec = Codec()) -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256): codes as two hex digits a part, the error summed over
    equal labels (nulls together), and a digest of the final entries. See ``compress`` for odd rows."""
    coded, books = compress(vectors, codec=codec)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    hexes = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    per_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    named = coded.join(per_label, F.col("label").eqNullSafe(F.col("of")))
    return named.select("vec_id", F.array_join(hexes, "").alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
