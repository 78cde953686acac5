"""SimHash near-duplicates: 64-bit fingerprints linked at a few differing bits, found by anchor points.

The anchors are the words of a covering code. A fingerprint of 64 bits is seen as two halves; of two
fingerprints that differ in at most three bits, one half differs in at most one. Per half the code is a perfect
Hamming code on 31 bits times the free last bit: covering radius one, 2**27 anchors. A half has one home anchor
(within the radius) and is replicated to each of the 17 or fewer anchors within radius plus one, where it meets
every half whose home that anchor is and that differs in at most one bit. Whole fingerprints are compared there,
so no link is lost and none is invented.

Only distinct fingerprints are replicated, and an anchor gives a forest of its links, never all pairs. Anchors
that are home to very many fingerprints are dealt out as a grid of cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabguard.llm.common import fresh, keyed, parallelism, saved
from tabguard.llm.components import components

SEED = 42
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 16
#: Homes of one anchor that are compared in one cell.
CELL = 2048
#: Candidate pairs compared at once in a task.
_PAIRS = 1 << 21


def text_fingerprint(text: bytes | None, words: int = 3) -> int:
    """The fingerprint of one text: majority of the shingle hashes per bit, zero without words."""
    parts = (text or b"").lower().split()  # bytes: A-Z only, and white space 0x20 and 0x09-0x0D only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(parts) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), _BLOCK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i : i + _BLOCK], ends[i : i + _BLOCK])], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Rows (doc_id, text_hash, fp): the fingerprint as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            values = np.fromiter((text_fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(values.view(np.int64))], ["doc_id", "text_hash", "fp"])

    source = keyed(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _syndromes() -> np.ndarray:
    """For each byte place of a half and each byte value, the xor of the numbers (1 to 31) of its set bits."""
    table = np.zeros((4, 256), np.uint8)
    for place in range(4):
        for value in range(256):
            for bit in range(8):
                number = 8 * place + bit + 1
                if value >> bit & 1 and number <= 31:
                    table[place, value] ^= number
    return table


_SYNDROMES = _syndromes()


def home_anchor(halves: np.ndarray) -> np.ndarray:
    """The code word within one bit of each 32-bit half."""
    octets = np.ascontiguousarray(halves.astype("<u4")).view(np.uint8).reshape(*halves.shape, 4)
    s = _SYNDROMES[0][octets[..., 0]] ^ _SYNDROMES[1][octets[..., 1]] ^ _SYNDROMES[2][octets[..., 2]] ^ _SYNDROMES[3][octets[..., 3]]
    flip = np.where(s > 0, np.uint32(1) << (np.maximum(s, 1).astype(np.uint32) - np.uint32(1)), np.uint32(0))
    return halves ^ flip


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp) -> (anchor, fp, home): the anchor carries the half's number above its 32 bits."""
    masks = np.concatenate([[0], 1 << np.arange(32)]).astype(np.uint32)
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 14):
            fps = batch.column(0).slice(at, 1 << 14).to_numpy(zero_copy_only=False).view(np.uint64)
            for half in (0, 1):
                part = (fps >> np.uint64(32 * half)).astype(np.uint32)
                near = home_anchor(part[:, None] ^ masks[None, :])
                home = near[:, 0].copy()
                near.sort(axis=1)
                first = np.ones(near.shape, bool)
                first[:, 1:] = near[:, 1:] != near[:, :-1]
                row, _ = np.nonzero(first)
                anchors = near[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors.astype(np.int64) | np.int64(half << 32)),
                        pa.array(fps[row].view(np.int64)),
                        pa.array(anchors == home[row]),
                    ],
                    ["anchor", "fp", "home"],
                )


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges with the smallest node of its component, where they differ."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links(limit: int):
    """Rows (anchor, cell, fp, home), sorted with homes first in a cell -> a forest of the links as edges."""

    def linked(keys: np.ndarray, fps: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(fps))))
        homes = np.bincount(run, weights=home, minlength=len(starts)).astype(np.int64)
        per_row = homes[run]
        done = 0
        ends = np.cumsum(per_row)
        while done < len(fps):
            base = ends[done - 1] if done else 0
            stop = max(done + 1, int(np.searchsorted(ends, base + _PAIRS, side="right")))
            n = per_row[done:stop]
            row = np.repeat(np.arange(done, stop), n)
            other = starts[run[row]] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            near = (np.bitwise_count(fps[row] ^ fps[other]) <= limit) & (fps[row] != fps[other])
            if near.any():
                yield fps[row[near]], fps[other[near]]
            done = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # the homes of the cell that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            home = batch.column(3).to_numpy(zero_copy_only=False)
            if carry is not None and (carry[0] == keys[0]).all():
                n = len(carry[1])
                keys = np.concatenate([np.repeat(keys[:1], n, axis=0), keys])
                fps, home = np.concatenate([carry[1], fps]), np.concatenate([np.ones(n, bool), home])
            last = (keys == keys[-1]).all(axis=1) & home
            carry = (keys[-1].copy(), fps[last].copy())
            for a, b in linked(keys, fps, home):
                node, root = _forest(a.view(np.int64), b.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return run


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = 3, cell: int = CELL) -> DataFrame:
    """Edges (a, b) that join all fingerprints (column fp, distinct) linked at ``max_bits`` or fewer bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with one differing bit each cover at most three bits")
    spark = distinct_fps.sparkSession
    placed = distinct_fps.select("fp").mapInArrow(_replicas, "anchor long, fp long, home boolean")
    crowded = (
        placed.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
        .select("anchor", F.ceil(F.col("n") / cell).cast("int").alias("k"))
    )
    dealt = placed.join(crowded, "anchor", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("k"))
    grid = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i")
    # A home lies in one row of the grid and a visitor in one column; homes visit each other, too.
    split = dealt.where("k > 1")
    rows = split.where("home").select("anchor", "fp", "home", own.alias("own"), "k", grid)
    visits = split.select("anchor", "fp", own.alias("own"), "k", grid)
    cells = (
        dealt.where("k = 1").select("anchor", F.lit(0).cast("long").alias("cell"), "fp", "home")
        .unionByName(rows.select("anchor", (F.col("own") * F.col("k") + F.col("i")).cast("long").alias("cell"), "fp", "home"))
        .unionByName(
            visits.select("anchor", (F.col("i") * F.col("k") + F.col("own")).cast("long").alias("cell"), "fp", F.lit(False).alias("home"))
        )
    )
    ordered = cells.repartition(parallelism(spark), "anchor", "cell").sortWithinPartitions("anchor", "cell", F.desc("home"))
    return ordered.mapInArrow(_links(max_bits), "a long, b long")


def _components_of(prints: DataFrame, max_bits: int, cell: int) -> DataFrame:
    """(fp, component_id, best): of each distinct fingerprint's component the smallest id, and the row that stands
    for it (ids before null, then the smallest text hash)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best")
    classes = prints.groupBy("fp").agg(first)
    roots = components(fingerprint_links(classes, max_bits, cell))
    placed = classes.join(roots, classes.fp == roots.node, "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("best").alias("best"))
    return placed.drop("best").join(least, "root").select("fp", F.col("best.doc_id").alias("component_id"), "best")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3, cell: int = CELL
) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Null and empty texts and texts without words have fingerprint zero and are linked like others. Rows with equal
    ids or equal texts each give a row. A null id counts as no id: its row gets the smallest id of its component,
    null if that has none. Other columns of the input are ignored. An empty input gives an empty result.
    """
    prints = saved(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = prints.join(_components_of(prints, max_bits, cell), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3, cell: int = CELL) -> DataFrame:
    """One row of ``docs``, all columns, of each component: that with the smallest id; of several such rows, or in a
    component without ids, that with the smallest hash of its text; of rows equal in both any one. Null and empty texts
    are linked like others, further columns may have any name, and an empty input gives an empty result."""
    prints = saved(fingerprints(docs, id_col, text_col), "fingerprints")
    id_name, hash_name, own_name, place = fresh(docs, "best_id", "best_hash", "own_hash", "place")
    kept = _components_of(prints, max_bits, cell).select(F.col("best.doc_id").alias(id_name), F.col("best.text_hash").alias(hash_name)).distinct()
    own_id, own_hash = F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    rows = docs.withColumn(own_name, own_hash)
    rows = rows.join(kept, own_id.eqNullSafe(F.col(id_name)) & (F.col(own_name) == F.col(hash_name)), "left_semi")
    equal = Window.partitionBy(own_id, own_name).orderBy(own_name)
    once = rows.withColumn(place, F.row_number().over(equal)).where(F.col(place) == 1)
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
