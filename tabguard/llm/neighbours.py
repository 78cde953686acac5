"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives every vector a long hash string: digits of seven bits, each the signed axis of a random rotation that
the vector lies closest to. Sorted by string, vectors under a common prefix lie together, and a longer common prefix
means a closer match. Queries descend to their longest-prefix matches and ascend in all trees at once: first to the
depth at which a bounded sample of queries finds its true neighbours, further while a query has too few candidates,
at last to the root, which holds all vectors.

Equal vectors are one entry with their smallest ids. Blocks under a prefix are cut into chunks of bounded size; every
query of a block is compared with every vector of it, and each chunk gives only its best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, saved

#: Axes of a digit (two signs each) and its bits.
_AXES, _DIGIT = 64, 7


@dataclass(frozen=True)
class Forest:
    """Production parameters. ``sample`` bounds the query vectors that the depth is fitted on."""

    trees: int = 24
    digits: int = 4
    seed: int = 11
    sample: int = 256
    recall: float = 0.95
    chunk: int = 4096

    @property
    def bits(self) -> int:
        return self.digits * _DIGIT

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings (rows x trees) as integers of ``bits`` bits."""
        x = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
        out = np.zeros((len(x), self.trees), np.int64)
        for tree in range(self.trees):
            for digit in range(self.digits):
                axes = np.random.default_rng((self.seed, tree, digit)).standard_normal((x.shape[1], _AXES), np.float32)
                turned = x @ axes
                axis = np.abs(turned).argmax(axis=1)
                sign = turned[np.arange(len(x)), axis] > 0
                out[:, tree] = out[:, tree] << _DIGIT | axis << 1 | sign
        return out


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of vectors without null and non-finite components that are not zero, of the commonest length."""
    rows = keyed(vectors, vec_id=id_col, v=vector_col).select("vec_id", F.col("v").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull())
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (length.d if length else 0))


def inner_product(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _best(scores: np.ndarray, k: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best scores of each row.

    With the smallest ids ``first`` of the columns also those that are the k best if scores that differ by rounding only
    count as ties, which go to the smaller id; so a row has at most 2 k, however many tie.
    """
    if scores.shape[1] <= k:
        return np.nonzero(np.ones(scores.shape, bool))
    chosen = np.zeros(scores.shape, bool)
    np.put_along_axis(chosen, np.argpartition(-scores, k - 1, axis=1)[:, :k], True, axis=1)
    if first is not None:
        by_id = np.argsort(first, kind="stable")
        rounded = np.round(scores[:, by_id], 10)
        # Of equal rounded scores a stable sort leaves the smaller ids in front.
        places = by_id[np.argsort(-rounded, axis=1, kind="stable")[:, :k]]
        np.put_along_axis(chosen, places, True, axis=1)
    return np.nonzero(chosen)


def _fitted_depth(entries: DataFrame, f: Forest, k: int) -> int:
    """The deepest prefix at which the sampled queries share a tree's prefix with at least ``recall`` of their true
    neighbours, all vectors searched for those."""
    sample = entries.where("is_query").orderBy(F.xxhash64("key"), "key").select("key", "v").limit(f.sample).collect()
    if not sample:
        return 0
    q = np.array([r.v for r in sample])
    shared = entries.sparkSession.sparkContext.broadcast((q, [r.key for r in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, keys = shared.value
        rows: list[tuple[int, float, list]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            scores = asked @ x.T
            own = pc.index_in(batch.column(0), pa.array(keys)).to_numpy(zero_copy_only=False)
            itself = np.flatnonzero(~np.isnan(own.astype(np.float64)))
            scores[own[itself].astype(np.int64), itself] = -np.inf  # a query is no neighbour of its own
            i, j = _best(scores, k)
            rows += [(a, float(scores[a, b]), x[b].tolist()) for a, b in zip(i.tolist(), j.tolist())]
            if len(rows) > 4 * k * len(asked):
                rows = _trimmed(rows, k)
        rows = _trimmed(rows, k)
        cols = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.list_(pa.float64()))], ["q", "score", "v"])

    near = entries.select("key", "v").mapInArrow(run, "q int, score double, v array<double>")
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where((F.col("r") <= k) & (F.col("score") > float("-inf"))).collect()
    if not top:
        return 0
    diff = f.codes(q)[[r.q for r in top]] ^ f.codes(np.array([r.v for r in top]))
    depth = np.where(diff > 0, f.bits - 1 - np.floor(np.log2(np.maximum(diff, 1))), f.bits).max(axis=1)
    return int(np.quantile(depth, 1 - f.recall, method="lower"))


def _trimmed(rows: list, k: int) -> list:
    kept: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: -r[1]):
        own = kept.setdefault(r[0], [])
        if len(own) < k:
            own.append(r)
    return [r for own in kept.values() for r in own]


def _ascend(hashed: DataFrame, wanted: DataFrame | None, depth: int, f: Forest, k: int) -> DataFrame:
    """(q, key, score): the best entries that share ``depth`` bits with a query in a tree, for the wanted queries."""
    trees = F.posexplode("codes").alias("tree", "code") if depth else F.posexplode(F.slice("codes", 1, 1)).alias("tree", "code")
    prefix = F.expr(f"shiftright(code, {f.bits - depth})").alias("prefix")
    entries = hashed.select("key", "first", "v", trees).select("tree", prefix, "key", "first", "v")
    asking = hashed.where("is_query") if wanted is None else hashed.join(wanted, "key", "left_semi")
    queries = asking.select("key", "first", "v", trees).select("tree", prefix, "key", "first", "v")
    sizes = entries.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n"))
    asks = queries.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("m"))
    blocks = saved(
        sizes.join(asks, ["tree", "prefix"]).select(
            "tree", "prefix", F.ceil(F.col("n") / f.chunk).cast("int").alias("cuts"), F.ceil(F.col("m") / f.chunk).cast("int").alias("rounds")
        ),
        "blocks",
    )

    def dealt(rows: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        # a row has one place among the cuts of its own side and goes to every cut of the other side
        placed = rows.join(blocks, ["tree", "prefix"])
        place = F.pmod(F.xxhash64("key"), F.col(own)).cast("int")
        everywhere = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return placed.select("tree", "prefix", "key", "first", "v", place.alias(own[0]), everywhere.alias(other[0]), F.lit(is_query).alias("asks"))

    cells = dealt(entries, "cuts", "rounds", False).unionByName(dealt(queries, "rounds", "cuts", True))

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
        keys, first = table.column("key").combine_chunks(), table.column("first").to_numpy()
        v = _matrix(table.column("v").combine_chunks())
        q, e = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = []
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            scores = v[part] @ v[e].T
            i, j = _best(scores, k, first[e])
            out.append(pa.table({"q": keys.take(pa.array(part[i])), "key": keys.take(pa.array(e[j])), "first": first[e[j]], "score": pa.array(scores[i, j])}))
        empty = pa.table({"q": pa.array([], keys.type), "key": pa.array([], keys.type), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.concat_tables(out) if out else empty

    return cells.groupBy("tree", "prefix", "c", "r").applyInArrow(compare, "q string, key string, first long, score double")


def search(
    vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, forest: Forest = Forest()
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score (inner product in double precision).

    Queries are the rows whose id is divisible by ``every``; candidates all rows with another id. Ties go to the smaller
    id. Vectors that are null, zero, of another length than most, or hold null or non-finite components take no
    part, nor do rows with null ids. Repeated ids count as rows of their own, except that none is a neighbour of its
    own id. Fewer candidates than ``k`` give fewer rows; an empty input gives an empty result. Other columns are ignored.
    """
    rows = _usable(vectors, id_col, vector_col)
    rows = rows.withColumn("key", F.concat(F.hex(F.xxhash64("v")), F.lit("-"), F.hex(F.xxhash64(F.lit(3), F.col("v")))))
    smallest = Window.partitionBy("key").orderBy("vec_id")
    ids = (
        rows.select("key", "vec_id").withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1)
        .groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    asks = (F.col("vec_id") % every == 0)
    entries = saved(rows.groupBy("key").agg(F.any_value("v").alias("v"), F.bool_or(asks).alias("is_query"), F.min("vec_id").cast("long").alias("first")), "entries")
    top = k + 1

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = forest.codes(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(codes), pa.list_(pa.int64()))], ["key", "v", "is_query", "first", "codes"])

    hashed = saved(entries.mapInArrow(hash_all, "key string, v array<double>, is_query boolean, first long, codes array<long>"), "hashed")
    depth = _fitted_depth(entries, forest, k)
    found, wanted = None, None
    while True:
        step = saved(_ascend(hashed, wanted, depth, forest, top).groupBy("q", "key").agg(F.max("score").alias("score"), F.min("first").alias("first")), "candidates")
        found = step if found is None else found.unionByName(step)
        if depth == 0:
            break
        enough = found.select("q", "key").distinct().groupBy("q").count().where(F.col("count") > k).select(F.col("q").alias("key"))
        wanted = saved(hashed.where("is_query").select("key").join(enough, "key", "left_anti"), "wanted")
        if wanted.isEmpty():
            break
        depth //= 2
    # Scores of tasks differ by rounding; the best by them, and the best if close ones are ties, hold the best by exact ones.
    orders = [Window.partitionBy("q").orderBy(*c) for c in ([F.desc("score")], [F.desc(F.round("score", 10)), F.col("first")])]
    close = found.groupBy("q", "key").agg(F.max("score").alias("score"), F.min("first").alias("first"))
    close = close.withColumns({f"r{i}": F.row_number().over(o) for i, o in enumerate(orders)}).where((F.col("r0") <= top) | (F.col("r1") <= top))
    close = close.select("q", "key")
    a = entries.select(F.col("key").alias("q"), F.col("v").alias("qv"))
    scored = close.join(a, "q").join(entries.select("key", "v"), "key").join(ids, "key").select("q", inner_product("qv", "v").alias("score"), F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    scored = scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top).drop("r")
    queries = rows.where(asks).select(F.col("vec_id").alias("query_id"), F.col("key").alias("q")).distinct()
    per_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    final = queries.join(scored, "q").where("vec_id != query_id").withColumn("rank", F.row_number().over(per_query))
    return final.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
