"""Jaccard join of documents on word n-grams by a grouped prefix join.

Two sets of at least 85 % similarity share a shingle among the first few of each, whatever the order of shingles, as
long as it is the same for all. Rare shingles come first here, ordered by the number of documents that hold them
(counted over all documents) and by hash. Shingles of one document only can link nothing: they take their
places in the prefix but are left out of it, so that most documents have an empty prefix and are done.

Documents with the same remaining prefix and size are one group. Groups that share a prefix shingle and whose sizes allow
it are candidates; their members are expanded and verified on all shared shingles. What is connected already is
not compared again, so a family of copies costs about one comparison each, never all pairs.

Counting deals shingle hashes by their leading bits. A task cuts its documents into chunks and sends each bucket
the rest of the bits of a chunk's shingles as one block of bytes; the bucket answers the chunk with those found
in two documents or more. Connected candidates are verified in one task if their shingles fit (``Join.at_once``);
larger ones are compared with a few central members first, and what those do not connect meets all others over the
shared prefix shingles, in joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, saved
from tabguard.llm.components import components

#: Shingles hashed at once, and the most documents of a chunk.
_BLOCK, _DOCS = 1 << 16, 1 << 12


@dataclass(frozen=True)
class Join:
    """Words of a shingle, least similarity in hundredths, shingles of a chunk and of a bucket (about), shingles of
    candidates that one task verifies, and the central members that larger ones are compared with first."""

    words: int = 4
    percent: int = 85
    chunk: int = 1 << 20
    bucket: int = 1 << 20
    at_once: int = 1 << 23
    central: int = 16


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the shingles of one text."""
    parts = (text or b"").lower().split()  # bytes: A-Z only, and white space 0x20 and 0x09-0x0D only
    joined, digest = b" ".join(parts), xxhash.xxh3_64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined)] if parts else [], np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(parts) - words + 1], ends[words - 1 :]
    found = []
    for i in range(0, len(starts), _BLOCK):
        own = zip(starts[i : i + _BLOCK].tolist(), ends[i : i + _BLOCK].tolist())
        found.append(np.array([digest(joined[s:e]) for s, e in own], np.uint64))
    return np.unique(np.concatenate(found))


def _planes(values: np.ndarray) -> bytes:
    """Integers as their lowest bytes, then the next ones, and so on: high bytes, mostly zero, lie together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _values(planes: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _steps(docs: np.ndarray) -> bytes:
    return _planes(np.diff(docs, prepend=0).astype("<u2"))


def _chunk_rows(number: int, ids: list, hashes: list[np.ndarray], bits: int) -> Iterator[dict]:
    """A row with the documents of the chunk (sizes and digests of their sets), and one per bucket with their shingles:
    the steps from one shingle's document to the next one's, and the bits below the bucket's."""
    keys = b"".join(xxhash.xxh3_128_digest(h.tobytes()) for h in hashes)
    sizes = np.array([len(h) for h in hashes], "<u4")
    yield {"bucket": number % (1 << bits), "chunk": number, "ids": ids, "docs": sizes.tobytes(), "rest": keys}
    every = np.concatenate(hashes)
    bucket = (every >> np.uint64(64 - bits)).astype(np.int64)
    doc = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(bucket, kind="stable")
    rest = (every & np.uint64((1 << 64 - bits) - 1))[order]
    stops = np.searchsorted(bucket[order], np.arange(1 << bits), side="right")
    at = 0
    for b, stop in enumerate(stops.tolist()):
        if stop > at:
            yield {"bucket": b, "chunk": number, "ids": None, "docs": _steps(doc[order[at:stop]]), "rest": _planes(rest[at:stop].astype("<u8"))}
        at = stop


def _rank_code(df: np.ndarray) -> np.ndarray:
    """One byte that grows with the number of documents: eighths of its binary logarithm."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)


def _prefixes(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, n, key, grp, prefix, shared): size and digest of each set; where the prefix holds shared shingles, the
    digest of prefix and size, the prefix, and all shared shingles."""
    kind = docs.schema["doc_id"].dataType
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About six bytes a word, each of which starts a shingle.
    bits = max(8, int(octets / 6 / join.bucket).bit_length())

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, hashes, size = TaskContext.get().partitionId() << 32, [], [], 0

        def rows() -> pa.RecordBatch:
            made = list(_chunk_rows(number, ids, hashes, bits))
            lists = pa.array([r["ids"] for r in made], pa.list_(own_type))
            columns = [pa.array([r[c] for r in made], t) for c, t in (("bucket", pa.int64()), ("chunk", pa.int64()))]
            blobs = [pa.array([r[c] for r in made], pa.binary()) for c in ("docs", "rest")]
            return pa.RecordBatch.from_arrays([*columns, lists, *blobs], ["bucket", "chunk", "ids", "docs", "rest"])

        own_type = None
        for batch in batches:
            own_type = batch.column(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids.append(i)
                hashes.append(shingle_hashes(text.as_py(), join.words))
                size += len(hashes[-1])
                if size >= join.chunk or len(ids) >= _DOCS:
                    yield rows()
                    number, ids, hashes, size = number + 1, [], [], 0
        if ids:
            yield rows()

    block = f"bucket long, chunk long, ids array<{kind.simpleString()}>, docs binary, rest binary"

    def repeated(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks()
        about = rows.column("ids").is_valid().to_pylist()
        passed = rows.filter(pa.array(about)).append_column("codes", pa.nulls(sum(about), pa.binary()))
        asked = rows.filter(pa.array([not x for x in about]))
        blocks = [_values(x.as_py(), "<u8") for x in asked.column("rest")]
        if not blocks:
            return passed
        _, place, df = np.unique(np.concatenate(blocks), return_inverse=True, return_counts=True)
        df = df[place]
        kept, at = [], 0
        for i, own in enumerate(blocks):
            n = df[at : at + len(own)]
            at += len(own)
            many = n >= 2
            if many.any():
                doc = np.cumsum(_values(asked.column("docs")[i].as_py(), "<u2"), dtype=np.int64)[many]
                kept.append((i, _steps(doc), _planes(own[many]), _rank_code(n[many]).tobytes()))
        answer = asked.take(pa.array([k[0] for k in kept], pa.int64())).select(["bucket", "chunk", "ids"])
        for at, c in enumerate(("docs", "rest", "codes"), 1):
            answer = answer.append_column(c, pa.array([k[at] for k in kept], pa.binary()))
        return pa.concat_tables([passed, answer])

    def documents(table: pa.Table) -> pa.Table:
        rows = table.combine_chunks()
        about = rows.column("ids").is_valid().to_pylist().index(True)
        n = np.frombuffer(rows.column("docs")[about].as_py(), "<u4").astype(np.int64)
        keys = rows.column("rest")[about].as_py()
        doc, token, code = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
        for i in range(len(rows)):
            if i != about:
                doc.append(np.cumsum(_values(rows.column("docs")[i].as_py(), "<u2"), dtype=np.int64))
                token.append(_values(rows.column("rest")[i].as_py(), "<u8") | np.uint64(rows.column("bucket")[i].as_py() << 64 - bits))
                code.append(np.frombuffer(rows.column("codes")[i].as_py(), np.uint8))
        doc, token, code = np.concatenate(doc), np.concatenate(token), np.concatenate(code)
        order = np.lexsort((token, code, doc))
        doc, token = doc[order], token[order].view(np.int64)
        shared = np.bincount(doc, minlength=len(n))
        stops = np.cumsum(shared)
        taken = n - -(-join.percent * n // 100) + 1 - (n - shared)  # of the prefix, after the shingles found here only
        out = {"key": [], "grp": [], "prefix": [], "shared": []}
        for i in range(len(n)):
            own = token[stops[i] - shared[i] : stops[i]]
            out["key"].append(keys[16 * i : 16 * i + 16].hex() if n[i] else None)
            indexed = n[i] and taken[i] > 0 and len(own)
            first = own[: taken[i]] if indexed else None
            out["grp"].append(xxhash.xxh3_128_hexdigest(first.tobytes() + int(n[i]).to_bytes(8)) if indexed else None)
            out["prefix"].append(first)
            out["shared"].append(own if indexed else None)
        longs = pa.list_(pa.int64())
        return pa.table(
            {"doc_id": rows.column("ids")[about].values, "n": pa.array(n), "key": pa.array(out["key"], pa.string()), "grp": pa.array(out["grp"], pa.string()), "prefix": pa.array(out["prefix"], longs), "shared": pa.array(out["shared"], longs)}
        )

    sent = docs.select("doc_id", "text").mapInArrow(chunks, block)
    answers = sent.groupBy("bucket").applyInArrow(repeated, block + ", codes binary")
    return answers.groupBy("chunk").applyInArrow(
        documents, f"doc_id {kind.simpleString()}, n long, key string, grp string, prefix array<long>, shared array<long>"
    )


def _similar(inter, n_a, n_b, percent: int):
    """Whether sets of these sizes with so many shared shingles link; for numbers, arrays and Columns."""
    return 100 * inter >= percent * (n_a + n_b - inter)


def set_links(n: np.ndarray, groups: np.ndarray, prefixes: list[np.ndarray], shared: list[np.ndarray], join: Join) -> list[tuple[int, int]]:
    """A forest of the links between sets: sizes, group numbers (from 0) with their prefixes, shared shingles."""
    m = len(n)
    of_group = np.zeros(len(prefixes), np.int64)
    of_group[groups] = n
    _, prefix_token = np.unique(np.concatenate(prefixes), return_inverse=True)
    prefix_group = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    by_token = np.argsort(prefix_token, kind="stable")
    list_stop = np.cumsum(np.bincount(prefix_token))
    prefix_stop = np.cumsum([len(p) for p in prefixes])
    _, token = np.unique(np.concatenate(shared), return_inverse=True)
    sizes = np.array([len(s) for s in shared])
    stop = np.cumsum(sizes)
    owner = np.repeat(np.arange(m), sizes)[np.argsort(token, kind="stable")]
    frequency = np.bincount(token)
    posting_stop = np.cumsum(frequency)
    label = np.arange(m)
    edges: list[tuple[int, int]] = []

    def lists(numbers: np.ndarray, stops: np.ndarray, values: np.ndarray) -> np.ndarray:
        starts = np.concatenate([[0], stops])
        return np.concatenate([values[starts[t] : starts[t + 1]] for t in numbers.tolist()])

    def candidates(g: int) -> np.ndarray:
        """Groups that share a prefix shingle with ``g`` and have a size that allows a link."""
        own = prefix_token[prefix_stop[g] - len(prefixes[g]) : prefix_stop[g]]
        near = np.zeros(len(prefixes), bool)
        near[prefix_group[lists(own, list_stop, by_token)]] = True
        low, high = np.minimum(of_group, of_group[g]), np.maximum(of_group, of_group[g])
        return near & (100 * low >= join.percent * high)

    def process(x: int) -> None:
        others = candidates(groups[x])[groups] & (label != label[x])
        if not others.any():
            return
        inter = np.bincount(lists(token[stop[x] - sizes[x] : stop[x]], posting_stop, owner), minlength=m)
        for y in np.flatnonzero(others & _similar(inter, n[x], n, join.percent)).tolist():
            if label[y] != label[x]:
                edges.append((x, y))
                label[label == label[y]] = label[x]

    centrality = np.add.reduceat(frequency[token], stop - sizes) / n
    first = np.argsort(-centrality, kind="stable")[: join.central].tolist()
    for x in first:
        process(x)
    done = set(first)
    # Pairs within the largest part need no look, and of all others one side is outside of it.
    largest = np.bincount(label).argmax()
    member = int(np.flatnonzero(label == largest)[0])
    for x in np.flatnonzero(label != largest).tolist():
        if x not in done and label[x] != label[member]:
            process(x)
    return edges


def _verified(sets: DataFrame, join: Join) -> DataFrame:
    """(root, key, n, grp, prefix, shared) -> links (a, b) between keys, each root in one task."""

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        _, at = np.unique(t.column("key").to_numpy(zero_copy_only=False).astype(str), return_index=True)
        t = t.take(pa.array(at)).combine_chunks()
        keys = t.column("key").to_pylist()
        _, first, groups = np.unique(t.column("grp").to_numpy(zero_copy_only=False).astype(str), return_index=True, return_inverse=True)
        arrays = {c: [x.values.to_numpy() for x in t.column(c)] for c in ("prefix", "shared")}
        prefixes = [arrays["prefix"][i] for i in first]
        edges = set_links(t.column("n").to_numpy(), groups, prefixes, arrays["shared"], join) if len(keys) > 1 else []
        return pa.table({"a": pa.array([keys[x] for x, _ in edges], pa.string()), "b": pa.array([keys[y] for _, y in edges], pa.string())})

    return sets.groupBy("root").applyInArrow(run, "a string, b string")


def _linked_in_joins(sets: DataFrame, join: Join) -> DataFrame:
    """Links of candidates that are too many for one task; ``sets`` has one row per key."""
    # Sets with hardly a shingle of their own are those that others were copied from.
    order = Window.partitionBy("root").orderBy(F.desc(F.size("shared") / F.col("n")), "key")
    ranked = sets.withColumn("place", F.row_number().over(order)).where(F.col("place") <= join.central)
    inter = F.size(F.array_intersect("shared", "shared_a"))
    linked = _similar(inter, F.col("n"), F.col("n_a"), join.percent)
    met = sets.join(ranked.select("root", *[F.col(c).alias(a) for c, a in _LEFT.items()]), "root")
    star = saved(met.where((F.col("key") != F.col("a")) & linked).select("a", F.col("key").alias("b")), "star-links")
    found = components(star).select(F.col("node").alias("key"), F.col("root").alias("label"))
    labelled = saved(sets.join(found, "key", "left").withColumn("label", F.coalesce("label", "key")), "labelled")
    sizes = labelled.groupBy("root", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("size", "label")).alias("most")).select("root", F.col("most.label").alias("largest"))
    listed = labelled.join(largest, "root").select("key", "n", "label", (F.col("label") != F.col("largest")).alias("outside"), F.explode("prefix").alias("token"))
    # Of two sets that are not connected yet, one at least is outside of the largest part.
    a, b = listed.where("outside").alias("a"), listed.alias("b")
    sized = 100 * F.least("a.n", "b.n") >= join.percent * F.greatest("a.n", "b.n")
    once = ~F.col("b.outside") | (F.col("a.key") < F.col("b.key"))
    pairs = a.join(b, "token").where((F.col("a.label") != F.col("b.label")) & once & sized)
    pairs = pairs.select(F.col("a.key").alias("a"), F.col("b.key").alias("b")).distinct()
    left = labelled.select(*[F.col(c).alias(a) for c, a in _LEFT.items()])
    right = labelled.select(F.col("key").alias("b"), "n", "shared")
    return star.unionByName(pairs.join(left, "a").join(right, "b").where(linked).select("a", "b"))


_LEFT = {"key": "a", "n": "n_a", "shared": "shared_a"}


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles (size of its set), component_id (smallest doc_id reachable over links).

    Words are what lies between blanks (0x20, 0x09-0x0D), A-Z lower-cased; fewer words than a shingle has are one shingle.
    Null texts and texts without words have no shingle and are linked with nothing, not with each other either.
    Equal texts are linked; equal ids are rows of their own; a null id counts as no id: its row gets the smallest id of its
    component, null if that has none. Other columns are ignored. An empty input gives an empty result. Shingles are
    compared by 64-bit hashes.
    """
    prints = saved(_prefixes(keyed(docs, doc_id=id_col, text=text_col), join), "prints")
    indexed = prints.where(F.col("grp").isNotNull())
    listed = indexed.select("grp", "prefix").dropDuplicates(["grp"]).select("grp", F.explode("prefix").alias("token"))
    hubs = listed.groupBy("token").agg(F.min("grp").alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
    near = components(listed.join(hubs, "token").where("grp != hub").select(F.col("grp").alias("a"), F.col("hub").alias("b")).distinct())
    members = indexed.select("key", "grp", F.size("shared").alias("size")).dropDuplicates(["key"])
    members = members.join(near.withColumnRenamed("node", "grp"), "grp", "left").withColumn("root", F.coalesce("root", "grp"))
    totals = members.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("total")).where("sets > 1")
    places = saved(members.join(totals, "root").select("grp", "root", "total").dropDuplicates(["grp"]), "places")
    sets = indexed.join(places, "grp").select("root", "key", "n", "grp", "prefix", "shared", "total")
    links = _verified(sets.where(F.col("total") <= join.at_once), join)
    if not places.where(F.col("total") > join.at_once).isEmpty():
        links = links.unionByName(_linked_in_joins(saved(sets.where(F.col("total") > join.at_once).dropDuplicates(["key"]), "large"), join))
    roots = components(saved(links, "links")).withColumnRenamed("node", "key")
    least = prints.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
    placed = least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    whole = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(whole, "root").select("key", "component")
    found = prints.select("doc_id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
