"""Line deduplication with two Bloom filters.

One pass over the documents fills a filter of hashes seen once and a filter of hashes seen twice; the filters of
all tasks are merged (seen once by two tasks is seen twice). A second pass tests every line against the second
filter: a line that it does not hold occurs in one document only and never moves. The others are shuffled,
counted exactly, and the confirmed repeats are joined back to their documents.

The filter has eight bits or more for each line that can be long enough, up to a size that can be sent to every task.
Beyond that size nothing is sent: the hashes of lines, not the lines, are shuffled and counted, and the suspects follow
from the hashes counted twice. Filters have no false negatives, so results are the same either way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import fresh, keyed, numbered, parallelism, saved

#: Segments of a filter (the first 8 bits of a hash).
SEGMENTS = 256
#: Filters have 2**LEAST_BITS bits (16 KB) or more; one of more than 2**MOST_BITS (64 MB) is not sent to the tasks.
LEAST_BITS, MOST_BITS = 17, 29
BITS_PER_LINE = 8
#: A key with more than this part of all repeats is hot; there are fewer than this number of them.
HOT_PART = 1024
#: Odd numbers that mix a hash anew for each of its three bits.
_MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_BLANK = b" \t\n\x0b\x0c\r"
#: Hashes that are put into a filter at once.
_BLOCK = 1 << 18


def line_key(line: bytes) -> bytes:
    """The line without white space (0x20, 0x09-0x0D) at its ends, A-Z lower-cased."""
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= least


def keys_of(text: bytes | None, least: int) -> set[bytes]:
    """The distinct keys of at least ``least`` code points in one text."""
    if not text:
        return set()
    return {k for k in map(bytes.strip, text.lower().split(b"\n")) if _long_enough(k, least)}


def line_bound(docs: DataFrame, least: int) -> int:
    """An upper bound of the lines of at least ``least`` code points in the column text, copies counted."""
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    most = F.least(lines, F.floor(F.length("text") / F.lit(max(1, least))))
    return docs.agg(F.coalesce(F.sum(most.cast("long")), F.lit(0)).alias("n")).first().n


def filter_bits(n_lines: int) -> int:
    """Binary logarithm of the bits of a filter made for so many lines."""
    return max(LEAST_BITS, (BITS_PER_LINE * n_lines - 1).bit_length())


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte places and bit masks (three per hash) in a filter of 2**bits bits."""
    own = bits - 8
    base = (hashes >> np.uint64(56)) << np.uint64(own)
    found = np.stack([base | ((hashes * np.uint64(m)) >> np.uint64(64 - own)) for m in _MIXERS], axis=1)
    return (found >> np.uint64(3)).astype(np.int64), np.uint8(1) << (found & np.uint64(7)).astype(np.uint8)


class TwoFilters:
    """Bloom filters, of 2**bits bits each, of the hashes added once and of those added twice or more."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once = np.zeros(1 << (bits - 3), np.uint8)
        self.twice = np.zeros(1 << (bits - 3), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for at in range(0, len(hashes), _BLOCK):
            values, counts = np.unique(hashes[at : at + _BLOCK], return_counts=True)
            place, bit = _places(values, self.bits)
            again = (counts > 1) | holds(self.once, values)
            np.bitwise_or.at(self.twice, place[again].ravel(), bit[again].ravel())
            np.bitwise_or.at(self.once, place.ravel(), bit.ravel())

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = len(self.once) // SEGMENTS
        for i in range(SEGMENTS):
            own = slice(i * size, (i + 1) * size)
            if self.once[own].any():
                yield i, zlib.compress(self.once[own].tobytes(), 1), zlib.compress(self.twice[own].tobytes(), 1)


def holds(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    place, bit = _places(hashes, (8 * len(filter_bytes)).bit_length() - 1)
    return ((filter_bytes[place] & bit) == bit).all(axis=1)


def _hashes(keys) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(k) for k in keys), np.uint64)


_FILTER = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _filter_rows(rows) -> pa.RecordBatch:
    a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.binary()), pa.array(c, pa.binary())], schema=_FILTER)


def seen_twice(docs: DataFrame, least: int, bits: int) -> bytes:
    """The merged filter (2**bits bits) of line keys that occur in two or more rows of ``docs`` (column text)."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = TwoFilters(bits)
        for batch in batches:
            waiting: list[np.ndarray] = []
            size = 0
            for text in batch.column(0).cast(pa.binary()):
                own = _hashes(keys_of(text.as_py(), least))
                waiting.append(own)
                size += len(own)
                if size >= _BLOCK:
                    filters.add(np.concatenate(waiting))
                    waiting, size = [], 0
            if waiting:
                filters.add(np.concatenate(waiting))
        for row in filters.segments():
            yield _filter_rows([row])
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, once, twice = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                a = np.frombuffer(zlib.decompress(row["once"]), np.uint8)
                b = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
                if row["segment"] != segment:
                    if segment is not None:
                        yield _filter_rows([(segment, b"", zlib.compress(twice.tobytes(), 1))])
                    segment, once, twice = row["segment"], a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if segment is not None:
            yield _filter_rows([(segment, b"", zlib.compress(twice.tobytes(), 1))])

    schema = "segment int, once binary, twice binary"
    parts = docs.select("text").mapInArrow(fill, schema)
    merged = parts.repartition(min(SEGMENTS, parallelism(docs.sparkSession)), "segment").sortWithinPartitions("segment")
    whole = bytearray(1 << (bits - 3))
    size = len(whole) // SEGMENTS
    for row in merged.mapInArrow(merge, schema).select("segment", "twice").toLocalIterator():
        whole[row.segment * size : (row.segment + 1) * size] = zlib.decompress(row.twice)
    return bytes(whole)


def _keys_where(batches: Iterator[pa.RecordBatch], least: int, suspected) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, key) of the suspected line keys in batches of (doc_id, text_hash, text, ...).

    ``suspected`` gives of a batch, a row's place in it and the hashes of its keys which are suspected."""
    for batch in batches:
        rows, keys = [], []
        for i, text in enumerate(batch.column(2).cast(pa.binary())):
            own = list(keys_of(text.as_py(), least))
            if own:
                found = [k for k, yes in zip(own, suspected(batch, i, _hashes(own)).tolist()) if yes]
                keys += found
                rows += [i] * len(found)
        at = pa.array(rows, pa.int64())
        columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "key"])


def _suspects_by_filter(rows: DataFrame, least: int, bits: int) -> DataFrame:
    """Line keys that the filter of those seen twice may hold; no line moves."""
    twice = rows.sparkSession.sparkContext.broadcast(zlib.compress(seen_twice(rows, least, bits), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(zlib.decompress(twice.value), np.uint8)
        yield from _keys_where(batches, least, lambda _, __, hashes: holds(known, hashes))

    return rows.mapInArrow(run, _suspect_schema(rows))


def _suspects_by_hash(rows: DataFrame, least: int) -> DataFrame:
    """Line keys whose hash occurs in two or more rows; hashes of lines are shuffled, and per text those found twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_hashes(keys_of(t.as_py(), least)) for t in batch.column(1).cast(pa.binary())]
            at = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]), pa.int64())
            hashes = np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(hashes, pa.int64())], ["text_hash", "hash"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(batch, i, hashes):
            return np.isin(hashes.view(np.int64), np.array(batch.column(3)[i].as_py(), np.int64))

        yield from _keys_where(batches, least, listed)

    hashes = saved(rows.select("text_hash", "text").mapInArrow(run, "text_hash long, hash long"), "hashes")
    twice = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    lists = hashes.join(twice, "hash", "left_semi").groupBy("text_hash").agg(F.collect_set("hash").alias("hashes"))
    return rows.join(lists, "text_hash").select("doc_id", "text_hash", "text", "hashes").mapInArrow(keys, _suspect_schema(rows))


def _suspect_schema(rows: DataFrame) -> str:
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, key binary"


def repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """Rows (doc_id, text_hash, keys): the line keys that each row of ``docs`` (doc_id, text) loses, found again by its id
    and its text's hash (``text_hash``), so that a list is never longer than a text, also where ids repeat or are null.

    Hot keys, of a known number, meet their rows by a broadcast of digests, all others by a shuffle of the key.
    """
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), "text")
    bits = filter_bits(line_bound(docs, least_chars))
    found = _suspects_by_filter(rows, least_chars, bits) if bits <= MOST_BITS else _suspects_by_hash(rows, least_chars)
    found = saved(found, "suspects")
    counted = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    repeats = saved(counted.where(F.col("n") >= least_docs), "repeats")
    total = repeats.agg(F.sum("n").alias("n")).first().n or 0
    is_hot = F.col("n") * HOT_PART > total
    hot = F.broadcast(repeats.where(is_hot).select(F.md5("key").alias("mark"), "keeper"))
    marked = found.withColumn("mark", F.md5("key"))
    others = marked.join(hot.select("mark"), "mark", "left_anti").join(repeats.where(~is_hot).select("key", "keeper"), "key")
    kept = ["doc_id", "text_hash", "key", "keeper"]
    lost = marked.join(hot, "mark").select(*kept).unionByName(others.select(*kept))
    lost = lost.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("key").alias("keys"))


def text_hash(text: Column) -> Column:
    """What ``repeated_lines`` names a text by."""
    return F.xxhash64(text)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (before), n_dropped and kept_text.

    Lines are the parts between ``\\n``; a null or empty text is one empty line and its kept text is empty. Keys of at
    least ``least_chars`` code points found in ``least_docs`` or more rows lose their lines everywhere but in the
    rows with the largest doc_id that holds them, where all of them stay. Null ids count as rows but never as the
    largest id, unless a key has none else: then its lines stay. A row is a document, also where ids repeat. Other
    columns are ignored. An empty input gives an empty result.
    """
    source = keyed(docs, doc_id=id_col, text=text_col)
    lost = repeated_lines(source, least_chars, least_docs).withColumnRenamed("doc_id", "lost_id")
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (text_hash(F.col("text")) == F.col("text_hash"))
    joined = source.join(lost, same, "left").select("doc_id", "text", "keys")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, keys in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                lines = (text.as_py() or b"").split(b"\n")
                n_lines.append(len(lines))
                if keys.is_valid:
                    gone = set(keys.as_py())
                    lines = [x for x in lines if line_key(x) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string")


def without_repeats(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """``docs`` (doc_id, text, n_chars, ...), all columns and rows, with repeated lines taken out of the text.

    Lines go by the rule of ``dedup_lines``, null and repeated ids as there. Where a text changes, n_chars is counted
    anew; all else stays: null and empty texts, nulls in other columns and further columns of any name. An empty input
    gives an empty result.
    """
    lost = repeated_lines(keyed(docs, doc_id="doc_id", text="text"), least_chars, least_docs)
    id_name, hash_name, keys_name = fresh(docs, "lost_id", "lost_hash", "lost_keys")
    lost = lost.toDF(id_name, hash_name, keys_name)
    same = F.col("doc_id").eqNullSafe(F.col(id_name)) & (text_hash(F.col("text")) == F.col(hash_name))
    joined = docs.join(lost, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], keys_name)
    place, n_place = docs.columns.index("text"), docs.columns.index("n_chars")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, keys = batch.columns
            texts, sizes = columns[place].to_pylist(), columns[n_place].to_pylist()
            for i, own in enumerate(keys):
                if own.is_valid and texts[i] is not None:
                    gone = set(own.as_py())
                    kept = [x for x in texts[i].encode().split(b"\n") if line_key(x) not in gone]
                    texts[i] = b"\n".join(kept).decode()
                    sizes[i] = len(texts[i])
            columns[place], columns[n_place] = pa.array(texts, columns[place].type), pa.array(sizes, columns[n_place].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return numbered(joined).mapInArrow(cut, numbered(docs).schema).toDF(*docs.columns)
