"""Alignment of two tokenizers' tokens over the same bytes.

Byte offsets where tokens of both end cut a document into groups. A fragment says what a byte range shows of that:
an open prefix (tokens up to the first cut), closed groups, and an open suffix (tokens after the last cut). Two
neighbouring fragments make one, suffix and prefix between them becoming a closed group, and the order in which
fragments are put together does not matter, so a very long document is tokenized as many pieces in many tasks and its
fragments are reduced as a tree. Documents up to one byte range are whole in one task.

A long text may only be tokenized in pieces that give the tokens of the whole. It is split before a space that follows a
word character or a visible one. The byte-level tokenizer never joins what is before such a space with it, as its words
hold a space only as the first character; the piece tokenizer does not either if no piece has a space after another
character, which is looked up in its vocabulary (else texts stay whole).

The counts of linked id pairs are sums over all documents. They are sent to the tasks only if there are at most
``Pair.sent`` different pairs; otherwise links and counts meet in a join. Both ways give the same.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, parallelism, saved

#: Bytes of text tokenized at once in a task.
_AT_ONCE = 1 << 19
#: Links counted at once, and different pairs that a task holds before it hands on their counts.
_LINKS, _HELD = 1 << 19, 1 << 19
#: Not before a last space: the piece tokenizer has no token for an empty rest, but one for the space.
_SPLIT = re.compile(r"(?<=[\w!-~]) (?=[\s\S])")


@dataclass(frozen=True)
class Pair:
    """Two vocabulary files and the parameters of the alignment: ``span`` is the length of byte ranges, ``sent`` the most
    id pairs whose counts are sent to the tasks (24 bytes each), ``fan`` how many fragments meet in one step."""

    byte_file: str
    piece_file: str
    pattern: str
    span: int = 1 << 15
    sent: int = 1 << 20
    fan: int = 8


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most``, by the size of each row."""
    part = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        yield batch.slice(s, e - s)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible Latin-1 characters stand for themselves, the
    other bytes, in order, for the characters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers of a pair and the bytes of their tokens."""

    def __init__(self, pair: Pair):
        import sentencepiece
        import tiktoken

        letters = _byte_letters()
        with open(pair.byte_file, encoding="utf-8") as f:
            described = json.load(f)
        special = {t["content"] for t in described["added_tokens"]}
        entries = {bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
        # Merges are numbered as the entries they make, so the smallest id is the next merge.
        self.byte_level = tiktoken.Encoding("byte-level", pat_str=pair.pattern, mergeable_ranks=entries, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pair.piece_file)
        size = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(size)]
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            self.bytes_a[i] = token
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.divisible = not any("▁" in n.lstrip("▁") for n in names)
        # A link is written as one number, short where the vocabularies allow it.
        self.radix = size
        self.code, self.code_type = (np.int32, "int") if len(self.bytes_a) * size < 1 << 31 else (np.int64, "long")
        # An id's text in a group: followed by a comma, or by what ends its side of the group.
        self.text_a = [f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"]
        self.text_b = [f"{i}{end}".encode() for i in range(size) for end in ",;"]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both for each space + text, and whether both give its bytes."""
        spaced = [" " + t for t in texts]
        a = [self.byte_level.encode_ordinary(s) for s in spaced]
        b = self.pieces.encode(texts, num_threads=1)
        same = [
            b"".join(map(self.bytes_a.__getitem__, x)) == (raw := s.encode()) == b"".join(map(self.bytes_b.__getitem__, y))
            for x, y, s in zip(a, b, spaced)
        ]
        return a, b, np.array(same, bool)


    def links(self, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
        return (ids_a * self.radix + ids_b).astype(self.code)


@functools.lru_cache(maxsize=2)
def _loaded(pair: Pair) -> Tokenizers:
    return Tokenizers(pair)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of both sides (ascending ends), whether each token ends where one of the other side does."""
    both = np.concatenate([ends_a, ends_b])
    if not len(both):
        return np.zeros(0, bool), np.zeros(0, bool)
    base, size = both.min(), both.max() - both.min() + 1
    at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
    at_a[ends_a - base] = True
    at_b[ends_b - base] = True
    return at_b[ends_a - base], at_a[ends_b - base]


def _woven(hit_a: np.ndarray, hit_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of A and B where all are written group by group, A before B; the last group is closed."""
    last_a, last_b = np.flatnonzero(hit_a), np.flatnonzero(hit_b)
    group_a, group_b = np.cumsum(hit_a) - hit_a, np.cumsum(hit_b) - hit_b
    before_b = np.concatenate([[0], last_b + 1])
    return np.arange(len(hit_a)) + before_b[group_a], np.arange(len(hit_b)) + (last_a + 1)[group_b]


def _written(t: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray) -> list[bytes]:
    """Texts of the tokens of closed groups, in the order in which groups are written."""
    place_a, place_b = _woven(hit_a, hit_b)
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a] = ids_a * 2 + hit_a
    code[place_b] = ~(ids_b * 2 + hit_b)
    return [t.text_a[c] if c >= 0 else t.text_b[~c] for c in code.tolist()]


def align_texts(t: Tokenizers, texts: list[str]) -> Iterator[tuple[int, int, int, bytes, np.ndarray] | None]:
    """Of each text (tokens A, tokens B, groups, written groups, links), None where the bytes differ."""
    a, b, same = t.encode(texts)
    a, b = [x for x, s in zip(a, same) if s], [x for x, s in zip(b, same) if s]
    ids_a, ids_b = _flat(a), _flat(b)
    ends_a, ends_b = np.cumsum(t.length_a[ids_a]), np.cumsum(t.length_b[ids_b])
    # Texts laid end to end: the end of each is a cut.
    hit_a, hit_b = _cuts(ends_a, ends_b)
    written = _written(t, ids_a, ids_b, hit_a, hit_b)
    links = t.links(ids_a[hit_a], ids_b[hit_b])
    stop_a, stop_b = np.cumsum([len(x) for x in a]), np.cumsum([len(x) for x in b])
    upto = np.concatenate([[0], np.cumsum(hit_a)])
    at_a = at_b = 0
    found = iter(zip(stop_a.tolist(), stop_b.tolist()))
    for s in same:
        if not s:
            yield None
            continue
        to_a, to_b = next(found)
        own = links[upto[at_a] : upto[to_a]]
        yield to_a - at_a, to_b - at_b, len(own), b"".join(written[at_a + at_b : to_a + to_b])[:-1], own
        at_a, at_b = to_a, to_b


@dataclass
class Fragment:
    """What a byte range shows of the groups; without a cut everything is in the head."""

    cuts: int = 0
    head_a: list[int] = field(default_factory=list)
    head_b: list[int] = field(default_factory=list)
    body: bytes = b""
    tail_a: list[int] = field(default_factory=list)
    tail_b: list[int] = field(default_factory=list)

    def __add__(self, right: Fragment) -> Fragment:
        if not self.cuts:
            return Fragment(right.cuts, self.head_a + right.head_a, self.head_b + right.head_b, right.body, right.tail_a, right.tail_b)
        if not right.cuts:
            return Fragment(self.cuts, self.head_a, self.head_b, self.body, self.tail_a + right.head_a, self.tail_b + right.head_b)
        between = group_text(self.tail_a + right.head_a, self.tail_b + right.head_b) + b";"
        return Fragment(self.cuts + right.cuts, self.head_a, self.head_b, self.body + between + right.body, right.tail_a, right.tail_b)


def group_text(a: list[int], b: list[int]) -> bytes:
    return (",".join(map(str, a)) + "|" + ",".join(map(str, b))).encode()


def fragment(t: Tokenizers, ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> tuple[Fragment, np.ndarray]:
    """The fragment of the tokens that end in one byte range, and its links."""
    hit_a, hit_b = _cuts(ends_a, ends_b)
    last_a, last_b = np.flatnonzero(hit_a), np.flatnonzero(hit_b)
    links = t.links(ids_a[last_a], ids_b[last_b])
    if not len(last_a):
        return Fragment(0, ids_a.tolist(), ids_b.tolist()), links
    head_a, head_b, tail_a, tail_b = last_a[0] + 1, last_b[0] + 1, last_a[-1] + 1, last_b[-1] + 1
    inner = slice(head_a, tail_a), slice(head_b, tail_b)
    body = b"".join(_written(t, ids_a[inner[0]], ids_b[inner[1]], hit_a[inner[0]], hit_b[inner[1]]))
    return Fragment(len(last_a), ids_a[:head_a].tolist(), ids_b[:head_b].tolist(), body, ids_a[tail_a:].tolist(), ids_b[tail_b:].tolist()), links


def split_text(text: str, span: int, divisible: bool) -> list[str]:
    """Pieces of at least ``span`` characters (but the last) that are tokenized as in the whole text."""
    places, at = [0], 0
    while divisible and (m := _SPLIT.search(text, at + span)):
        at = m.start()
        places.append(at)
    return [text[s:e] for s, e in zip(places, [*places[1:], len(text)])]


_RESULT = "n_a long, n_b long, n_groups long, groups_sha256 string"


def _short(docs: DataFrame, pair: Pair) -> DataFrame:
    """(row, doc_id, counts, digest, links) of documents of one byte range."""
    kind, code_type = docs.schema["doc_id"].dataType.simpleString(), _loaded(pair).code_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, row = _loaded(pair), TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for own in _parts(batch, sizes, _AT_ONCE):
                texts = own.column(1).to_pylist()
                found = align_texts(t, [x for x in texts if x])
                rows = [(next(found) if x else None) or (0, 0, 0, b"", None) for x in texts]
                digests = [hashlib.sha256(r[3]).hexdigest() if r[3] else "" for r in rows]
                links = [r[4] if r[4] is not None else np.zeros(0, t.code) for r in rows]
                counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
                number = pa.array(np.arange(row, row + len(rows)))
                row += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [number, own.column(0), *counts, pa.array(digests), pa.array(links, pa.list_(pa.from_numpy_dtype(t.code)))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )

    return docs.mapInArrow(run, f"row long, doc_id {kind}, {_RESULT}, links array<{code_type}>")


_FRAGMENT = "text_key string, at long, cuts long, head_a array<int>, head_b array<int>, body binary, tail_a array<int>, tail_b array<int>, n_a long, n_b long, same boolean"
_FIELDS = ["cuts", "head_a", "head_b", "body", "tail_a", "tail_b"]


def _fragment_table(rows: list[dict], links: list | None) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    types = dict(text_key=pa.string(), at=pa.int64(), cuts=pa.int64(), head_a=ints, head_b=ints, body=pa.binary(), tail_a=ints, tail_b=ints, n_a=pa.int64(), n_b=pa.int64(), same=pa.bool_())
    columns = {k: pa.array([r[k] for r in rows], kind) for k, kind in types.items()}
    if links is not None:
        columns["links"] = pa.array(links, pa.list_(pa.from_numpy_dtype(links[0].dtype)))
    return pa.RecordBatch.from_pydict(columns)


def _fragments(texts: DataFrame, pair: Pair) -> DataFrame:
    """(text_key, text), long -> the fragments of their byte ranges; a range with tokens of two pieces has two."""

    divisible, code_type = _loaded(pair).divisible, _loaded(pair).code_type

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = 0
                for piece in split_text(text.as_py(), pair.span, divisible):
                    yield pa.RecordBatch.from_pydict({"text_key": [key], "start": pa.array([start], pa.int64()), "piece": [piece]})
                    start += len(piece.encode()) + (start == 0)  # the space in front belongs to the first piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _loaded(pair)
        for batch in batches:
            for key, start, piece in zip(*(c.to_pylist() for c in batch.columns)):
                (a,), (b,), same = t.encode([piece[1:] if start else piece])
                ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
                ends_a, ends_b = start + np.cumsum(t.length_a[ids_a]), start + np.cumsum(t.length_b[ids_b])
                rows, links = [], []
                stop = max([start + 1, *ends_a[-1:].tolist(), *ends_b[-1:].tolist()])
                for low in range(start // pair.span * pair.span, stop, pair.span):
                    s_a, e_a = np.searchsorted(ends_a, [low, low + pair.span], side="right")
                    s_b, e_b = np.searchsorted(ends_b, [low, low + pair.span], side="right")
                    f, own = fragment(t, ids_a[s_a:e_a], ends_a[s_a:e_a], ids_b[s_b:e_b], ends_b[s_b:e_b])
                    rows.append(vars(f) | {"text_key": key, "at": max(start, low), "n_a": int(e_a - s_a), "n_b": int(e_b - s_b), "same": bool(same[0])})
                    links.append(own)
                yield _fragment_table(rows, links)

    cut = texts.select("text_key", "text").mapInArrow(pieces, "text_key string, start long, piece string")
    dealt = cut.repartition(parallelism(texts.sparkSession), "text_key", "start")
    return dealt.mapInArrow(run, f"{_FRAGMENT}, links array<{code_type}>")


def _reduced(fragments: DataFrame, pair: Pair, last: int) -> DataFrame:
    """One fragment per text: neighbours meet in ever larger spans."""

    def join(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pylist()
        total, n_a, n_b, same = Fragment(), 0, 0, True
        for r in rows:
            total = total + Fragment(*(r[k] for k in _FIELDS))
            n_a, n_b, same = n_a + r["n_a"], n_b + r["n_b"], same and r["same"]
        merged = vars(total) | {"text_key": rows[0]["text_key"], "at": rows[0]["at"], "n_a": n_a, "n_b": n_b, "same": same}
        return pa.Table.from_batches([_fragment_table([merged], None)])

    now, span = fragments.drop("links"), pair.span
    while True:
        span *= pair.fan
        now = now.groupBy("text_key", F.floor(F.col("at") / span).alias("place")).applyInArrow(join, _FRAGMENT)
        if span > last:
            return now


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    """Links of each row (the second column)."""
    return pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)


def _pair_counts(links: DataFrame, radix: int) -> DataFrame:
    """(weight, links) -> (pair, n): counts are added up in the tasks before they are dealt by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in (p for batch in batches for p in _parts(batch, _sizes(batch), _LINKS)):
            keys = np.concatenate([held, part.column(1).flatten().to_numpy(zero_copy_only=False)])
            counts = np.concatenate([counts, np.repeat(part.column(0).to_numpy(zero_copy_only=False), _sizes(part))])
            held, place = np.unique(keys, return_inverse=True)
            counts = np.bincount(place, weights=counts, minlength=len(held)).astype(np.int64)
            if len(held) > _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], ["pair", "n"])
                held, counts = held[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], ["pair", "n"])

    partial = links.select("weight", "links").mapInArrow(run, "pair long, n long")
    counts = saved(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-sums")
    best = counts.groupBy((F.col("pair") % radix).alias("b")).agg(F.max("n").alias("most"))
    joined = counts.join(best, F.col("pair") % radix == F.col("b"))
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(links: DataFrame, counts: DataFrame, sent: int) -> DataFrame:
    """(row, links) -> (row, n_best, count_sum)."""
    if counts.count() > sent:
        single = links.select("row", F.explode("links").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
        met = single.join(counts, "pair")
        return met.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).cast("long").alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
        )
    table = counts.toArrow().sort_by("pair")
    arrays = tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
    known = links.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for part in (p for batch in batches for p in _parts(batch, _sizes(batch), _LINKS)):
            keys, stops = part.column(1).flatten().to_numpy(zero_copy_only=False), np.cumsum(_sizes(part))
            place = np.searchsorted(pairs, keys)
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[place].astype(np.int64))])[np.concatenate([[0], stops])]) for x in (best, n)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sums[0]), pa.array(sums[1])], ["row", "n_best", "count_sum"])

    return links.select("row", "links").mapInArrow(run, "row long, n_best long, count_sum long")


def align(docs: DataFrame, pair: Pair, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Each link joins two tokens that end at the same byte; as no token is empty, every group has one, its last two.
    Null and empty texts and texts whose bytes one of the tokenizers does not give back have no tokens: zeros and an
    empty digest. Equal texts and equal or null ids are rows of their own; of a very long text that occurs several times
    the work is done once and its links count as often as it occurs. Other columns are ignored; an empty input gives an
    empty result.
    """
    source = keyed(docs, doc_id=id_col, text=text_col)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = saved(_short(source.where(size <= pair.span), pair), "aligned")
    large = source.where(size > pair.span).withColumn("text_key", F.sha2(F.col("text").cast("binary"), 256))
    # The number of text with its key; the longest tells how often spans must grow.
    copies = saved(large.groupBy("text_key").agg(F.count(F.lit(1)).alias("weight"), F.max(F.octet_length("text")).alias("size")), "long-texts")
    longest = copies.agg(F.max("size")).first()[0]
    rows, links = short, short.select("row", F.lit(1).cast("long").alias("weight"), "links")
    if longest is not None:
        once = large.groupBy("text_key").agg(F.any_value("text").alias("text"))
        parts = saved(_fragments(once, pair), "fragments")
        whole = _reduced(parts, pair, longest + 1)

        head = F.concat_ws("|", *[F.array_join(F.col(c).cast("array<string>"), ",") for c in ("head_a", "head_b")])
        body = F.col("body").cast("string")
        written = F.when(F.length(body) > 0, F.concat(head, F.lit(";"), F.substring(body, F.lit(1), F.length(body) - 1))).otherwise(head)
        counts = [F.when(F.col("same"), F.col(c)).otherwise(F.lit(0).cast("long")).alias(n) for c, n in (("n_a", "n_a"), ("n_b", "n_b"), ("cuts", "n_groups"))]
        digest = F.when(F.col("same"), F.sha2(written.cast("binary"), 256)).otherwise("").alias("groups_sha256")
        closed = saved(whole.select("text_key", *counts, digest), "closed")
        keys = closed.where("n_groups > 0").join(copies, "text_key").select("text_key", "weight", (-1 - F.monotonically_increasing_id()).alias("row"))
        keys = saved(keys, "long-rows")
        links = links.unionByName(parts.join(keys, "text_key").select("row", "weight", "links"))
    counts = saved(_pair_counts(links, _loaded(pair).radix), "pairs")
    scored = _scored(links, counts, pair.sent).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    if longest is not None:
        scored = saved(scored, "scored")
        named = closed.join(keys.drop("weight"), "text_key", "left")
        long_rows = large.select("doc_id", "text_key").join(named, "text_key")
        rows = rows.drop("links").unionByName(long_rows.drop("text_key"))
    columns = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return rows.join(scored, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), *columns, "groups_sha256")
