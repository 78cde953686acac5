"""Removal of long repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a window of ``size`` bytes over it starts in a second place, too. Not every suffix needs sorting: each
window is assigned the place of its smallest 8-byte hash among its first ``spread`` places, which equal windows have
in common. Only suffixes from such places are looked at (about two per ``spread`` bytes), and of these only such whose
first ``core`` bytes, which all their windows share, occur twice. Both steps are exact: they leave out no window
that repeats.

Those suffixes are sorted in the tasks that cut them (equal ones collapse there), sent front-coded as runs, and
merged per bucket of equal cores by loser trees that keep, for each contender, the prefix it shares with the last
winner: bytes known to be equal are never compared again. Neighbours in the merged order give common prefixes to the
right; bytes before the place, sent along, give those to the left; a window repeats if another suffix agrees on enough
of both.

Cores with more than ``crowd`` places (a passage in a large share of all documents) take another exact way: their
windows are counted by digest with map-side sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, parallelism, saved

SIZE = 400
SPREAD = 200
#: Places with one core that go through one merge.
CROWD = 20_000
#: Suffixes per bucket, on average at most.
BUCKET = 40_000
#: Window starts handled at once, and bytes of suffixes per sorted run.
_BLOCK = 1 << 21
_RUN_BYTES = 32 << 20
#: Suffixes per exchanged row.
_ROW = 512
_KNOWN, _GIANT = 1, 2

_U = np.uint64


def _window_minima(data: np.ndarray, spread: int) -> np.ndarray:
    """For each start of ``spread`` places with 8 bytes each, the place with the smallest hash, leftmost of equal."""
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    mixed = grams * _U(0x9E3779B97F4A7C15)
    mixed ^= mixed >> _U(29)
    mixed *= _U(0xBF58476D1CE4E5B9)
    mixed &= _U(0xFFFFFFFF00000000)
    mixed |= np.arange(len(mixed), dtype=_U)
    width = 1
    least = mixed
    while width * 2 <= spread:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(mixed) - spread + 1
    least = np.minimum(least[:n], least[spread - width : spread - width + n])
    return (least & _U(0xFFFFFFFF)).astype(np.int64)


def window_places(data: np.ndarray, bounds: np.ndarray, size: int, spread: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, first window, last window), absolute, for runs of windows with one place.

    ``bounds`` are the offsets of the texts in ``data``; windows never cross them.
    """
    total = len(data)
    for p0 in range(0, total, _BLOCK):
        p1 = min(p0 + _BLOCK, total)
        change = np.zeros(p1 - p0 + 1, np.int8)
        i0 = np.searchsorted(bounds, p0, side="right") - 1
        i1 = np.searchsorted(bounds, p1, side="left")
        first, after = np.maximum(bounds[i0:i1], p0), np.minimum(bounds[i0 + 1 : i1 + 1] - size + 1, p1)
        some = first < after
        if not some.any():
            continue
        np.add.at(change, first[some] - p0, 1)
        np.add.at(change, after[some] - p0, -1)
        starts = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int8))
        part = data[p0 : p1 + spread + 6]
        if len(part) < p1 - p0 + spread + 6:
            part = np.concatenate([part, np.zeros(p1 - p0 + spread + 6 - len(part), np.uint8)])
        places = _window_minima(part, spread)[starts]
        new = np.concatenate([[True], (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)])
        at = np.flatnonzero(new)
        yield places[at] + p0, starts[at] + p0, starts[np.append(at[1:], len(starts)) - 1] + p0


def _pack(place: np.ndarray, least: np.ndarray, most: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Place in the text (36 bits), smallest and largest distance of its windows before it (12 each), flags (2)."""
    return place << 26 | least << 14 | most << 2 | flags


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 26, packed >> 14 & 4095, packed >> 2 & 4095, packed & 3


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after the other, and where each text begins and the last ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _places(size: int, spread: int):
    """(k1, k2, text) -> (route, core, k1, k2, packed): places with the hash of their core.

    The first place of a core in a batch is routed by the core, to be counted. Further ones are known to repeat and
    are routed anywhere, so that a core that is everywhere does not meet in one task.
    """
    core = size - spread + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            data, bounds = _text_bytes(batch.column(2))
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            view, found = memoryview(data), list(window_places(data, bounds, size, spread))
            if not found:
                continue
            place, first, last = (np.concatenate(x) for x in zip(*found))
            cores = np.array([digest(view[i : i + core]) for i in place.tolist()], _U)
            row = np.searchsorted(bounds, place, side="right") - 1
            _, lead, group, n = np.unique(cores, return_index=True, return_inverse=True, return_counts=True)
            leads = np.zeros(len(cores), bool)
            leads[lead] = True
            known = n[group] > 1
            spot = np.arange(len(cores), dtype=_U) * _U(0x9E3779B97F4A7C15)
            route = np.where(leads, cores, cores ^ spot)
            packed = _pack(place - bounds[row], place - last, place - first, known * _KNOWN)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(cores.view(np.int64)), pa.array(keys[0][row]), pa.array(keys[1][row]), pa.array(packed)],
                ["route", "core", "k1", "k2", "packed"],
            )

    return run


def _repeated_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by route, those that are known to repeat or have a neighbour with the same core."""
    held = None  # the last row of the batch before, not given yet
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        core = batch.column(1).to_numpy(zero_copy_only=False)
        packed = batch.column(4).to_numpy(zero_copy_only=False)
        same = core[1:] == core[:-1]
        repeats = (packed & _KNOWN) > 0
        repeats[1:] |= same
        repeats[:-1] |= same
        if same.any() and same[-1]:  # tell the held row that it has had a neighbour
            packed = packed.copy()
            packed[-1] |= _KNOWN
            batch = batch.set_column(4, "packed", pa.array(packed))
        held = batch.slice(batch.num_rows - 1)
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(repeats[:-1])).select(["core", "k1", "k2", "packed"])
    if held is not None and held.column(4)[0].as_py() & _KNOWN:
        yield held.select(["core", "k1", "k2", "packed"])


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differ.bit_length() + 7) // 8


#: An exchanged row: a stretch of a sorted run, front-coded, or spans that are decided already (bucket only spreads).
_RUN = pa.schema(
    [("bucket", pa.int32()), ("run", pa.int64()), ("part", pa.int32()), ("shared", pa.list_(pa.int16())), ("rest", pa.list_(pa.binary())),
     ("left", pa.list_(pa.binary())), ("many", pa.list_(pa.bool_())), ("k1", pa.list_(pa.int64())), ("k2", pa.list_(pa.int64())),
     ("start", pa.list_(pa.int64())), ("stop", pa.list_(pa.int64()))]
)
_RUN_SQL = (
    "bucket int, run long, part int, shared array<smallint>, rest array<binary>, left array<binary>, many array<boolean>, "
    "k1 array<long>, k2 array<long>, start array<long>, stop array<long>"
)


def _suffixes(text: bytes, packed: np.ndarray, size: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(flags, place, bytes from the place, bytes before it) of the places of one text."""
    for place, least, most, flags in zip(*(x.tolist() for x in _unpack(packed))):
        yield flags, place, text[place : place + size - least], text[place - most : place]


def _sorted_runs(size: int, spread: int, buckets: int):
    """Texts with their places -> front-coded sorted runs per bucket, and the spans that are decided in the task."""
    core = size - spread + 1

    def coded(bucket: int, run: int, items: list) -> Iterator[pa.RecordBatch]:
        before = b""  # carried across parts: the merge reads a run as one
        for part in range(0, len(items), _ROW):
            shared = []
            for right, *_ in items[part : part + _ROW]:
                shared.append(common_prefix(before, right))
                before = right
            chunk = items[part : part + _ROW]
            yield _one_row(
                bucket, run, part // _ROW, shared, [r[n:] for (r, *_), n in zip(chunk, shared)], [x[1] for x in chunk],
                [x[2] for x in chunk], [x[3] for x in chunk], [x[4] for x in chunk], [x[5] for x in chunk], [],
            )

    def flush(found: dict, run: int) -> Iterator[pa.RecordBatch]:
        per_bucket: dict[int, list] = {}
        spans: list[tuple[int, int, int, int]] = []
        for (right, left), owners in found.items():
            many = len(owners) > 1
            if many:
                spans += [(a, b, place - len(left), place + len(right)) for a, b, place in owners]
            bucket = xxhash.xxh3_64_intdigest(right[:core]) % buckets
            per_bucket.setdefault(bucket, []).append((right, left, many, *owners[0]))
        for bucket, items in per_bucket.items():
            items.sort(key=lambda x: (x[0], x[1]))
            yield from coded(bucket, run, items)
        for at in range(0, len(spans), 4096):
            yield _one_row((run + at) % buckets, -1, 0, [], [], [], [], *zip(*spans[at : at + 4096]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[bytes, bytes], list] = {}
        used = 0
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).cast(pa.binary())
            columns = [batch.column(names.index(n)).to_pylist() for n in ("k1", "k2")]
            for text, k1, k2, packed in zip(texts, *columns, batch.column(names.index("packed"))):
                if not packed.is_valid:
                    continue
                places = np.unique(packed.values.to_numpy(zero_copy_only=False))
                copies = len(packed.values) > len(places)  # the same row of documents more than once
                for flags, place, right, left in _suffixes(text.as_py(), places, size):
                    if flags & _GIANT:
                        continue
                    owners = found.setdefault((right, left), [])
                    owners.append((k1, k2, place))
                    if copies:
                        owners.append((k1, k2, place))
                    used += len(right) + len(left) + 200
                if used > _RUN_BYTES:
                    yield from flush(found, _run_name(found))
                    found, used = {}, 0
        if found:
            yield from flush(found, _run_name(found))

    return run


def _run_name(found: dict) -> int:
    """A number for a run, from a place in it: another attempt of the task gives the same, no other run has it."""
    k1, k2, place = next(iter(found.values()))[0]
    return xxhash.xxh3_64_intdigest(f"{k1} {k2} {place}") >> 2


def _one_row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([list(v) if isinstance(v, tuple) else v], f.type) for v, f in zip(values, _RUN)], schema=_RUN)


class _Contender:
    """The suffix of a run that is next, and how long a prefix it shares with the last winner of the tree."""

    __slots__ = ("rows", "at", "right", "shared", "item")

    def __init__(self, rows: list[tuple]) -> None:
        self.rows, self.at, self.right, self.shared, self.item = rows, -1, b"", 0, ()
        self.step()

    def step(self) -> None:
        """Go on to the next suffix: its stored prefix is shared with the one before, which has just won."""
        self.at += 1
        if self.at >= len(self.rows):
            self.shared = -1
            return
        self.item = self.rows[self.at]
        self.shared = self.item[0]
        self.right = self.right[: self.shared] + self.item[1]


def _beats(a: _Contender, b: _Contender) -> bool:
    """Whether ``a`` comes before ``b``; the later one's shared prefix then refers to the earlier one.

    Both prefixes refer to the last winner, which comes before both: the longer one decides, and only when they are
    equal are bytes after them compared.
    """
    if a.shared != b.shared:
        return a.shared > b.shared
    if a.shared < 0:
        return True
    n = a.shared
    more = common_prefix(a.right[n:], b.right[n:])
    n += more
    first = a.right[n:] <= b.right[n:]
    (b if first else a).shared = n
    return first


def merged(runs: list[list[tuple]]) -> Iterator[tuple[int, bytes, tuple]]:
    """(prefix shared with the one before, suffix, item) of all runs in order, by a loser tree."""
    k = len(runs)
    contenders = [_Contender(r) for r in runs]
    losers = [-1] * k
    for start in range(k):  # play the leaves in; a node waits for its second contender
        winner, node = start, (start + k) // 2
        while node > 0:
            if losers[node] < 0:
                losers[node] = winner
                winner = -1
                break
            if not _beats(contenders[winner], contenders[losers[node]]):
                winner, losers[node] = losers[node], winner
            node //= 2
        if winner >= 0:
            losers[0] = winner
    while True:
        winner = losers[0]
        best = contenders[winner]
        if best.shared < 0:
            return
        yield best.shared, best.right, best.item
        best.step()
        node = (winner + k) // 2
        while node > 0:
            if not _beats(contenders[winner], contenders[losers[node]]):
                winner, losers[node] = losers[node], winner
            node //= 2
        losers[0] = winner


def _left_common(a: bytes, b: bytes) -> int:
    return common_prefix(a[::-1], b[::-1])


def best_extents(rights: list[bytes], lefts: list[bytes], shared: list[int], size: int) -> tuple[list[int], list[int]]:
    """Per suffix of one core, in order: the longest agreement to the left and to the right with any other suffix
    that agrees on ``size`` bytes in all; -1 without one. ``shared`` is the common prefix with the one before."""
    n = len(rights)
    left_best, right_best = [-1] * n, [-1] * n
    if n <= 8:
        for i in range(n):
            rho = size
            for j in range(i + 1, n):
                rho = min(rho, shared[j])
                lam = _left_common(lefts[i], lefts[j])
                if lam + rho >= size:
                    for x in (i, j):
                        left_best[x], right_best[x] = max(left_best[x], lam), max(right_best[x], rho)
        return left_best, right_best
    right_steps = np.array(shared, np.int32)
    turned = [x[::-1] for x in lefts]
    order = sorted(range(n), key=turned.__getitem__)
    seat = np.empty(n, np.int64)
    seat[order] = np.arange(n)
    left_steps = np.array([0] + [common_prefix(turned[a], turned[b]) for a, b in zip(order, order[1:])], np.int32)

    def agreement(steps: np.ndarray, i: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        if i + 1 < n:
            out[i + 1 :] = np.minimum.accumulate(steps[i + 1 :])
        if i:
            out[:i] = np.minimum.accumulate(steps[i:0:-1])[::-1]
        return out

    for i in range(n):
        rho, lam = agreement(right_steps, i), agreement(left_steps, seat[i])[seat]
        good = rho + lam >= size
        good[i] = False
        if good.any():
            left_best[i], right_best[i] = int(lam[good].max()), int(rho[good].max())
    return left_best, right_best


def _merge_buckets(size: int, spread: int):
    """Rows sorted by bucket, run and part -> spans (k1, k2, start, stop) of bytes that repeat."""
    core = size - spread + 1

    def solve(group: list[tuple[int, bytes, tuple]]) -> Iterator[tuple[int, int, int, int]]:
        if len(group) < 2:
            return
        alike: dict[tuple[bytes, bytes], list] = {}
        steps: list[int] = []
        step = size
        for shared, right, item in group:
            step = min(step, shared)
            owners = alike.get((right, item[2]))
            if owners is None:
                alike[right, item[2]] = [item]
                steps.append(step)
                step = size
            else:
                owners.append(item)
        for (right, left), items in alike.items():
            if len(items) > 1:
                for item in items:
                    if not item[3]:  # spans of those that were many in their task are out already
                        yield item[4], item[5], item[6] - len(left), item[6] + len(right)
        if len(alike) < 2:
            return
        rights, lefts = [k[0] for k in alike], [k[1] for k in alike]
        left_best, right_best = best_extents(rights, lefts, steps, size)
        for items, a, b in zip(alike.values(), left_best, right_best):
            if a >= 0 and len(items) == 1 and not items[0][3]:
                yield items[0][4], items[0][5], items[0][6] - a, items[0][6] + b

    def bucket_spans(runs: dict[int, list[tuple]]) -> Iterator[tuple[int, int, int, int]]:
        group: list[tuple[int, bytes, tuple]] = []
        for shared, right, item in merged(list(runs.values())):
            if shared < core:
                yield from solve(group)
                group = []
            group.append((shared, right, item))
        yield from solve(group)

    def batch_of(spans: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*spans)) if spans else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, runs = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i] for j, n in enumerate(_RUN.names)}
                if row["run"].as_py() < 0:
                    yield pa.RecordBatch.from_arrays([row[n].values for n in ("k1", "k2", "start", "stop")], ["k1", "k2", "start", "stop"])
                    continue
                if row["bucket"].as_py() != bucket:
                    if runs:
                        yield batch_of(list(bucket_spans(runs)))
                    bucket, runs = row["bucket"].as_py(), {}
                items = list(zip(*(row[n].as_py() for n in ("shared", "rest", "left", "many", "k1", "k2", "start"))))
                runs.setdefault(row["run"].as_py(), []).extend(items)
        if runs:
            yield batch_of(list(bucket_spans(runs)))

    return run


def _window_digests(size: int):
    """Windows of the places with crowded cores -> (d1, d2, k1, k2, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).cast(pa.binary())
            keys = [batch.column(names.index(n)).to_pylist() for n in ("k1", "k2")]
            for text, k1, k2, packed in zip(texts, *keys, batch.column(names.index("packed"))):
                if not packed.is_valid:
                    continue
                values = packed.values.to_numpy(zero_copy_only=False)
                place, least, most, flags = _unpack(values[(values & _GIANT) > 0])
                starts = [p - o for p, a, b in zip(place.tolist(), least.tolist(), most.tolist()) for o in range(a, b + 1)]
                if not starts:
                    continue
                raw = text.as_py()
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[s : s + size]) for s in starts), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), pa.array([k1] * len(starts)), pa.array([k2] * len(starts)),
                     pa.array(starts, pa.int64())],
                    ["d1", "d2", "k1", "k2", "start"],
                )

    return run


def repeated_spans(docs: DataFrame, size: int = SIZE, spread: int = SPREAD, crowd: int = CROWD) -> DataFrame:
    """Rows (k1, k2, start, stop): byte ranges to remove, overlapping, per document. ``docs`` has k1, k2 and text."""
    if not 8 <= spread <= min(size - 7, 4096):
        raise ValueError("spread must lie between 8 and size - 7")
    spark = docs.sparkSession
    n = parallelism(spark)
    placed = docs.select("k1", "k2", "text").mapInArrow(_places(size, spread), "route long, core long, k1 long, k2 long, packed long")
    counted = placed.repartition(n, "route").sortWithinPartitions("route", "core")
    found = saved(counted.mapInArrow(_repeated_cores, "core long, k1 long, k2 long, packed long"), "places")
    crowded = saved(found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("core"), "crowded")
    buckets = max(n, -(-found.count() // BUCKET))
    some_crowded = not crowded.isEmpty()
    if some_crowded:
        mark = F.when(F.col("is_crowded"), F.col("packed").bitwiseOR(F.lit(_GIANT))).otherwise(F.col("packed")).alias("packed")
        found = found.join(crowded.withColumn("is_crowded", F.lit(True)), "core", "left").select("k1", "k2", mark)
    per_doc = found.groupBy("k1", "k2").agg(F.collect_list("packed").alias("packed"))
    with_places = docs.join(per_doc, ["k1", "k2"], "left")
    runs = with_places.mapInArrow(_sorted_runs(size, spread, buckets), _RUN_SQL)
    ordered = runs.repartition(n, "bucket").sortWithinPartitions("bucket", "run", "part")
    spans = ordered.mapInArrow(_merge_buckets(size, spread), "k1 long, k2 long, start long, stop long")
    if not some_crowded:
        return spans
    windows = with_places.mapInArrow(_window_digests(size), "d1 long, d2 long, k1 long, k2 long, start long")
    twice = windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
    more = windows.join(twice, ["d1", "d2"], "left_semi").select("k1", "k2", "start", (F.col("start") + size).alias("stop"))
    return spans.unionByName(more)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, spread: int = SPREAD, crowd: int = CROWD
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes).

    Texts are their UTF-8 bytes, null texts empty; texts shorter than ``size`` lose nothing. All texts are judged as
    given, wherever else a string starts, also in the same text or in a repeated row. Ids may repeat or be null;
    rows that agree in id and text are documents of their own and so copies of each other. Other columns are
    ignored. An empty input gives an empty result. ``kept`` is binary, since a span may end within a character.
    """
    source = keyed(docs, doc_id=id_col, text=text_col)
    named = source.select(
        "doc_id", "text",
        F.xxhash64(F.lit(1), F.col("doc_id").isNull(), "doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(2), F.col("doc_id").isNull(), "doc_id", "text").alias("k2"),
    )
    spans = repeated_spans(named, size, spread, crowd)
    per_doc = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, found in zip(batch.column(names.index("text")).cast(pa.binary()), batch.column(names.index("spans"))):
                raw = text.as_py() or b""
                pieces, at, gone, runs, reach = [], 0, 0, 0, -1
                for start, stop in sorted((x["start"], x["stop"]) for x in (found.as_py() or [])):
                    if start > reach:
                        runs += 1
                        pieces.append(raw[at:start])
                        at = reach = start
                    if stop > reach:
                        gone += stop - reach
                        at = reach = stop
                pieces.append(raw[at:])
                n_bytes.append(len(raw))
                n_removed.append(gone)
                n_spans.append(runs)
                kept.append(b"".join(pieces))
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("doc_id")), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    joined = named.join(per_doc, ["k1", "k2"], "left")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
