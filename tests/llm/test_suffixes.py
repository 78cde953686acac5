import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabguard.llm import suffixes


def plain(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = Counter()
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)] += 1
    return out


def texts(seed, n=100):
    r = random.Random(seed)

    def words(k):
        return " ".join("".join(r.choice("abé") for _ in range(r.randint(1, 4))) for _ in range(k))

    base, rows = [words(60) for _ in range(6)], []
    for i in range(n):
        kind = r.random()
        if kind < 0.1:
            t = r.choice([None, "", "x", "aa" * r.randint(1, 100)])
        elif kind < 0.7:
            b = r.choice(base)
            a = r.randint(0, len(b))
            t = words(r.randint(0, 9)) + b[a : a + r.randint(20, 200)] + words(r.randint(0, 9)) + r.choice(base)[: r.randint(0, 80)]
        else:
            t = words(r.randint(0, 80))
        rows.append((r.choice([i, i, None, 3]), t))
    return rows + rows[:3]


@pytest.mark.parametrize("size,spread,crowd", [(40, 20, 20000), (40, 33, 20000), (24, 8, 20000), (40, 20, 4)])
def test_equals_brute_force(spark, size, spread, crowd):
    rows = texts(size + spread + crowd)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, k1 int, spans string").repartition(4)
    found = suffixes.remove_repeats(docs, size=size, spread=spread, crowd=crowd).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == plain(rows, size)


def test_production_size_with_passages_across_documents(spark):
    r = random.Random(8)

    def fresh(n):
        return "".join(r.choice("abcdefghij é") for _ in range(n))

    passage, edge = fresh(700), fresh(400)
    rows = [(i, fresh(r.randint(0, 900)) + passage[r.randint(0, 90) :] + fresh(300)) for i in range(12)]
    rows += [(20, edge), (21, fresh(5) + edge), (22, edge[:-1] + "#"), (23, fresh(3000)), (24, fresh(50) * 40)]
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in found) == plain(rows, 400)


def test_empty_input(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_loser_tree_gives_order_and_prefixes():
    r = random.Random(4)
    for k in (1, 2, 3, 5, 8, 13):
        runs, everything = [], []
        for _ in range(k):
            strings = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 30)))
            everything += strings
            coded, before = [], b""
            for s in strings:
                n = suffixes.common_prefix(before, s)
                coded.append((n, s[n:]))
                before = s
            runs.append(coded)
        merged = [(n, s) for n, s, _ in suffixes.merged(runs)]
        assert [s for _, s in merged] == sorted(everything)
        assert all(n == suffixes.common_prefix(a, b) for (_, a), (n, b) in zip(merged, merged[1:]))


def test_extents_of_large_groups_equal_those_of_all_pairs():
    r = random.Random(6)
    rights = sorted("".join(r.choice("ab") for _ in range(20)).encode() for _ in range(40))
    lefts = ["".join(r.choice("ab") for _ in range(r.randint(0, 9))).encode() for _ in rights]
    shared = [0] + [suffixes.common_prefix(a, b) for a, b in zip(rights, rights[1:])]
    left, right = suffixes.best_extents(rights, lefts, shared, 8)
    for i in range(40):
        pairs = [(suffixes.common_prefix(lefts[i][::-1], lefts[j][::-1]), suffixes.common_prefix(rights[i], rights[j])) for j in range(40) if j != i]
        good = [(a, b) for a, b in pairs if a + b >= 8]
        assert (left[i], right[i]) == ((max(a for a, _ in good), max(b for _, b in good)) if good else (-1, -1))


def spans_of_runs(docs, size, spread, n_runs):
    """All places of ``docs`` in one bucket, ``n_runs`` sorted runs, merged -> the bytes to remove per document."""
    core, runs, places = size - spread + 1, [], []
    for text in docs:
        data = np.frombuffer(text, np.uint8)
        found = list(suffixes.window_places(data, np.array([0, len(data)]), size, spread))
        at, first, last = (np.concatenate(x) for x in zip(*found))
        places.append((at, suffixes._pack(at, at - last, at - first, np.zeros(len(at), np.int64))))
    cores = Counter(t[i : i + core] for t, (at, _) in zip(docs, places) for i in at.tolist())
    for k in range(n_runs):
        rows = []
        for n in range(k, len(docs), n_runs):
            at, packed = places[n]
            again = [cores[docs[n][i : i + core]] > 1 for i in at.tolist()]
            rows.append({"text": docs[n].decode(), "k1": n, "k2": 0, "packed": packed[np.array(again, bool)].tolist()})
        kinds = pa.schema([("text", pa.string()), ("k1", pa.int64()), ("k2", pa.int64()), ("packed", pa.list_(pa.int64()))])
        runs += list(suffixes._sorted_runs(size, spread, 1)(iter([pa.RecordBatch.from_pylist(rows, kinds)])))
    ordered = pa.Table.from_batches(runs).sort_by([("bucket", "ascending"), ("run", "ascending"), ("part", "ascending")])
    gone = [bytearray(len(t)) for t in docs]
    for batch in suffixes._merge_buckets(size, spread)(iter(ordered.to_batches())):
        for r in batch.to_pylist():
            gone[r["k1"]][r["start"] : r["stop"]] = b"\1" * (r["stop"] - r["start"])
    return gone


@pytest.mark.parametrize("row", [2, 3, 512])
def test_runs_of_several_parts_lose_no_repeats(monkeypatch, row):
    monkeypatch.setattr(suffixes, "_ROW", row)
    for seed in range(6):
        docs = [t.encode() for _, t in texts(seed) if t and len(t.encode()) >= 40]
        seen = Counter(t[i : i + 40] for t in docs for i in range(len(t) - 39))
        expected = [bytearray(len(t)) for t in docs]
        for t, gone in zip(docs, expected):
            for i in range(len(t) - 39):
                if seen[t[i : i + 40]] > 1:
                    gone[i : i + 40] = b"\1" * 40
        assert spans_of_runs(docs, 40, 20, 4) == expected


def test_passages_of_over_fifty_words_on_both_sides_of_the_limit(spark):
    """A passage that repeats across documents goes if it has 400 bytes, whatever its words; shorter ones stay."""
    r = random.Random(12)
    used = set()

    def word(n):
        while True:
            w = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
            if w not in used:
                used.add(w)
                return w

    def passage(words, size):
        """So many words in exactly so many bytes."""
        letters = size - (words - 1)
        return " ".join(word(letters // words + (i < letters % words)) for i in range(words))

    rows, expected = [], {}
    for at, (words, size) in enumerate([(51, 357), (51, 399), (51, 400), (55, 399), (55, 401), (60, 394), (60, 400), (60, 480)]):
        shared = passage(words, size)
        assert len(shared.split()) == words and len(shared) == size
        for copy in range(3):
            doc = 10 * at + copy
            # Other letters around it, so that nothing beside the passage is shared.
            rows.append((doc, f"{passage(20, 150)}{'<[{'[copy]}{shared}{'>]}'[copy]}{passage(20, 150)}"))
            expected[doc] = size if size >= 400 else 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.n_removed for x in suffixes.remove_repeats(docs).collect()} == expected
