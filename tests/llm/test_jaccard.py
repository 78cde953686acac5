import random
from collections import Counter

import numpy as np
import pytest

from tabguard.llm.jaccard import Join, set_links, shingle_hashes, similar_documents


def plain_set(text, words=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    parts = [w for w in low.split(" ") if w]
    if not parts:
        return frozenset()
    return frozenset(tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1)))


def plain(rows):
    """rows: (id, text) -> (id, size, smallest id reachable), all pairs compared."""
    sets = [plain_set(t) for _, t in rows]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 85 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            least[find(s)] = min(doc, least.get(find(s), doc))
    return [(doc, len(s), least.get(find(s)) if s else doc) for (doc, _), s in zip(rows, sets)]


def corpus(seed, n):
    """Families of near copies around the limit, chains, texts that share most with others, short and odd texts."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + str(r.randrange(60))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n\t", "One two", "one\vTWO", "one two three four", "ONE two  three four", "ÄB c d e", "äB c d e"]
    for _ in range(n):
        base = [word() for _ in range(r.choice([3, 4, 5, 20, 60, 150]))]
        if r.random() < 0.4:
            base = passage + base[: r.choice([1, 3, 8, 20])]
        for _ in range(r.choice([1, 1, 2, 5, 12])):
            texts.append(r.choice([" ", "\n"]).join(base))
            for _ in range(r.choice([0, 1, 1, 2])):
                base = list(base)
                base[r.randrange(len(base))] = word()
    r.shuffle(texts)
    return [(None if i % 17 == 0 else (i * 7) % (n * 9), t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3, "y") for i, t in rows], "doc_id long, text string, key string, n int, root string")


@pytest.mark.parametrize("join", [Join(), Join(chunk=500, bucket=64, central=1), Join(at_once=0, central=2), Join(at_once=3000, central=3)])
def test_components_equal_brute_force(spark, join):
    rows = corpus(len(str(join)), 90)
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(frame(spark, rows), join=join).collect()]
    expected = plain(rows)
    assert Counter(found) == Counter(expected)
    assert sum(c != d for d, _, c in expected if d is not None) > 40


def test_sets_of_one_task_equal_brute_force():
    r = np.random.default_rng(3)
    for _ in range(20):
        base = [r.choice(400, 40, replace=False) for _ in range(4)]
        sets = []
        for _ in range(60):
            s = set(base[r.integers(4)].tolist())
            for _ in range(r.integers(0, 4)):
                s.discard(int(r.choice(list(s))))
                s.add(int(r.integers(400)))
            sets.append(np.array(sorted(s)))
        sets = [np.array(x) for x in {tuple(s.tolist()) for s in sets}]
        n = np.array([len(s) for s in sets])
        prefixes = [s[: len(s) - -(-85 * len(s) // 100) + 1] for s in sets]
        edges = set_links(n, np.arange(len(sets)), prefixes, sets, Join(central=2))
        label, want = list(range(len(sets))), list(range(len(sets)))
        for x, y in edges:
            label = [label[x] if v == label[y] else v for v in label]
        for x in range(len(sets)):
            for y in range(x):
                if 100 * len(set(sets[x]) & set(sets[y])) >= 85 * len(set(sets[x]) | set(sets[y])):
                    want = [want[x] if v == want[y] else v for v in want]
        assert {frozenset(i for i, v in enumerate(label) if v == u) for u in label} == {frozenset(i for i, v in enumerate(want) if v == u) for u in want}


def test_hashes_of_long_and_empty_texts(spark):
    assert len(shingle_hashes(None, 4)) == len(shingle_hashes(b" \n ", 4)) == 0
    text = " ".join(f"w{i % 70001}" for i in range(140100))
    assert len(shingle_hashes(text.encode(), 4)) == 70001
    rows = [(5, text), (3, text + " end"), (4, "w1 w2 w3 w4"), (9, None)]
    assert sorted(tuple(r) for r in similar_documents(frame(spark, rows)).collect()) == [(3, 70002, 3), (4, 1, 4), (5, 70001, 3), (9, 0, 9)]
    assert similar_documents(frame(spark, [])).collect() == []
