import random

import numpy as np
import xxhash

from tabguard.llm.components import components
from tabguard.llm.simhash import fingerprint_links, home_anchor, keep_representatives, near_duplicates, text_fingerprint


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """prints: list of (id, fingerprint) -> smallest id reachable, over all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprint_by_definition():
    r = random.Random(1)
    alphabet = ["Ab", "ÄB", "x", " ", "日本", "B", "b"]
    for n in (0, 1, 2, 3, 4, 50, 300):
        text = "".join(r.choice(alphabet) + r.choice(" \t\n\r\x0b\x0c ") for _ in range(n))
        assert text_fingerprint(text.encode()) == plain_fingerprint(text)
    assert text_fingerprint(None) == 0


def test_code_covers_all_halves_within_one_bit():
    halves = np.random.default_rng(2).integers(0, 2**32, 20000, np.uint64).astype(np.uint32)
    home = home_anchor(halves)
    assert np.bitwise_count(halves ^ home).max() == 1
    assert (home_anchor(home) == home).all()


def test_links_of_close_fingerprints_are_complete(spark):
    r = random.Random(3)
    prints = set()
    for _ in range(60):
        p = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            prints.add(p)
            for _ in range(r.randint(1, 4)):
                p ^= 1 << r.randrange(64)
    prints |= {0, 1, 3, 7, 15, 2**64 - 1, 2**63}
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    expected = plain_components([(s, p) for s, p in zip(signed, prints)])
    for cell in (2048, 2):  # the second deals every anchor out as a grid
        roots = {x.node: x.root for x in components(fingerprint_links(frame, cell=cell)).collect()}
        assert [roots.get(s, s) for s in signed] == expected


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_with_nulls_ties_and_extra_columns(spark):
    long_text = " ".join(f"word{i % 977}" for i in range(30000))
    texts = [(5, "one two three four"), (2, "ONE two\tthree four"), (9, None), (8, ""), (8, " \n"), (None, "one two three four"), (None, "lonely words here now"), (4, long_text), (3, long_text + " end")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, fp string, component_id int")
    rows = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()]
    prints = [(i, plain_fingerprint(t)) for i, t in texts]
    expected = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    kept = keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "8", "None"]
    assert near_duplicates(docs.limit(0)).count() == 0
