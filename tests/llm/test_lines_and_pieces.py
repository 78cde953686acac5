import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece

from tabguard.llm import lines, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_lines(rows, least_chars=20, least_docs=3):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k].append(doc)
    bad = {}
    for k, docs in holders.items():
        if len(docs) >= least_docs:
            bad[k] = max((d for d in docs if d is not None), default=None)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not (key(x) in bad and bad[key(x)] != doc)]
        out.append((doc, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def odd_lines():
    r = random.Random(2)
    pool = ["Common line of more than twenty", "  common LINE of more than twenty\t", "ééééééééééééééééééé", "éééééééééééééééééééé", "short", "", "only null ids hold this line"]
    rows = [(r.choice([i, i, i % 7, None]), "\n".join(r.choice(pool[:6] + [f"own line number {i} of this text"]) for _ in range(r.randint(0, 6)))) for i in range(60)]
    rows += [(None, pool[6])] * 3 + [(70, None), (71, ""), (72, "\n\n"), (73, "x" * 200_000 + "\n" + pool[0])]
    return rows + [(i, "\n".join(f"line {j} that some texts share" for j in range(i, i + 5))) for i in range(80, 120)]


@pytest.mark.parametrize("most_bits, hot_part", [(29, 1024), (29, 3), (0, 1024), (0, 1)])
def test_lines_equal_brute_force(spark, monkeypatch, most_bits, hot_part):
    monkeypatch.setattr(lines, "MOST_BITS", most_bits)  # 0: no filter is sent, hashes are counted
    monkeypatch.setattr(lines, "HOT_PART", hot_part)  # 1: no key is hot
    rows = odd_lines()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, keys int").repartition(4)
    found = [(x.doc_id, x.n_lines, x.n_dropped, x.kept_text) for x in lines.dedup_lines(docs).collect()]
    assert Counter(found) == Counter(plain_lines(rows))
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    whole = docs.selectExpr("doc_id", "text", "cast(length(text) as bigint) as n_chars", "keys")
    texts = [(x.doc_id, x.text, x.n_chars) for x in lines.without_repeats(whole).collect()]
    assert Counter(t if t is not None else "" for _, t, _ in texts) == Counter(x[3] for x in plain_lines(rows))
    assert all(n == (None if t is None else len(t)) for _, t, n in texts)


def test_lists_of_lost_lines_are_never_longer_than_a_text(spark):
    rows = [(None, f"line {i} of many null documents\nline {i + 1} of many null documents") for i in range(300)] * 3
    docs = spark.createDataFrame([*rows, (1, "\n".join(t for _, t in rows))], "doc_id long, text string")
    sizes = [len(x["keys"]) for x in lines.repeated_lines(docs).collect()]
    assert len(sizes) == 300 and max(sizes) == 2


def test_filter_grows_with_the_lines(spark):
    rows = odd_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    long = sum(len(x) >= 20 for _, t in rows for x in (t or "").split("\n"))
    assert long <= lines.line_bound(docs, 20) < 2 * long + 10_000  # the line of 200,000 characters could be 10,000 of 20
    assert lines.line_bound(docs.limit(0), 20) == 0
    assert [lines.filter_bits(n) for n in (0, 1 << 14, 1 << 20, (1 << 20) + 1, 1 << 26)] == [17, 17, 23, 24, 29]


@pytest.mark.parametrize("bits", [17, 21, 27])
def test_filters_have_no_false_negatives(bits):
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2**64, 5000, np.uint64), r.integers(0, 2**64, 5000, np.uint64)
    f = lines.TwoFilters(bits)
    f.add(np.concatenate([a, b[:100]]))
    f.add(b)
    assert lines.holds(f.once, a).all() and lines.holds(f.twice, b[:100]).all()
    assert lines.holds(f.twice, a).mean() < 0.01


@pytest.fixture(scope="module")
def both():
    return pieces.Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_encoding_equals_the_library(both):
    own, library = both
    r = random.Random(3)
    alphabet = [" ", "  ", "▁", "a", "e", "the", "in", "\n", "\t", "é", "ü", "😀", "ﬁ", "①", "é", "\x00", "1", "23", ".", ",", "東", "京", " ", "ＡＢ", "tion", "  \n", "\r\n", "<s>", "</s>", "<0x0A>", "​", "﻿", "Z"]
    cases = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(4000)]
    cases += [s for n in (1, 2, 3, 7, 15, 16, 17, 33, 1000) for s in (" " * n, " " * n + "x", "a" + " " * n, "a" * n, "\n" * n, "." * n + "x", "=" * n)]
    for text in cases:
        ids = own.encode(text)
        assert ids == library.encode(text, add_eos=True), text
        assert own.decode(ids) == library.decode(ids), text


def test_decoding_of_any_ids_equals_the_library(both):
    own, library = both
    r = random.Random(4)
    for _ in range(2000):
        ids = [r.randrange(32000) if r.random() < 0.5 else r.randrange(262) for _ in range(r.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_tokens_of_documents(spark, both, monkeypatch):
    import hashlib

    _, library = both
    rows = [(1, None), (2, ""), (2, "twice"), (None, "no id"), (3, "long text " * 50_000), (4, "a" * 100_000)]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ids string")
    found = Counter(map(tuple, pieces.token_digests(docs, PATH).collect()))
    expected = Counter()
    for doc, text in rows:
        ids = library.encode(text or "", add_eos=True)
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        expected[doc, len(ids), *digests] += 1
    assert found == expected
    encoded = pieces.encode_documents(docs, PATH)
    texts = pieces.decode_documents(encoded, PATH)
    assert Counter(r.text for r in texts.collect()) == Counter(t or "" for _, t in rows)
    assert pieces.token_digests(docs.limit(0), PATH).count() == 0


def test_tables_of_parts_turn_over(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(pieces, "PARTS_KEPT", 3)
    texts = ["one two three four five six", "six five four", "one one seven"]
    for text in texts * 2:
        found = [own.part(p) for p in own.cut_parts(text)]
        assert " ".join(f[1] for f in found).split() == [str(i) for i in library.encode(text)]


def test_undone_merges_tell_the_same_as_merging_anew(both):
    own, _ = both
    r = random.Random(6)
    made = [own.ids[t] for t in own.made]
    often = sorted(made, key=lambda i: own.rank[own.texts[i]])[:2000]
    runs = [i for i in made if len(set(own.texts[i])) == 1]
    pairs = [(r.choice(some), r.choice(some)) for some in (made, often, runs) for _ in range(10_000)]
    assert own.uneven and all(own.apart(a, b) == (own.merged(own.texts[a] + own.texts[b]) == [own.texts[a], own.texts[b]]) for a, b in pairs)


def test_parts_are_remembered_by_their_ids_alone():
    own, library = pieces.Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for part in ("▁words", "▁東x", "a\x00b"):
        ids = own.encode_part(part)
        for _ in range(2):  # encoded, then remembered
            assert own.part(part) == (len(ids), " ".join(map(str, ids)), part.replace("▁", " "))
    assert own.parts["▁words"] == " ".join(map(str, library.encode("words")))  # one string each, so that more parts fit
