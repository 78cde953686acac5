import dataclasses
import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tabguard.llm.alignment import Fragment, Tokenizers, align, fragment, split_text
from tabguard.llm.queries import TOKENIZER_PAIR


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(TOKENIZER_PAIR.byte_file)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=TOKENIZER_PAIR.piece_file)


@pytest.fixture(scope="module")
def loaded():
    return Tokenizers(TOKENIZER_PAIR)


def plain(libraries, loaded, texts):
    """Rows of counts and digests by the libraries and by definition."""
    a_lib, b_lib = libraries
    groups, links = [], []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        if not text or b"".join(loaded.bytes_a[i] for i in a) != raw or b"".join(loaded.bytes_b[i] for i in b) != raw:
            groups.append([])
            links.append([])
            continue
        ends = [np.cumsum([len(t[i]) for i in x]).tolist() for x, t in ((a, loaded.bytes_a), (b, loaded.bytes_b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        own = []
        for low, high in zip([0, *cuts], cuts):
            own.append([[i for i, e in zip(x, es) if low < e <= high] for x, es in ((a, ends[0]), (b, ends[1]))])
        groups.append(own)
        links.append([(x, y) for x, e in zip(a, ends[0]) for y in [dict(zip(ends[1], b)).get(e)] if y is not None])
    counts = Counter(p for own in links for p in own)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    rows = []
    for own, pairs in zip(groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        rows.append(
            (sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if own else "")
        )
    return rows


def odd_texts(n, seed=3):
    r = random.Random(seed)
    words = ["the", "Über", "naïve", "日本語", "don't", "x" * 40, "12345", "🙂🙃", "<0x41>", "<s>", "</s>", "<|endoftext|>", "á", " ", "　", "мир", "...", "--", "​", "﻿", "ﬁ", "'s"]
    blanks = [" ", " ", "  ", "\n", "\t", "", "\r\n", "   ", "\n\n"]
    return ["".join(r.choice(words) + r.choice(blanks) for _ in range(r.randint(1, 60))) for _ in range(n)]


def test_tokens_equal_the_libraries(libraries, loaded):
    texts = [t for t in odd_texts(300)] + ["a" * 3000, " " * 500 + "x", "\n" * 300, "▁", "x ▁y"]
    a, b, same = loaded.encode(texts)
    assert a == [e.ids for e in libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert b == [libraries[1].encode(t) for t in texts]
    assert not same[-2:].any() and same.any()
    # Every entry is its own encoding, so merging by bytes and merging by listed pairs take the same steps.
    model = libraries[0].model
    letters = {i: t for t, i in libraries[0].get_vocab(with_added_tokens=False).items()}
    for i, piece in enumerate(loaded.bytes_a):
        if piece:
            assert [x.id for x in model.tokenize(letters[i])] == [i]


def test_pieces_of_a_text_give_the_tokens_of_the_whole(loaded):
    assert loaded.divisible
    for text in odd_texts(60, 8):
        whole = loaded.encode([text])
        parts = split_text(text, 20, True)
        assert "".join(parts) == text
        found = loaded.encode([p if i == 0 else p[1:] for i, p in enumerate(parts)])
        assert sum(found[0], []) == whole[0][0] and sum(found[1], []) == whole[1][0]
    assert split_text("a b c", 1, False) == ["a b c"]


def test_fragments_are_a_monoid(loaded):
    r = random.Random(4)
    for text in odd_texts(25, 5):
        (a,), (b,), (same,) = loaded.encode([text])
        if not same:
            continue
        a, b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(loaded.length_a[a]), np.cumsum(loaded.length_b[b])
        parts, total_links = [], 0
        for low in range(0, int(ends_a[-1]), 7):
            in_a, in_b = ((e > low) & (e <= low + 7) for e in (ends_a, ends_b))
            f, links = fragment(loaded, a[in_a], ends_a[in_a], b[in_b], ends_b[in_b])
            parts.append(f)
            total_links += len(links)
        whole, _ = fragment(loaded, a, ends_a, b, ends_b)
        left = reduce(lambda x, y: x + y, parts, Fragment())
        while len(parts) > 1:  # any two neighbours first
            i = r.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts[0] == left == whole and left.cuts == total_links
        assert not left.tail_a and not left.tail_b and left + Fragment() == left


@pytest.mark.parametrize("span, sent", [(1 << 15, 1 << 20), (64, 1 << 20), (200, 0)])
def test_documents_equal_brute_force(spark, libraries, loaded, span, sent):
    texts = odd_texts(40) + [None, "", "plain words here", "plain words here", "x ▁y " * 60, "z" * 700, " lead", "one two three four five six seven " * 30]
    texts += [texts[0], texts[-1], texts[-1]]  # copies of short and long texts
    docs = spark.createDataFrame([(i // 2 if i % 9 else None, t, i, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, row long, links string, weight int")
    pair = dataclasses.replace(TOKENIZER_PAIR, span=span, sent=sent, fan=3)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = [tuple(r[n] for n in names) for r in align(docs, pair).collect()]
    expected = [(i // 2 if i % 9 else None, *row) for i, row in enumerate(plain(libraries, loaded, texts))]
    assert Counter(found) == Counter(expected)


def test_empty_input(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align(docs, TOKENIZER_PAIR).collect() == []
