import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tabguard.llm import langid, mixing, neighbours, quality

DATA = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.predict_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = [(i, "the house and the garden " * 3, "en") for i in range(40)] + [(100 + i, "das Haus und der Garten " * 3, "de") for i in range(40)]
    docs = spark.createDataFrame(rows + [(200, None, "en"), (201, "no label", None)], "doc_id long, text string, lang string")
    model = langid.train_on_documents(docs)
    assert model.languages == ("de", "en")
    odd = [(1, None), (2, ""), (3, "12 + 34 = ?"), (None, "the garden"), (5, "der Garten " * 200_000), (5, "und das Haus")]
    frame = spark.createDataFrame([(i, t, "en", 1) for i, t in odd], "doc_id long, text string, lang_pred string, score int")
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(frame, model).collect()}
    assert found == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de")}
    kept = langid.keep_identified(frame, model)
    assert kept.columns == frame.columns and kept.count() == 3
    empty = langid.predict_documents(docs.limit(0))
    assert empty.count() == 0
    unlabelled = langid.predict_documents(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_only_texts_without_letters_are_rejected(spark):
    few = [(i, "the house and the garden " * 3, "en") for i in range(40)] + [(100 + i, "das Haus und der Garten " * 3, "de") for i in range(40)]
    few += [(200 + i, "la casa e il giardino " * 3, "it") for i in range(40)]
    docs = spark.createDataFrame(few, "doc_id long, text string, lang string")
    model = langid.train_on_documents(docs)
    odd = ["zq", "the casa der", "qqq ђћ", "日本", "12 + 3", "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    assert min(langid.Predictor(model).one(t)[1] for t in odd[:4]) < 0.5
    nothing = langid.train_on_documents(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert not nothing.languages
    for m in (model, nothing):
        assert [r.doc_id for r in langid.keep_identified(frame, m).orderBy("doc_id").collect()] == [0, 1, 2, 3]


def test_sample_is_bounded_in_total():
    s = langid.Settings()
    assert langid.most_per_language([10**6] * 4, s) == s.sample_per_language
    sizes = [3, 40] + [10**6] * 50
    most = langid.most_per_language(sizes, s)
    assert most > 40 and abs(sum(min(v, most) for v in sizes) - s.sample_total) < 1e-6


def test_counting_in_pieces_counts_the_same(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé ") for _ in range(1000))
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "_PIECE", 7)
    assert (langid.ngram_counts(text) == whole).all() and whole.sum() == 1000 + 999 + 998


def test_temperature_lowers_the_loss():
    r = np.random.default_rng(1)
    target = r.integers(0, 3, 400)
    scores = 8 * (np.eye(3)[np.where(r.random(400) < 0.7, target, r.integers(0, 3, 400))])
    assert langid.fit_temperature(scores, target) > 2


def exact_neighbours(ids, x, k=20, every=20):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = x @ q
            near = sorted((-v, j) for v, j in zip(s, ids) if j != i)[:k]
            out[i] = [j for _, j in near]
    return out


def test_neighbours_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    true = exact_neighbours(ids, x)
    found = defaultdict(list)
    for r in neighbours.search(spark.read.parquet(f"{folder}/embeddings.parquet")).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    assert set(found) == set(true)
    hits = sum(len({r.vec_id for r in found[q]} & set(near)) for q, near in true.items())
    assert hits / sum(map(len, true.values())) >= 0.9
    place = {v: i for i, v in enumerate(ids)}
    for q, near in found.items():
        assert [r.rank for r in near] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in near] == sorted((-r.score, r.vec_id) for r in near)
        assert all(abs(r.score - x[place[q]] @ x[place[r.vec_id]]) < 1e-12 for r in near)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (40, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (60, [-2.0, 0.0])]
    rows += [(100 + i, [3.0, 4.0]) for i in range(50)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, key string")
    found = defaultdict(list)
    for r in neighbours.search(frame, k=5).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert found[20] == [(100 + i, 3.0) for i in range(5)]
    assert found[60] == [(2, -1.0), (1, -2.0), (20, -2.0), (100, -6.0), (101, -6.0)]
    assert found[100] == [(101 + i, 25.0) for i in range(5)] and 40 not in found
    assert neighbours.search(frame.limit(0)).count() == 0
    assert neighbours.search(frame.where("vec_id in (20, 1)"), k=5).count() == 1


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([("a", "en", "x", 900), ("a", "de", "x", 50), ("b", "en", "y", 30), ("b", "de", "x", 20), ("a", "en", "y", 0)], "source string, lang string, topic string, tokens long")
    shares = {"source": [("a", 0.6), ("b", 0.4), ("unseen", 0.5)], "lang": [("en", 0.7), ("de", 0.3)], "topic": [("x", 0.8), ("y", 0.2)]}
    targets = {d: spark.createDataFrame(v, "value string, share double") for d, v in shares.items()}
    rows = mixing.rake(cells, targets, rounds=12).collect()
    total = sum(r.weight for r in rows)
    assert abs(total - 1000) < 1e-6
    for dim, wanted in (("source", {"a": 0.6, "b": 0.4}), ("lang", {"en": 0.7, "de": 0.3}), ("topic", {"x": 0.8, "y": 0.2})):
        for value, share in wanted.items():
            assert abs(sum(r.weight for r in rows if r[dim] == value) / total - share) < 1e-2


def test_no_plan_of_raking_holds_more_than_one_round(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "words " * (i % 7 + 1), f"s{i % 3}", "ende"[i % 2 :]) for i in range(60)], "doc_id long, text string, source string, lang string")
    windows, really = [], mixing.saved

    def seen(df, label):
        windows.append(df._jdf.queryExecution().optimizedPlan().toString().count("Window "))
        return really(df, label)

    monkeypatch.setattr(mixing, "saved", seen)
    assert mixing.mix(docs).count() == 60
    assert max(windows) == len(mixing.DIMENSIONS)


def test_mixing_edge_cases(spark):
    rows = [(1, "a b", "s", "en"), (None, "c", None, None), (2, None, "s", "en"), (3, " \n", "s", "en"), (4, "x | y " * 9, "t", "en"), (4, "#$%", "t", "en")]
    docs = spark.createDataFrame([(*r, "z", "w") for r in rows], "doc_id long, text string, source string, lang string, topic string, weight string")
    found = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.n_tokens, r.topic) for r in found) == Counter([(1, 2, "prose"), (None, 1, "prose"), (2, 0, "(none)"), (3, 0, "prose"), (4, 27, "table"), (4, 1, "symbols")])
    assert all(0 < r.probability <= 1 if r.n_tokens else r.probability == 0 and not r.kept for r in found)
    assert max(r.probability for r in found) == 1
    kept = Counter(r.doc_id for r in found if r.kept)
    assert Counter(r.doc_id for r in mixing.sample_mix(docs).collect()) == kept
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.sample_mix(docs.limit(0)).count() == 0


def plain_counts(text):
    words = [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + o for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for o in range(3)}
    own = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(own) - len(set(own)), len(covered)


def test_quality_counts_equal_brute_force(spark):
    r = random.Random(5)
    texts = ["", " ", "a", "a b", "a b c", "a b c a b c", "a a a a a a", "#x|y\n#x|y\n \n\n#x|y ", "a b c " * 30000]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 30))).replace(" b", r.choice(["\nb", "\t b", " é"])) for _ in range(80)]
    rows = [(i, t, r.choice(["en", None]), r.choice(["s", "t", None])) for i, t in enumerate(texts)] + [(None, None, None, None), (1, "again", "en", "s")]
    docs = spark.createDataFrame([(*x, "q", 1) for x in rows], "doc_id long, text string, lang string, source string, words string, n int")
    found = quality.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((x.doc_id, *(x[n] for n in names)) for x in found) == Counter((d, *plain_counts(t or "")) for d, t, _, _ in rows)
    assert all(x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words) and not (x.base_failed and x.kept) for x in found)
    assert quality.judge(docs.limit(0)).count() == 0


def test_windows_of_other_words_with_the_same_hash_are_no_repeats(spark):
    same_hash = ["eszycidp yopumzgd pamntyya", "woixzhsd trcjrvct ZDlfzuN3"]
    texts = [f"{same_hash[0]} x {same_hash[1]}", f"{same_hash[0]} x {same_hash[1]} y {same_hash[0]}", " z ".join(same_hash * 2)]
    found = quality.counts(spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string"))
    assert {r.doc_id: r.n_repeat_words for r in found.collect()} == {i: plain_counts(t)[4] for i, t in enumerate(texts)}


def test_fences_adapt_to_language_and_source(spark):
    def text(i, length):
        return " ".join("w" * length + str(j * i % 89) for j in range(1, 70))

    rows = [(i, text(i, 3), "en", "a") for i in range(80)] + [(100 + i, text(i, 18), "de", "b") for i in range(80)]
    rows += [(300, text(7, 18), "en", "a"), (301, text(7, 3), "de", "b"), (302, "% ".join(map(str, range(900, 990))), "en", "a"), (303, text(5, 3), "en", "rare")]
    found = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [found[i] for i in (5, 105, 300, 301, 302, 303)] == [True, True, False, False, False, True]


def test_ties_of_orthogonal_vectors_stay_bounded(spark):
    """All scores are zero: the smallest ids are nearest, and no more than two lists a query leave a block."""
    n = 64
    rows = [(i, [1.0 if j == i else 0.0 for j in range(n)]) for i in range(n)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.search(frame, k=3).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == {q: [(i, 0.0) for i in range(5) if i != q][:3] for q in range(0, n, 20)}
    r = np.random.default_rng(1)
    for scores in (np.zeros((4, 5000)), r.integers(0, 3, (4, 5000)) / 3, r.normal(size=(4, 5000))):
        first = r.permutation(5000)
        i, j = neighbours._best(scores + r.normal(0, 1e-14, scores.shape), 21, first)
        assert np.bincount(i).max() <= 42
        for q in range(4):
            want = sorted(range(5000), key=lambda c: (-scores[q, c], first[c]))[:21]
            assert set(want) <= set(j[i == q].tolist())
