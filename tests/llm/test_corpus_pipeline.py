import hashlib
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece
from test_lines_and_pieces import plain_lines
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from tabguard.llm import langid, mixing
from tabguard.runtime import scratch_path

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "simhash", "mixing", "tokens"]

    model = langid.train_on_documents(docs)
    known = langid.Predictor(model)
    first = stages["language"](spark, docs, SMALL)
    assert first.schema == docs.schema
    assert Counter(first.collect()) == Counter(r for r in given if known.one(r.text)[0] != "und")
    assert first.count() >= 0.98 * len(given)

    rows = first.collect()
    second = stages["lines"](spark, first, SMALL)
    expected = plain_lines([(r.doc_id, r.text) for r in rows])
    assert second.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in second.collect()) == Counter((d, t, len(t)) for d, _, _, t in expected)

    prints = [(d, plain_fingerprint(t)) for d, _, _, t in expected]
    third = stages["simhash"](spark, second, SMALL)
    assert sorted(r.doc_id for r in third.collect()) == sorted({c for c in plain_components(prints)})

    fourth = stages["mixing"](spark, third, SMALL)
    kept = {r.doc_id for r in mixing.mix(third).collect() if r.kept}
    assert {r.doc_id for r in fourth.collect()} == kept and fourth.columns == docs.columns

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tokens = {r.doc_id: r for r in stages["tokens"](spark, fourth, SMALL).collect()}
    for r in fourth.collect():
        ids = library.encode(r.text, add_eos=True)
        assert tokens[r.doc_id].n_tokens == len(ids)
        assert tokens[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert tokens[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_gives_what_the_stages_give(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert Counter(corpus_pipeline.run(spark, SMALL).collect()) == Counter(docs.collect())


#: Names that the stages use for columns of their own.
CLASHING = ["lost_id", "lost_hash", "lost_keys", "keys", "key", "keeper", "best_id", "best_hash", "own_hash", "place", "fp", "text_hash",
            "source_cell", "lang_cell", "topic_cell", "cell_probability", "topic", "tokens", "probability", "kept", "Lost_Id_"]


def odd_documents(spark):
    shared = "this line is held by quite a few documents"
    rows = [(i, f"Words of document {i} " * 12 + f"\n{shared}\nlast line {i}", "en" if i % 3 else "de", "web", 9) for i in range(40)]
    rows += [(50, None, "en", "web", None), (51, "", "en", "web", 0), (52, " \n\t ", None, None, 4), (53, "12 34 ...", "en", None, 9)]
    rows += [(54, "long text " * 40_000 + shared, "en", None, 400_000), (55, "x" * 300_000, None, "book", 300_000)]
    rows += [(None, f"no id here {i} {i}\n{shared}", None, "web", None) for i in range(4)] * 2
    rows += [(60, "the same row given twice, with words", "en", "web", 36)] * 2 + [(60, "another text under the same id", "en", "web", 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *[f"'{c} stays' as {c}" for c in CLASHING]).selectExpr("*", "1 as `a.b`").repartition(4)


def test_stages_keep_odd_rows_and_clashing_columns(spark):
    docs = odd_documents(spark)
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        after.write.parquet(path := scratch_path(spark, "odd"))
        after, given = spark.read.schema(after.schema).parquet(path), before.collect()
        assert after.columns == docs.columns
        rows = after.collect()
        assert all(r[c] == f"{c} stays" for r in rows for c in CLASHING)
        if name == "language":
            assert Counter(rows) == Counter(r for r in given if any(c.isalpha() for c in r.text or ""))
        elif name == "lines":
            assert Counter((r.doc_id, r.text) for r in rows) == Counter((d, t) for d, _, _, t in plain_lines([(r.doc_id, r.text) for r in given]))
        elif name == "simhash":
            prints = [plain_fingerprint(r.text) for r in given]
            # numbers stand for ids, so that rows without id and repeated ids are told apart
            groups = {}
            for r, c in zip(given, plain_components(list(enumerate(prints)))):
                groups.setdefault(c, []).append(r)
            assert len(rows) == len(groups)
            least = Counter(min((r.doc_id for r in g if r.doc_id is not None), default=None) for g in groups.values())
            assert Counter(r.doc_id for r in rows) == least and not Counter(rows) - Counter(given)
        else:
            kept = Counter(r.doc_id for r in mixing.mix(before).collect() if r.kept)
            assert Counter(r.doc_id for r in rows) == kept
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(r.doc_id for r in before.collect())
    whole = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = Counter((r.doc_id, len(library.encode(r.text or "", add_eos=True))) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in whole) == counts


def test_stages_of_an_empty_table(spark):
    docs = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_found_languages_reach_the_mixing_stage(spark):
    words = {"en": "the house and the garden ", "de": "das Haus und der Garten "}
    rows = [(i, f"{words[k] * 8}{i}", k, "web", 9) for k in words for i in range(60 * (k == "de"), 60 * (k == "de") + 60)]
    aside = next(i for i in range(300, 400) if zlib.crc32(str(i).encode()) % 4 == 2)  # the model has not seen this row's label
    rows += [(200, words["de"] * 8, None, "web", 9), (201, words["de"] * 8, "en", "web", 9), (aside, words["de"] * 8, "xx", "web", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = dict(corpus_pipeline.STAGES)["language"](spark, docs, SMALL)
    assert found.schema == docs.schema
    expected = Counter(rows) - Counter(r for r in rows if r[0] in (200, 201)) + Counter((i, words["de"] * 8, "de", "web", 9) for i in (200, 201))
    assert Counter(map(tuple, found.collect())) == expected
    # all rows that share a cell share the probability, so those with a German text are now mixed alike
    odds = {r.doc_id: r.probability for r in mixing.mix(found).collect()}
    assert odds[200] == odds[201] == odds[100] != odds[10]


def test_stages_bound_the_bytes_of_a_batch(spark):
    """64 texts of 200 KB in one partition come in batches of a few MB, not in one of 13 MB."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 64, 1, 1).selectExpr("repeat('wide text ', 20000) AS text")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(setting)
        stage(spark, empty, "")
        found = texts.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in found) == 64, name
        assert max(r.bytes for r in found) <= 4 << 20, name
