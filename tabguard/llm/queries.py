"""The registered queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.demos.registry import query, table
from tabguard.llm import alignment, balls, chat, jaccard, langid, lines, mixing, neighbours, pieces, quality, simhash, suffixes, warc

#: The public merge-type vocabulary that the tokenizing query uses; a path, never a copy.
MODEL_PATH = public_tokenizers.path("piece_bpe_32k.model")
#: The two public vocabularies whose tokens are aligned.
TOKENIZER_PAIR = alignment.Pair(public_tokenizers.path("byte_bpe_50k.json"), MODEL_PATH, public_tokenizers.PATTERN)


@query(
    "op1_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS s FROM p),
    f AS (SELECT s, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY s)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.s AS payload_digest,
        CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id > first_id THEN first_id END AS refers_to
    FROM d LEFT JOIN f ON d.s = f.s
    """,
)
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op4_line_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    bad AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3),
    m AS (SELECT r, doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN bad USING (key))
    SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY r, doc_id
    """,
)
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predict_documents(table(spark, folder, "documents"))


@query("op6_neighbours")
def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"))


def _mixing_sql(rounds: int) -> str:
    """The raking unrolled: every round scales the weights to each marginal in turn."""
    text = r"""
    WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
        coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
        CASE WHEN text IS NULL THEN '(none)' WHEN contains(text, ' | ') THEN 'table'
            WHEN length(text) > 0 AND len(regexp_extract_all(text, '[#*$%&<>{}=]')) * 20 >= length(text) THEN 'symbols'
            ELSE 'prose' END AS topic FROM documents),
    c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)"""
    for dim in mixing.DIMENSIONS:
        text += f""",
    t_{dim} AS MATERIALIZED (SELECT {dim}, pow(t, {mixing.FLATTENED[dim]}) / sum(pow(t, {mixing.FLATTENED[dim]})) OVER () * sum(t) OVER () AS target
        FROM (SELECT {dim}, sum(tokens) AS t FROM c GROUP BY 1)),"""[:-1]
    text += ", w0 AS (SELECT *, tokens AS weight FROM c)"
    at = 0
    for _ in range(rounds):
        for dim in mixing.DIMENSIONS:
            text += f""",
    w{at + 1} AS MATERIALIZED (SELECT w.source, w.lang, w.topic, tokens, weight * (target / sum(weight) OVER (PARTITION BY w.{dim})) AS weight
        FROM w{at} w JOIN t_{dim} USING ({dim}))"""
            at += 1
    return text + f"""
    , p AS (SELECT source, lang, topic, round(weight / tokens / max(weight / tokens) OVER (), 9) AS probability FROM w{at}),
    e AS (SELECT doc_id, tokens, topic, CASE WHEN tokens > 0 THEN coalesce(probability, 0.0) ELSE 0.0 END AS probability
        FROM d LEFT JOIN p USING (source, lang, topic))
    SELECT doc_id, CAST(tokens AS BIGINT) AS n_tokens, topic, probability,
        CAST(('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT)::DOUBLE
            / pow(16::DOUBLE, 13) < probability AS kept FROM e
    """


@query("op7_mixing", _mixing_sql(10))
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query(
    "op8_chat",
    r"""
    WITH t AS (SELECT conv_id, coalesce(turn, -1) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
    s AS (SELECT conv_id, turn, list({'r': role, 't': text} ORDER BY role NULLS FIRST, text NULLS FIRST) AS step FROM t GROUP BY 1, 2),
    c AS (SELECT conv_id, list({'n': turn, 's': step} ORDER BY turn) AS steps FROM s GROUP BY 1),
    longer AS (SELECT DISTINCT a.conv_id FROM c a JOIN c b ON len(b.steps) > len(a.steps)
        AND b.steps[1] = a.steps[1] AND list_slice(b.steps, 1, len(a.steps)) = a.steps),
    top AS (SELECT min(conv_id) AS conv_id FROM c WHERE conv_id NOT IN (SELECT conv_id FROM longer) GROUP BY steps)
    SELECT conv_id, CAST(floor(turn / 512.0) AS BIGINT) AS part, count(*) AS n_turns,
        string_agg('<|' || replace(coalesce(lower(trim(role)), 'unknown'), '|>', '') || '|>' || chr(10)
            || replace(coalesce(text, ''), '<|', '< |') || '<|end|>' || chr(10), ''
            ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS chat
    FROM t WHERE conv_id IN (SELECT conv_id FROM top) GROUP BY 1, 2
    """,
)
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def _quality_sql() -> str:
    rates = list(quality.LEAST_SPREAD)
    parts = []
    for level, by in ((0, "lang, source"), (1, "lang"), (3, "")):
        names = "lang, source" if level == 0 else "lang, NULL AS source" if level == 1 else "NULL AS lang, NULL AS source"
        window = f"PARTITION BY {by}" if by else ""
        columns = []
        for k in rates:
            columns.append(f"max({k}) FILTER (r_{k} = greatest(1, ceil(0.25 * n))) AS {k}_q1, max({k}) FILTER (r_{k} = greatest(1, ceil(0.75 * n))) AS {k}_q3")
        ranks = ", ".join(f"row_number() OVER ({window} {'ORDER BY ' + k}) AS r_{k}" for k in rates)
        parts.append(
            f"SELECT {names}, {level} AS level, max(n) AS n, {', '.join(columns)} FROM "
            f"(SELECT *, count(*) OVER ({window}) AS n, {ranks} FROM rated WHERE NOT base_failed) {'GROUP BY ' + by if by else 'HAVING count(*) > 0'}"
        )
    bounds = ", ".join(
        f"{k}_q1 - {quality.REACH} * greatest({k}_q3 - {k}_q1, {quality.LEAST_SPREAD[k]}) AS {k}_low, "
        f"{k}_q3 + {quality.REACH} * greatest({k}_q3 - {k}_q1, {quality.LEAST_SPREAD[k]}) AS {k}_high"
        for k in rates
    )
    chosen = ", ".join(f"coalesce(a.{k}_{e}, b.{k}_{e}, c.{k}_{e}) AS {k}_{e}" for k in rates for e in ("low", "high"))
    inside = " AND ".join(["word_length BETWEEN word_length_low AND word_length_high", *[f"{k} <= {k}_high" for k in rates[1:]]])
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
    again AS (SELECT r, i, count(*) OVER (PARTITION BY r, w) > 1 AS twice FROM g),
    rep AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM again, range(3) t(o) WHERE twice GROUP BY r),
    ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
    dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    m AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
    rated AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        word_chars / greatest(n_words, 1)::DOUBLE AS word_length, n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_rate,
        n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_rate, n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_rate FROM m),
    q AS ({' UNION ALL '.join(parts)}),
    f AS (SELECT lang, source, level, n, {bounds} FROM q),
    j AS (SELECT rated.*, {chosen} FROM rated
        LEFT JOIN f a ON a.level = 0 AND a.n >= {quality.LEAST_DOCS} AND rated.lang IS NOT DISTINCT FROM a.lang AND rated.source IS NOT DISTINCT FROM a.source
        LEFT JOIN f b ON b.level = 1 AND b.n >= {quality.LEAST_DOCS} AND rated.lang IS NOT DISTINCT FROM b.lang
        LEFT JOIN f c ON c.level = 3)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce({inside}, false) AS kept FROM j
    """


@query("op9_quality", _quality_sql())
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.token_digests(table(spark, folder, "documents"), MODEL_PATH)


def _code_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Assignments and moves unrolled; every part is compared with every entry."""
    text = f"""
    WITH k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT r, p.i AS p, list_slice(v, p.i * len(v) // {parts} + 1, (p.i + 1) * len(v) // {parts}) AS s FROM k, range({parts}) p(i)),
    c0 AS MATERIALIZED (SELECT p, r - 1 AS e, s AS c FROM p WHERE r <= {entries})"""
    for at in range(rounds + 1):
        text += f""",
    a{at} AS MATERIALIZED (SELECT r, p, any_value(s) AS s, min({{'d': d, 'e': e}}) AS best FROM (SELECT r, p.p, s, e,
        CAST(list_sum(list_transform(list_zip(s, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d FROM p JOIN c{at} c ON p.p = c.p) GROUP BY r, p)"""
        if at < rounds:
            text += f""",
    m{at} AS (SELECT p, e, list(x ORDER BY i) AS c FROM (SELECT p, best.e AS e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
        FROM (SELECT p, best, unnest(s) AS x, unnest(range(len(s))) AS i FROM a{at}) GROUP BY 1, 2, 3) GROUP BY p, e),
    c{at + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{at} c LEFT JOIN m{at} m ON c.p = m.p AND c.e = m.e)"""
    return text + f""",
    coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
    books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM k JOIN coded USING (r), books
    """


@query("op11_vector_codes", _code_sql())
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return balls.code_digests(table(spark, folder, "embeddings"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), TOKENIZER_PAIR)


@query("op13_jaccard_join")
def op13_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
