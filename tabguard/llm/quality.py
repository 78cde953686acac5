"""Quality rules with adaptive thresholds.

Every document gets counts over its whole text. Quantile sketches (mergeable summaries, built per task and merged)
of four rates are kept per language and source, per language, and overall; fences around the middle half replace
fixed cutoffs. A document is joined with the fences of its language and source, or with the next coarser ones where
a group is too small. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, saved

_BLANKS = " \t\n\x0b\x0c\r"
_BLANK_CLASS = r"[\x20\x09-\x0D]+"
#: Quantiles come from sketches of this accuracy (rank error at most 1 / ACCURACY of a group).
ACCURACY = 10_000
#: A group needs so many documents for fences of its own.
LEAST_DOCS = 50
#: Fences lie this many spreads outside the quartiles; a spread is the distance of the quartiles or the given least.
REACH = 4.0
LEAST_SPREAD = {"word_length": 0.5, "symbol_rate": 0.05, "dup_line_rate": 0.1, "repeat_rate": 0.1}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the counts n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words of whole texts.

    Repeats are found without leaving the row: hashes of the 3-word windows, with the window's place in the low bits,
    are sorted, and windows with an equal neighbour may repeat. Those are sorted again by their words, so that what
    hashes alone have in common does not count; the words under windows that repeat are counted once each.
    """
    rows = keyed(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    rows = rows.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("bare", F.btrim(F.col("text"), F.lit(_BLANKS)))
    words = F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(F.split("bare", _BLANK_CLASS))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    rows = rows.select("doc_id", "lang", "source", words.alias("words"), lines.alias("lines"), F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    rows = rows.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("w"),
        F.greatest(F.size("words") - 2, F.lit(0)).alias("m"),
    )
    kept = ["doc_id", "lang", "source", "n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    bits = F.ceil(F.log2(F.col("m") + 2)).cast("int")
    kept.append("words")
    rows = rows.select(*kept, "m", bits.alias("b"), F.expr(
        "zip_with(slice(w, 1, m), zip_with(slice(w, 2, m), slice(w, 3, m), (x, y) -> xxhash64(x, y)), (x, y) -> xxhash64(x, y))"
    ).alias("w"))
    rows = rows.select(*kept, "m", "b", F.sort_array(F.expr("transform(w, (h, i) -> shiftleft(h, b) | cast(i as bigint))")).alias("s"))
    rows = rows.select(*kept, F.expr("shiftleft(1L, b) - 1").alias("low"), F.expr(
        "filter(zip_with(slice(s, 1, greatest(m - 1, 0)), slice(s, 2, greatest(m - 1, 0)), "
        "(x, y) -> if(shiftright(x, b) = shiftright(y, b), named_struct('x', x, 'y', y), null)), d -> d is not null)"
    ).alias("d"))
    rows = rows.select(*kept, F.expr("sort_array(array_distinct(concat(transform(d, p -> p.x & low), transform(d, p -> p.y & low))))").alias("p"))
    rows = rows.select(*kept, F.expr(
        "sort_array(transform(p, i -> named_struct('g', concat_ws(' ', slice(words, cast(i as int) + 1, 3)), 'i', i)))"
    ).alias("c"))
    rows = rows.select(*kept, F.expr(
        "filter(zip_with(slice(c, 1, greatest(size(c) - 1, 0)), slice(c, 2, greatest(size(c) - 1, 0)), "
        "(x, y) -> if(x.g = y.g, named_struct('x', x.i, 'y', y.i), null)), d -> d is not null)"
    ).alias("d"))
    kept.remove("words")
    rows = rows.select(*kept, F.expr("sort_array(array_distinct(concat(transform(d, p -> p.x), transform(d, p -> p.y))))").alias("p"))
    covered = F.expr(
        "aggregate(p, named_struct('last', -3L, 'n', 0L), "
        "(a, x) -> named_struct('last', x, 'n', a.n + least(3L, x - a.last)), a -> a.n)"
    )
    return rows.select(*kept, covered.alias("n_repeat_words"))


def _rates() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / n,
        "symbol_rate": F.col("n_symbols") / n,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_rate": F.col("n_repeat_words") / n,
    }


def fences(measured: DataFrame) -> DataFrame:
    """Per group (lang, source, level) of the documents that pass the base rules: number and fences of each rate.

    Level 0 is language and source, 1 language, 3 all; nulls are a language or source of their own.
    """
    usable = measured.where(~F.col("base_failed")).select("lang", "source", *[c.alias(k) for k, c in _rates().items()])
    sketches = [F.percentile_approx(k, F.array(F.lit(0.25), F.lit(0.75)), ACCURACY).alias(k) for k in LEAST_SPREAD]
    # the coarser levels get the rows anew, as Spark's sketches are merged inside one aggregation only
    grouped = usable.groupingSets([["lang", "source"], ["lang"], []], "lang", "source").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), *sketches
    )
    out = ["lang", "source", "level", "n"]
    for k, least in LEAST_SPREAD.items():
        low, high = F.col(k)[0], F.col(k)[1]
        reach = F.greatest(high - low, F.lit(least)) * REACH
        out += [(low - reach).alias(f"{k}_low"), (high + reach).alias(f"{k}_high")]
    return grouped.select(*out)


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS
) -> DataFrame:
    """Per row: doc_id, the counts, base_failed and kept.

    ``base_failed``: under 50 words, or more than half of the words in repeated 3-word windows. ``kept``: base rules
    passed and symbol, duplicate-line and repeat rates not above, word length within the fences of the group. A
    group of fewer than ``least_docs`` passing documents uses its language's fences, then those of all. Null texts
    have zero counts (and fail); null languages and sources are groups of their own. Repeated ids and rows each give
    a row, other columns are ignored, an empty input gives an empty result.
    """
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    measured = saved(counts(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", base), "measured")
    found = saved(fences(measured), "fences")
    bounds = [c for c in found.columns if c.endswith(("_low", "_high"))]
    level = {
        i: found.where((F.col("level") == v) & ((F.col("n") >= least_docs) | F.lit(v == 3))).select(
            F.col("lang").alias("l"), F.col("source").alias("s"), F.struct(*bounds).alias(f"f{i}")
        )
        for i, v in enumerate((0, 1, 3))
    }
    same_lang, same_source = F.col("lang").eqNullSafe(F.col("l")), F.col("source").eqNullSafe(F.col("s"))
    joined = measured.join(level[0], same_lang & same_source, "left").drop("l", "s")
    joined = joined.join(level[1].drop("s"), same_lang, "left").drop("l")
    joined = joined.join(F.broadcast(level[2].select("f2")), F.lit(True), "left")  # at most one row
    joined = joined.withColumn("f", F.coalesce("f0", "f1", "f2"))
    r = _rates()
    inside = (r["word_length"] >= F.col("f.word_length_low")) & (r["word_length"] <= F.col("f.word_length_high"))
    for k in ("symbol_rate", "dup_line_rate", "repeat_rate"):
        inside &= r[k] <= F.col(f"f.{k}_high")
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
