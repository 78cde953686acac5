"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell of source, language and topic. The cells' weights are raked to the three target
marginals in turn until they fit. A document is then kept with the probability weight / tokens of its cell,
scaled so that the largest is one, by a draw that depends on its id alone. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.llm.common import fresh, keyed, saved

DIMENSIONS = ("source", "lang", "topic")
#: Value that stands for null in a dimension.
NONE = "(none)"
#: Cells up to this number are broadcast to the documents, more are joined by a shuffle.
BROADCAST_CELLS = 50_000
#: Rounds of raking after which the fit is looked at.
ROUNDS_AT_ONCE = 5
#: Powers that flatten the present token shares into targets.
FLATTENED = {"source": 0.9, "lang": 0.9, "topic": 0.95}
_BLANK = r"\x20\x09-\x0D"


def n_tokens(text: Column) -> Column:
    """White-space separated words in the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{_BLANK}]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by the form of the text: table, symbols (a twentieth of it or more) or prose."""
    symbols = F.regexp_count(text, F.lit(r"[#*$%&<>{}=]"))
    return (
        F.when(text.isNull(), NONE).when(F.contains(text, F.lit(" | ")), "table")
        .when((F.length(text) > 0) & (symbols * 20 >= F.length(text)), "symbols").otherwise("prose")
    )


def described(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topic_col: str | None) -> DataFrame:
    """doc_id, tokens and the three dimensions, null values named."""
    columns = {"doc_id": id_col, "text": text_col, "source": source_col, "lang": lang_col}
    rows = keyed(docs, **columns, **({"topic": topic_col} if topic_col else {}))
    topic = F.col("topic") if topic_col else topic_of(F.col("text"))
    named = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in ("source", "lang")]
    return rows.select("doc_id", n_tokens(F.col("text")).alias("tokens"), *named, F.coalesce(topic.cast("string"), F.lit(NONE)).alias("topic"))


def flattened_targets(cells: DataFrame, powers: Mapping[str, float] = FLATTENED) -> dict[str, DataFrame]:
    """Target shares (value, share) per dimension: present token shares to a power, made to sum to one."""
    targets = {}
    for d in DIMENSIONS:
        sums = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
        raised = sums.select("value", F.pow(F.col("t").cast("double"), F.lit(float(powers[d]))).alias("p"))
        targets[d] = raised.crossJoin(F.broadcast(raised.agg(F.sum("p").alias("all")))).select("value", (F.col("p") / F.col("all")).alias("share"))
    return targets


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 10, tolerance: float = 1e-12) -> DataFrame:
    """Cells (source, lang, topic, tokens) with a weight each, in tokens, whose marginals have the target shares.

    Values without a target get weight zero; targets of values without tokens are spread over the others. Stops
    after ``rounds`` or when no factor of a round differs from one by more than ``tolerance``. The sums run over
    cells, never over documents. Each dimension's targets and each round are a job of their own: plans of several
    rounds, which Spark describes anew after every stage, take the driver's memory.
    """
    now = cells.where("tokens > 0").withColumns({"weight": F.col("tokens").cast("double"), "off": F.lit(0.0)})
    for d in DIMENSIONS:  # targets of the values that occur, in tokens
        here = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
        shares = here.join(targets[d], "value").select("value", "share")
        total = shares.agg(F.sum("share").alias("all")).crossJoin(here.agg(F.sum("t").alias("tokens")))
        wanted = shares.crossJoin(F.broadcast(total)).select(F.col("value").alias(d), (F.col("share") / F.col("all") * F.col("tokens")).alias(f"target_{d}"))
        now = saved(now.join(wanted, d, "left"), "raked")
    done = 0
    while done < rounds:
        for _ in range(min(ROUNDS_AT_ONCE, rounds - done)):
            step = now.withColumn("off", F.lit(0.0))
            for d in DIMENSIONS:
                have = F.sum("weight").over(Window.partitionBy(d))
                factor = F.when(have > 0, F.coalesce(f"target_{d}", F.lit(0.0)) / have).otherwise(0.0)
                off = F.greatest("off", F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(0.0))
                step = step.withColumn("factor", factor).withColumns({"off": off, "weight": F.col("weight") * F.col("factor")}).drop("factor")
            now = saved(step, "raked")
            done += 1
        worst = now.agg(F.max("off").alias("off")).first().off
        if worst is None or worst <= tolerance:
            break
    return now.select(*DIMENSIONS, "tokens", "weight")


def keep_probabilities(cells: DataFrame) -> DataFrame:
    """Cells with the probability of their documents: weight per token, the largest scaled to one."""
    rate = cells.select(*DIMENSIONS, (F.col("weight") / F.col("tokens")).alias("rate"))
    return rate.crossJoin(F.broadcast(rate.agg(F.max("rate").alias("most")))).select(
        *DIMENSIONS, F.round(F.when(F.col("most") > 0, F.col("rate") / F.col("most")).otherwise(0.0), 9).alias("probability")
    )


def draw(doc_id: Column, seed: int = 0) -> Column:
    """A number from 0 to below 1 that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def _fitted(rows: DataFrame, targets, rounds: int) -> DataFrame:
    cells = saved(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    found = saved(keep_probabilities(rake(cells, targets or flattened_targets(cells), rounds)), "probabilities")
    return F.broadcast(found) if found.count() <= BROADCAST_CELLS else found


def mix(
    docs: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
    rounds: int = 10,
    seed: int = 0,
) -> DataFrame:
    """Per row: doc_id, n_tokens, topic, probability and kept.

    ``targets`` are (value, share) tables per dimension; without them the present shares are flattened. Null sources,
    languages and topics are a value of their own, ``(none)``. Rows without tokens (null and blank texts) have
    probability zero. Rows that share an id share the draw; a null id has a draw, too. Other columns are ignored.
    An empty input gives an empty result.
    """
    rows = saved(described(docs, id_col, text_col, source_col, lang_col, topic_col), "described")
    found = rows.join(_fitted(rows, targets, rounds), list(DIMENSIONS), "left")
    p = F.when(F.col("tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    return found.select("doc_id", F.col("tokens").alias("n_tokens"), "topic", p.alias("probability"), (draw(F.col("doc_id"), seed) < p).alias("kept"))


def sample_mix(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, rounds: int = 10, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, lang, ...) that ``mix`` keeps, all columns.

    Null sources and languages are values of their own, null and blank texts are never kept, rows that share an id share
    the draw, further columns may have any name, and an empty input gives an empty result.
    """
    rows = described(docs, "doc_id", "text", "source", "lang", None)
    names = fresh(docs, *[f"{d}_cell" for d in DIMENSIONS], "cell_probability")
    cells = _fitted(rows, targets, rounds).select(*DIMENSIONS, "probability").toDF(*names)
    named = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)) for d in ("source", "lang")]
    named.append(F.coalesce(topic_of(F.col("text")), F.lit(NONE)))
    placed = docs.withColumns(dict(zip(names, named))).join(cells, names[:-1])
    kept = placed.where((n_tokens(F.col("text")) > 0) & (draw(F.col("doc_id"), seed) < F.col(names[-1])))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
