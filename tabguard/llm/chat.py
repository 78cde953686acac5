"""Chat formatting with cumulative-snapshot collapse.

Logs often hold the same conversation again after every turn. A rolling hash of the turns up to each turn (a sum of
turn hashes, so it can be put together from blocks of turns) tells which whole conversations are a prefix of longer
ones; anti-joins leave the maximal conversations, one of equal ones, and only those are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, saved

#: Turns per block: what one window or one rendered row holds at most (unless turn numbers repeat).
BLOCK = 512


def _turn_hash(seed: int) -> Column:
    """A hash of turn number, role and text in which null differs from any string."""
    parts = [F.lit(seed), F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = keyed(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where(F.col("conv_id").isNotNull())
    rows = rows.withColumn("turn", F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long")))
    return rows.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("long"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, n, size): hashes and number of the turns up to each turn, and of all turns of it."""
    hashed = turns.select("conv_id", "block", "turn", _turn_hash(1).alias("h1"), _turn_hash(2).alias("h2"))
    sums = [F.sum("h1").cast("decimal(38,0)").alias("h1"), F.sum("h2").cast("decimal(38,0)").alias("h2")]
    steps = hashed.groupBy("conv_id", "block", "turn").agg(*sums, F.count(F.lit(1)).alias("n"))
    blocks = hashed.groupBy("conv_id", "block").agg(*sums, F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("decimal(38,0)")
    starts = blocks.select(
        "conv_id", "block", F.coalesce(F.sum("h1").over(before), zero).alias("b1"), F.coalesce(F.sum("h2").over(before), zero).alias("b2"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bn"), F.sum("n").over(whole).alias("size"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = steps.select(
        "conv_id", "block", "turn", F.sum("h1").over(within).alias("r1"), F.sum("h2").over(within).alias("r2"), F.sum("n").over(within).alias("rn")
    )
    wide = "decimal(38,0)"
    return running.join(starts, ["conv_id", "block"]).select(
        "conv_id", "turn", (F.col("r1") + F.col("b1")).cast(wide).alias("h1"), (F.col("r2") + F.col("b2")).cast(wide).alias("h2"),
        (F.col("rn") + F.col("bn")).alias("n"), "size",
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id) of the conversations that prefix no longer one; of equal ones the smallest id."""
    prefixes = saved(prefix_hashes(turns), "prefixes")
    key = ["h1", "h2", "n"]
    whole = prefixes.where(F.col("n") == F.col("size")).groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    continued = prefixes.where(F.col("n") < F.col("size")).select(*key).distinct()
    return whole.join(continued, key, "left_anti").select("conv_id")


def _rendered(role: Column, text: Column) -> Column:
    name = F.coalesce(F.lower(F.trim(role)), F.lit("unknown"))
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.replace(name, F.lit("|>"), F.lit("")), F.lit("|>\n"), safe, F.lit("<|end|>\n"))


def format_chats(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Maximal conversations as text: conv_id, part, n_turns, chat.

    A conversation is its set of (turn, role, text) rows in order of turn, and prefixes another if that one's rows up to
    some turn are the same. Turns are rendered in order of turn, role and text; a long conversation gives a row
    (``part``) for each 512 turn numbers. Rows with null conversation belong to none and are left out; a null turn
    counts as -1, a null role reads ``unknown``, a null text is empty when rendered but differs from an empty text
    when compared. ``<|`` within a text is written ``< |``. Repeated rows of a turn stay. Other columns are ignored;
    an empty input gives an empty result.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    kept = turns.join(maximal_conversations(turns), "conv_id", "left_semi")
    parts = kept.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    chat = F.array_join(F.transform("turns", lambda t: _rendered(t["role"], t["text"])), "")
    return parts.select("conv_id", F.col("block").alias("part"), F.size("turns").cast("long").alias("n_turns"), chat.alias("chat"))
