"""Contribution bounds: keep a fixed number of rows or groups per key, chosen by row digest.

No operator here sends an unbounded group to one task. A window filtered by ``row_number() <= n``
keeps at most ``n`` rows per key and map task before the exchange (Spark's window group limit). Above
the planner's threshold for that rule the same is done by hand with one window per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.functions.rowhash import digest_order

_RANK = "__rank"


def keep_first(
    df: DataFrame, keys: Sequence[str | Column], n: int, order: Sequence[Column]
) -> DataFrame:
    """First ``n`` rows of every key in the given total order (ties must be interchangeable rows)."""
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        # The best n of a key are among the best n of each of its input partitions, whatever those are.
        local = Window.partitionBy(*keys, F.col("__part")).orderBy(*order)
        df = (
            df.withColumn("__part", F.spark_partition_id())
            .withColumn(_RANK, F.row_number().over(local))
            .filter(F.col(_RANK) <= n)
            .drop(_RANK, "__part")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once.

    Two rows are enough to prove that a key repeats, so only two per key and map task are shuffled;
    the count that follows reuses the exchange and the sort.
    """
    by_key = Window.partitionBy(*keys)
    first_two = (
        df.withColumn(_RANK, F.row_number().over(by_key.orderBy(*keys)))
        .filter(F.col(_RANK) <= 2)
        .drop(_RANK)
    )
    counted = first_two.withColumn("__n", F.count(F.lit(1)).over(by_key))
    return counted.filter(F.col("__n") == 1).drop("__n")


def limit_rows_per_id(
    df: DataFrame, id_column: str, n: int, digest_columns: Sequence[str] | None = None
) -> DataFrame:
    """At most ``n`` rows per protected identifier."""
    return keep_first(df, [id_column], n, digest_order(digest_columns or df.columns))


def limit_rows_per_group_per_id(
    df: DataFrame, id_column: str, group: str, n: int, digest_columns: Sequence[str] | None = None
) -> DataFrame:
    """At most ``n`` rows per (identifier, group)."""
    return keep_first(df, [id_column, group], n, digest_order(digest_columns or df.columns))


def limit_groups_per_id(df: DataFrame, id_column: str, group: str, n: int) -> DataFrame:
    """All rows of at most ``n`` distinct groups per identifier.

    The choice is made on the distinct (identifier, group) pairs, which map tasks pre-aggregate; the
    rows then meet the chosen pairs in a semi join. A pair with very many rows makes a large partition
    of the rows' side only, which adaptive execution splits (``tune`` forces it).
    """
    keys = [id_column, group]
    kept = keep_first(df.select(*keys).distinct(), [id_column], n, digest_order([group]))
    kept = kept.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    return df.join(kept, _match(df, kept, keys), "left_semi")


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"__k_{k}"])
    return condition


def limit_groups_then_rows(
    df: DataFrame,
    id_column: str,
    group: str,
    groups: int,
    rows: int,
    digest_columns: Sequence[str] | None = None,
) -> DataFrame:
    """At most ``groups`` groups per identifier and ``rows`` rows in each of them.

    Rows are cut first: that leaves every (identifier, group) pair in place, so the chosen groups are
    the same, and afterwards an identifier has a bounded number of rows per group.
    """
    cut = limit_rows_per_group_per_id(df, id_column, group, rows, digest_columns)
    return limit_groups_per_id(cut, id_column, group, groups)
