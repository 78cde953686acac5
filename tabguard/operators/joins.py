"""Equi-joins between protected and public tables. All treat null keys as equal to each other.

No side is broadcast by hint: Spark broadcasts a side whose size, estimated or measured at run time, is
below its threshold, and otherwise shuffles both and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.functions.nullkeys import with_match_keys
from tabguard.functions.rowhash import digest_order
from tabguard.operators.limits import keep_first, keep_unique


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have, in the order of the left one."""
    names = set(right.columns)
    return [c for c in left.columns if c in names]


def natural_join(
    left: DataFrame, right: DataFrame, on: Sequence[str] | None = None, how: str = "inner"
) -> DataFrame:
    """Null-safe equi-join; shared names that are not keys become ``<name>_left`` / ``<name>_right``."""
    keys = list(on) if on else shared_columns(left, right)
    if not keys:
        raise ValueError("the tables share no column to join on")
    keyed_left, left_keys = with_match_keys(left, right, keys, "__l")
    keyed_right, right_keys = with_match_keys(right, left, keys, "__r")
    return _join_keyed(keyed_left, left_keys, keyed_right, right_keys, keys, how)


def _join_keyed(left, left_keys, right, right_keys, keys, how):
    left_names = [c for c in left.columns if c not in left_keys]
    right_names = [c for c in right.columns if c not in right_keys]
    clash = set(left_names) & set(right_names) - set(keys)
    condition = F.lit(True)
    for a, b in zip(left_keys, right_keys):
        condition = condition & (F.col(a) == F.col(b))
    left = left.withColumnsRenamed({c: f"{c}_left" for c in clash})
    right = right.withColumnsRenamed({c: f"{c}_right" for c in clash}).drop(*keys)
    out = [*keys]
    out += [f"{c}_left" if c in clash else c for c in left_names if c not in keys]
    out += [f"{c}_right" if c in clash else c for c in right_names if c not in keys]
    return left.join(right, condition, how).select(*out)


def join_public(left: DataFrame, public: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Natural join of a protected table with a public one."""
    return natural_join(left, public, on)


def join_private_ids(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """Join of two tables keyed by one protected identifier, which has to be among the keys."""
    return natural_join(left, right, on)


class DropExcess:
    """Keep at most ``n`` rows per join key, chosen by row digest."""

    def __init__(self, n: int, digest_columns: Sequence[str] | None = None):
        if n < 1:
            raise ValueError("at least one row per key has to be kept")
        self.n = n
        self.digest_columns = digest_columns

    stability = 2

    def apply(self, df: DataFrame, match_keys: Sequence[str]) -> DataFrame:
        columns = self.digest_columns or [c for c in df.columns if c not in match_keys]
        return keep_first(df, match_keys, self.n, digest_order(columns))


class DropNonUnique:
    """Drop every row whose join key occurs more than once."""

    n = 1
    stability = 1

    def apply(self, df: DataFrame, match_keys: Sequence[str]) -> DataFrame:
        return keep_unique(df, match_keys)


def join_private(
    left: DataFrame,
    right: DataFrame,
    left_cut: DropExcess | DropNonUnique,
    right_cut: DropExcess | DropNonUnique,
    on: Sequence[str] | None = None,
) -> DataFrame:
    """Cut both sides per key, then join. Cut and join share one exchange per side."""
    keys = list(on) if on else shared_columns(left, right)
    if not keys:
        raise ValueError("the tables share no column to join on")
    keyed_left, left_keys = with_match_keys(left, right, keys, "__l")
    keyed_right, right_keys = with_match_keys(right, left, keys, "__r")
    left = left_cut.apply(keyed_left, left_keys)
    right = right_cut.apply(keyed_right, right_keys)
    return _join_keyed(left, left_keys, right, right_keys, keys, "inner")


def join_fanout_bound(public: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the largest number of public rows that share a key (0 for an empty table)."""
    counts = public.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("max_rows_per_key"))


def anti_join_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left table that the right one lacks.

    Both sides are reduced to distinct keys first, so a hot key is one row per map task.
    """
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def left_join_truth(noisy: DataFrame, truth: DataFrame) -> DataFrame:
    """Noisy rows with the true count beside them; a cell absent from the truth counts 0."""
    keys = [c for c in shared_columns(noisy, truth) if c != "COUNT"]
    joined = noisy.withColumnRenamed("COUNT", "NOISY").join(
        truth.select(*keys, F.col("COUNT").alias("GROUND_TRUTH")), keys, "left"
    )
    return joined.fillna(0, subset=["GROUND_TRUTH"])


def join_num_denom_by_cell(num: DataFrame, den: DataFrame) -> DataFrame:
    """Denominators with their numerators of the same cell."""
    return den.join(num, ["REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"], "left")


def join_num_denom_broadcast_cell(num: DataFrame, den: DataFrame) -> DataFrame:
    """Numerators of every cell with the one denominator of their region and iteration."""
    keys = ["REGION_ID", "REGION_TYPE", "ITERATION_CODE"]
    return num.join(den.drop("DATA_CELL"), keys, "left")


def cross_join_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """Product of two key sets. The product is the wanted result, and both inputs are key sets."""
    if shared_columns(left, right):
        raise ValueError("key sets with a common column cannot be multiplied")
    return left.crossJoin(right)
