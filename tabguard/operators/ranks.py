"""Ranks of values within groups of any size, without sorting a group in one task.

Equal values are first collapsed to one row with a count. The distinct values are then cut into
buckets by global approximate quantiles, so a (group, bucket) holds about 1/BUCKETS of all distinct
values even if one group holds most of them; with more shuffle partitions there are more buckets. Running
counts are taken inside each bucket and shifted by the total of the buckets before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.functions.nullkeys import with_match_keys

BUCKETS = 200


def grouped_ranks(
    df: DataFrame, keys: Sequence[str], value: str, buckets: int | None = None
) -> DataFrame:
    """One row per key and distinct value: ``n``, ``before`` (rows with smaller values), ``total``, and
    ``previous`` (next smaller value of the key, null for the first).

    The buckets only spread the work, BUCKETS or one per shuffle partition; ranks are exact. Keys may be empty and
    may hold nulls.
    """
    if buckets is None:
        buckets = max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    names = [f"__g{i}" for i in range(len(keys))]
    counted = (
        df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("value"))
        .groupBy(*names, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    # Looking at n as well lets the search and the ranks share one aggregation and one exchange.
    seen = F.when(F.col("n") > 0, F.col("value"))
    cuts = counted.select(F.percentile_approx(seen, steps, F.lit(10_000)).alias("c")).scalar()
    # Exploding a one-element array keeps the optimizer from repeating the search in every use of it.
    place = _cuts_below(F.col("__cuts"), F.col("value"), buckets)
    bucketed = counted.withColumn("__cuts", cuts).select(
        *counted.columns, F.explode(F.array(place)).alias("__b")
    )

    per_bucket = bucketed.groupBy(*names, "__b").agg(
        F.sum("n").alias("__rows"), F.max("value").alias("__last")
    )
    # At most one row per key and bucket from here on.
    by_key = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    earlier = by_key.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *names,
        F.col("__b").alias("__b_o"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__shift"),
        F.max("__last").over(earlier).alias("__last_before"),
        F.sum("__rows").over(by_key).alias("total"),
    )
    # Join and window use the same match columns, so the rows are exchanged once for both.
    left, left_keys = with_match_keys(bucketed, offsets, names, "__l")
    right, right_keys = with_match_keys(offsets, bucketed, names, "__r")
    condition = F.col("__b") == F.col("__b_o")
    for a, b in zip(left_keys, right_keys):
        condition = condition & (F.col(a) == F.col(b))
    joined = left.join(right.drop(*names), condition)

    inside = Window.partitionBy("__b", *left_keys).orderBy("value")
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)],
        "value",
        "n",
        (F.col("__shift") + F.coalesce(F.sum("n").over(running), F.lit(0))).alias("before"),
        "total",
        F.coalesce(F.lag("value").over(inside), F.col("__last_before")).alias("previous"),
    )


def _cuts_below(cuts: Column, value: Column, buckets: int) -> Column:
    """Number of elements of the ascending array ``cuts`` below ``value``, by binary search."""
    steps = [1 << i for i in range((buckets - 1).bit_length() - 1, -1, -1)]

    def advance(position: Column, step: Column) -> Column:
        # Past the end of the array there is no cut: null, which is not below.
        below = F.get(cuts, position + step - 1) < value
        return position + F.when(below, step).otherwise(F.lit(0))

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def exact_percentile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, name: str, buckets: int | None = None
) -> DataFrame:
    """Percentile with linear interpolation and the row count ``<name>_n`` per key; nulls ignored.

    Spark's ``percentile`` keeps every distinct value of a group in one task; this does not.
    """
    ranks = grouped_ranks(df.filter(F.col(value).isNotNull()), keys, value, buckets)
    place = F.lit(q) * (F.col("total") - 1)
    low, high = F.floor(place), F.ceil(place)

    def at(index):
        hit = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
        return F.max(F.when(hit, F.col("value").cast("double")))

    return (
        ranks.groupBy(*keys)
        .agg(at(low).alias("__lo"), at(high).alias("__hi"), F.max("total").alias(f"{name}_n"))
        .withColumn("__place", F.lit(q) * (F.col(f"{name}_n") - 1))
        .select(
            *keys,
            (
                F.col("__lo")
                + (F.col("__hi") - F.col("__lo")) * (F.col("__place") - F.floor("__place"))
            ).alias(name),
            f"{name}_n",
        )
    )
