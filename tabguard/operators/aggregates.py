"""Aggregates over an explicit key set, exact or ready for noise.

Every answer has exactly the rows of its key set: groups without data get the value of an empty group
and data outside the key set is ignored. The data are aggregated first, with map-side partial
aggregation, and only the aggregated rows meet the keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.functions.binning import Bins
from tabguard.functions.samplers import secret_key, uniform_draw
from tabguard.operators.cleaning import (
    bin_column,
    clamp_measure,
    drop_null_nan,
    is_float,
    is_integer,
    replace_infinity,
)
from tabguard.operators.keys import Keys
from tabguard.operators.ranks import grouped_ranks


@dataclass(frozen=True)
class Part:
    """A component that receives noise: its column and the most one row can add to it."""

    column: str
    unit: Fraction
    integer: bool


@dataclass(frozen=True)
class Measure:
    """Components per key and how to turn them into the answer."""

    frame: DataFrame
    keys: tuple[str, ...]
    parts: tuple[Part, ...]
    finish: Callable[[DataFrame], DataFrame]

    def exact(self) -> DataFrame:
        """The answer without noise."""
        return self.finish(self.frame)


def over_keys(keys: Keys, answers: DataFrame, empty: dict[str, Column]) -> DataFrame:
    """Key rows with their answers; ``empty`` gives the value of a group without data."""
    names = keys.columns
    if not names:
        return answers.select(*[F.coalesce(F.col(c), v).alias(c) for c, v in empty.items()])
    side = answers.select(*[F.col(n).alias(f"__a_{n}") for n in names], *empty)
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"__a_{n}"))
    return keys.df.join(side, condition, "left").select(
        *names, *[F.coalesce(F.col(c), v).alias(c) for c, v in empty.items()]
    )


def _zero(data_type: str = "long") -> Column:
    return F.lit(0).cast(data_type)


def agg_count(df: DataFrame, keys: Keys, name: str = "count") -> Measure:
    """Rows per key."""
    counts = df.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias(name))
    frame = over_keys(keys, counts, {name: _zero()})
    return Measure(frame, tuple(keys.columns), (Part(name, Fraction(1), True),), lambda d: d)


def agg_count_distinct(
    df: DataFrame, keys: Keys, columns: Sequence[str] | None = None, name: str | None = None
) -> Measure:
    """Distinct tuples of ``columns`` (all unless given) per key; tuples that hold nulls count too."""
    counted = list(columns) if columns else df.columns
    name = name or (f"count_distinct({', '.join(columns)})" if columns else "count_distinct")
    counts = df.groupBy(*keys.columns).agg(F.count_distinct(F.struct(*counted)).alias(name))
    frame = over_keys(keys, counts, {name: _zero()})
    return Measure(frame, tuple(keys.columns), (Part(name, Fraction(1), True),), lambda d: d)


def agg_count_distinct_ids(
    df: DataFrame, keys: Keys, id_column: str, name: str | None = None
) -> Measure:
    """Distinct protected identifiers per key, as a count over one row per identifier (and group)."""
    name = name or f"count_distinct({id_column})"
    if len(keys.columns) > 1:
        return agg_count_distinct(df, keys, [id_column], name)
    # With no other column left, one row per identifier (and group) is the distinct rows.
    single = df.select(id_column, *keys.columns).distinct()
    return agg_count(single, keys, name)


def _prepared(df: DataFrame, keys: Keys, column: str, low, high) -> tuple[DataFrame, bool]:
    """Key columns and the measure: no null or NaN, infinities at the bounds, clamped."""
    if low > high:
        raise ValueError("the lower bound exceeds the upper one")
    if column in keys.columns:
        raise ValueError(f"{column} is a key and cannot be measured")
    if not (is_integer(df, column) or is_float(df, column)):
        raise ValueError(f"{column} is not numeric")
    integer = is_integer(df, column)
    data = drop_null_nan(df.select(*keys.columns, column), [column])
    if not integer:
        data = replace_infinity(data, {column: (float(low), float(high))})
    kind = "long" if integer else "double"
    value = clamp_measure(F.col(column), low, high).cast(kind)
    return data.select(*keys.columns, value.alias("__v")), integer


def _midpoint(low, high, integer: bool) -> Fraction:
    total = Fraction(str(low)) + Fraction(str(high))
    return Fraction(-(-total // 2)) if integer else total / 2


def _lit(value: Fraction, integer: bool) -> Column:
    return F.lit(int(value)).cast("long") if integer else F.lit(float(value))


def agg_sum(df: DataFrame, keys: Keys, column: str, low, high, name: str | None = None) -> Measure:
    """Sum of the values clamped to [low, high]; integers stay integers."""
    name = name or f"{column}_sum"
    data, integer = _prepared(df, keys, column, low, high)
    sums = data.groupBy(*keys.columns).agg(F.sum("__v").alias(name))
    frame = over_keys(keys, sums, {name: _zero("long" if integer else "double")})
    unit = max(abs(Fraction(str(low))), abs(Fraction(str(high))))
    return Measure(frame, tuple(keys.columns), (Part(name, unit, integer),), lambda d: d)


#: Integer terms up to this size are summed as longs, which holds for 2**31 rows of a key; wider ones as doubles.
WIDEST_EXACT = 2**32


def _moments(df, keys, column, low, high, squares: bool):
    data, integer = _prepared(df, keys, column, low, high)
    mid = _midpoint(low, high, integer)
    reach = max(abs(Fraction(str(low)) - mid), abs(Fraction(str(high)) - mid))
    integer = integer and (reach * reach if squares else reach) <= WIDEST_EXACT
    deviation = F.col("__v") - _lit(mid, integer)
    kind = "long" if integer else "double"
    sums = [F.sum(deviation).alias("__dev"), F.count(F.lit(1)).alias("__n")]
    empty = {"__dev": _zero(kind), "__n": _zero()}
    parts = [Part("__dev", reach, integer), Part("__n", Fraction(1), True)]
    if squares:
        sums.append(F.sum(deviation * deviation).alias("__sq"))
        empty["__sq"] = _zero(kind)
        parts.insert(0, Part("__sq", reach * reach, integer))
    frame = over_keys(keys, data.groupBy(*keys.columns).agg(*sums), empty)
    return frame, tuple(parts), mid


def agg_average(
    df: DataFrame, keys: Keys, column: str, low, high, name: str | None = None
) -> Measure:
    """Mean of the clamped values: deviations from the midpoint over the count, plus the midpoint."""
    name = name or f"{column}_average"
    frame, parts, mid = _moments(df, keys, column, low, high, squares=False)

    def finish(d: DataFrame) -> DataFrame:
        n = F.greatest(F.col("__n"), F.lit(1))
        mean = F.col("__dev").cast("double") / n + F.lit(float(mid))
        return d.select(*keys.columns, mean.alias(name))

    return Measure(frame, tuple(keys.columns), parts, finish)


def _variance_column(low, high) -> Column:
    """Population variance; half the width squared for fewer than two rows and as upper bound."""
    widest = float(((Fraction(str(high)) - Fraction(str(low))) / 2) ** 2)
    n = F.greatest(F.col("__n"), F.lit(1))
    mean = F.col("__dev").cast("double") / n
    spread = F.col("__sq").cast("double") / n - mean * mean
    bounded = F.greatest(F.lit(0.0), F.least(spread, F.lit(widest)))
    return F.when(F.col("__n") <= 1, F.lit(widest)).otherwise(bounded)


def agg_variance(
    df: DataFrame, keys: Keys, column: str, low, high, name: str | None = None
) -> Measure:
    """Population variance of the clamped values."""
    name = name or f"{column}_variance"
    frame, parts, _ = _moments(df, keys, column, low, high, squares=True)
    finish = lambda d: d.select(*keys.columns, _variance_column(low, high).alias(name))
    return Measure(frame, tuple(keys.columns), parts, finish)


def agg_stdev(
    df: DataFrame, keys: Keys, column: str, low, high, name: str | None = None
) -> Measure:
    """Population standard deviation of the clamped values."""
    name = name or f"{column}_stdev"
    frame, parts, _ = _moments(df, keys, column, low, high, squares=True)
    finish = lambda d: d.select(*keys.columns, F.sqrt(_variance_column(low, high)).alias(name))
    return Measure(frame, tuple(keys.columns), parts, finish)


def agg_histogram(
    df: DataFrame, keys: Keys, column: str, bins: Bins, name: str | None = None
) -> Measure:
    """Rows per key and bin, all bins included."""
    name = name or f"{column}_binned"
    spark = df.sparkSession
    bin_keys = Keys.of_values(spark, {name: bins.bins()})
    both = keys.times(bin_keys) if keys.columns else bin_keys
    return agg_count(bin_column(df, column, bins, name), both)


def quantile_gaps(df: DataFrame, keys: Keys, column: str, q: float, low, high) -> DataFrame:
    """Candidate intervals of a quantile: ``lo``, ``hi`` and ``score`` (0 at the wanted rank, else < 0).

    The clamped values and the bounds cut [low, high] into intervals; an answer inside an interval has
    a known number of rows below it.
    """
    data, _ = _prepared(df, keys, column, low, high)
    data = data.withColumn("__v", F.col("__v").cast("double"))
    names = keys.columns
    ranks = grouped_ranks(data, names, "__v")
    below = F.struct(
        F.coalesce("previous", F.lit(float(low))).alias("lo"),
        F.col("value").alias("hi"),
        F.col("before").alias("rank"),
    )
    above = F.struct(
        F.col("value").alias("lo"), F.lit(float(high)).alias("hi"), F.col("total").alias("rank")
    )
    # Every value closes the interval below it; the largest value opens the last one too.
    largest = F.col("before") + F.col("n") == F.col("total")
    intervals = F.when(largest, F.array(below, above)).otherwise(F.array(below))
    gaps = ranks.select(*names, "total", F.inline(intervals)).filter(F.col("hi") > F.col("lo"))
    score = -F.abs(F.col("rank") - F.lit(float(q)) * F.col("total"))
    return gaps.select(*names, "lo", "hi", score.alias("score"))


def agg_quantile(
    df: DataFrame,
    keys: Keys,
    column: str,
    q: float,
    low,
    high,
    epsilon: float | None = None,
    rows: int = 1,
    name: str | None = None,
    seed: int | None = None,
) -> DataFrame:
    """Quantile in [low, high] by the exponential mechanism; without ``epsilon`` the best interval wins.

    An interval is drawn with weight ``length * exp(epsilon * score / (2 * rows))``, as the largest of
    the log weights plus Gumbel noise, and the answer is uniform inside it. Empty groups answer from
    the whole of [low, high]. Every evaluation of the same plan gives the same draws.
    """
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    name = name or f"{column}_quantile({q})"
    key = secret_key(seed)
    gaps = quantile_gaps(df, keys, column, q, low, high)
    appeal = F.col("score")
    if epsilon is not None:
        gumbel = -F.log(-F.log(uniform_draw([*keys.columns, "lo", "hi"], "interval", key)))
        length = F.log(F.col("hi") - F.col("lo"))
        appeal = appeal * F.lit(epsilon / (2 * rows)) + length + gumbel
    # Two numbers instead of one struct keep this a hash aggregate. Both see the same rows in the same
    # order, so they always name the same interval.
    best = (
        gaps.withColumn("__w", appeal)
        .groupBy(*keys.columns)
        .agg(F.max_by("lo", "__w").alias("__lo"), F.max_by("hi", "__w").alias("__hi"))
    )
    whole = {"__lo": F.lit(float(low)), "__hi": F.lit(float(high))}
    chosen = over_keys(keys, best, whole)
    answer = F.col("__lo") + uniform_draw(keys.columns, "place", key) * (F.col("__hi") - F.col("__lo"))
    return chosen.select(*keys.columns, answer.alias(name))


def agg_min(df, keys, column, low, high, name=None, **options) -> DataFrame:
    """Quantile 0."""
    return agg_quantile(df, keys, column, 0.0, low, high, name=name or f"{column}_min", **options)


def agg_max(df, keys, column, low, high, name=None, **options) -> DataFrame:
    """Quantile 1."""
    return agg_quantile(df, keys, column, 1.0, low, high, name=name or f"{column}_max", **options)


def agg_median(df, keys, column, low, high, name=None, **options) -> DataFrame:
    """Quantile 0.5."""
    return agg_quantile(df, keys, column, 0.5, low, high, name=name or f"{column}_median", **options)
