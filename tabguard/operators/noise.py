"""Noise on aggregate output: which mechanism, how much, and columns that describe it."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.functions.gaussian import Z95
from tabguard.functions.samplers import add_noise, secret_key
from tabguard.operators.aggregates import Measure, Part
from tabguard.plans.budget import Budget, Concentrated, Pure, is_infinite

LABELS = {"geometric": "Two-Sided Geometric", "discrete_gaussian": "Discrete Gaussian"}


@dataclass(frozen=True)
class Bound:
    """How many rows one protected unit can change: their number, and its root-sum-square, squared."""

    rows: Fraction
    squared: Fraction

    @staticmethod
    def of_rows(rows: int) -> Bound:
        return Bound(Fraction(rows), Fraction(rows) ** 2)

    @staticmethod
    def of_groups(groups: int, rows: int, grouped: bool) -> Bound:
        """``rows`` rows in each of ``groups`` groups; the root helps only when grouping by them."""
        total = Fraction(groups * rows)
        return Bound(total, Fraction(groups) * rows**2 if grouped else total**2)


@dataclass(frozen=True)
class Noise:
    """Mechanism and parameter: a scale, or a variance for the Gaussian ones."""

    mechanism: str
    parameter: Fraction


def pick_mechanism(budget: Budget, integer: bool, requested: str = "default") -> str:
    """Laplace family under pure and approximate budgets, Gaussian family under concentrated ones."""
    if requested not in ("default", "laplace", "gaussian"):
        raise ValueError(f"unknown mechanism {requested!r}")
    concentrated = isinstance(budget, Concentrated)
    if requested == "gaussian" and not concentrated:
        raise ValueError("Gaussian noise needs a concentrated budget")
    family = requested
    if requested == "default":
        family = "gaussian" if concentrated else "laplace"
    if family == "laplace":
        return "geometric" if integer else "laplace"
    return "discrete_gaussian" if integer else "gaussian"


def noise_of_part(part: Part, share: int, budget: Budget, bound: Bound, requested: str) -> Noise:
    """Noise for one of ``share`` components that split the budget evenly."""
    mechanism = pick_mechanism(budget, part.integer, requested)
    if is_infinite(budget):
        return Noise(mechanism, Fraction(0))
    amount = budget.amounts[0] / share
    if mechanism in ("geometric", "laplace"):
        epsilon = amount
        if isinstance(budget, Concentrated):
            # Laplace under a concentrated budget: epsilon^2 / 2 = rho, rounded down.
            epsilon = Fraction(math.isqrt(int(2 * amount * 10**18)), 10**9)
        return Noise(mechanism, part.unit * bound.rows / epsilon)
    return Noise(mechanism, part.unit**2 * bound.squared / (2 * amount))


def noise_plan(measure: Measure, budget: Budget, bound: Bound, requested: str = "default") -> list[Noise]:
    """Mechanism and parameter of every component, in order."""
    n = len(measure.parts)
    return [noise_of_part(p, n, budget, bound, requested) for p in measure.parts]


def release(
    measure: Measure,
    budget: Budget,
    bound: Bound,
    requested: str = "default",
    seed: int | None = None,
) -> DataFrame:
    """The noisy answer. Every evaluation of the same plan gives the same draws; a new call gives new ones."""
    frame, key = measure.frame, secret_key(seed)
    for part, noise in zip(measure.parts, noise_plan(measure, budget, bound, requested)):
        if noise.parameter != 0:
            frame = frame.withColumn(
                part.column,
                add_noise(
                    F.col(part.column),
                    noise.mechanism,
                    F.lit(str(noise.parameter.numerator)),
                    F.lit(str(noise.parameter.denominator)),
                    measure.keys,
                    part.column,
                    key,
                ),
            )
    return measure.finish(frame)


def release_by(measure: Measure, column: str, plans: Mapping[str, Sequence[Noise]], seed: int | None = None) -> DataFrame:
    """The noisy answer where ``plans`` gives the noise of every component for each value of a key column.

    All values share the mechanisms; only the parameters differ, and an unlisted value is an error.
    """
    frame, key = measure.frame, secret_key(seed)
    for i, part in enumerate(measure.parts):
        noises = {value: plan[i] for value, plan in plans.items()}
        mechanisms = {n.mechanism for n in noises.values()}
        if len(mechanisms) != 1:
            raise ValueError(f"several mechanisms for {part.column}: {sorted(mechanisms)}")
        if all(n.parameter == 0 for n in noises.values()):
            continue
        num, den = (
            F.element_at(F.create_map(*[F.lit(x) for v, n in noises.items() for x in (v, str(getattr(n.parameter, side)))]), F.col(column))
            for side in ("numerator", "denominator")
        )
        drawn = add_noise(F.col(part.column), mechanisms.pop(), num, den, measure.keys, part.column, key)
        frame = frame.withColumn(part.column, drawn)
    return measure.finish(frame)


def noise_columns(df: DataFrame, noise: Noise) -> DataFrame:
    """Append NOISE_DISTRIBUTION and VARIANCE."""
    parameter = F.lit(float(noise.parameter))
    return df.withColumns(
        {
            "NOISE_DISTRIBUTION": F.lit(LABELS.get(noise.mechanism, noise.mechanism)),
            "VARIANCE": noise_variance(noise.mechanism, parameter),
        }
    )


def noise_variance(mechanism: str, parameter: Column) -> Column:
    """Variance of the noise; 0 where the parameter is 0."""
    if mechanism == "geometric":
        safe = F.when(parameter == 0, F.lit(None)).otherwise(parameter)
        ratio = F.exp(-1 / safe)
        return F.coalesce(2 * ratio / F.pow(1 - ratio, F.lit(2)), F.lit(0.0))
    if mechanism == "laplace":
        return 2 * parameter * parameter
    return parameter.cast("double")


def noise_interval(mechanism: str, parameter: Column, p: float) -> Column:
    """Smallest noise value whose distribution function reaches ``p`` (margin of error)."""
    if not 0 < p < 1:
        raise ValueError("the probability lies strictly between 0 and 1")
    if mechanism == "laplace":
        return parameter * F.lit(-math.log(2 * (1 - p)) if p >= 0.5 else math.log(2 * p))
    if mechanism == "geometric":
        ratio = F.exp(-1 / parameter)
        below = F.ceil(parameter * F.log(F.lit(p) * (1 + ratio)))
        above = F.ceil(-parameter * F.log(F.lit(1 - p) * (1 + ratio))) - 1
        return F.when(F.lit(p) <= ratio / (1 + ratio), below).otherwise(
            F.greatest(above, F.lit(0))
        ).cast("double")
    from statistics import NormalDist

    return F.sqrt(parameter) * F.lit(NormalDist().inv_cdf(p))


def margin_of_error(variance: Column) -> Column:
    """Half width of a 90% normal interval."""
    return F.lit(Z95) * F.sqrt(variance)


def selection_threshold(epsilon: Fraction, delta: Fraction, rows: int) -> int:
    """Least noisy count at which a group may be named.

    One unit adds at most ``rows`` rows, hence at most ``rows`` new groups of at most ``rows`` rows;
    the chance that noise lifts any of them to the threshold is at most ``delta``.
    """
    if delta <= 0:
        raise ValueError("naming groups needs a delta above zero")
    scale = rows / epsilon
    ratio = math.exp(-1 / float(scale))
    lift = math.ceil(float(scale) * math.log(rows / (float(delta) * (1 + ratio))))
    return rows + max(lift, 1)


def select_groups_private(
    df: DataFrame, columns: list[str], budget: Budget, rows: int = 1, seed: int | None = None
) -> DataFrame:
    """Group values whose noisy count passes a threshold; counts are not part of the answer.

    At infinite budget these are simply the distinct values.
    """
    if isinstance(budget, (Pure, Concentrated)):
        raise ValueError("naming groups needs an approximate budget")
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    if is_infinite(budget):
        return counts.drop("__n")
    scale = Fraction(rows) / budget.epsilon
    noisy = add_noise(
        F.col("__n"), "geometric", F.lit(str(scale.numerator)), F.lit(str(scale.denominator)), columns, "groups", secret_key(seed)
    )
    threshold = selection_threshold(budget.epsilon, budget.delta, rows)
    return counts.withColumn("__n", noisy).filter(F.col("__n") >= threshold).drop("__n")
