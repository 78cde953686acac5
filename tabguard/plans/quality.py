"""Data quality checks. Each returns the violations; an empty result means the data are clean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.functions.domains import Categories
from tabguard.operators.noise import noise_variance


def dq_values(df: DataFrame, domains: Sequence[Any]) -> DataFrame:
    """Distinct values outside their column's domain, all columns in one pass.

    Columns: ``column``, ``value`` (as text), ``n_rows`` with that value, ``n_values`` bad values of the
    column in all.
    """
    failing = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.coalesce(d.valid(), F.lit(False)),
                    F.struct(
                        F.lit(d.column).alias("column"), F.col(d.column).cast("string").alias("value")
                    ),
                )
                for d in domains
            ]
        )
    )
    bad = df.select(F.inline(failing)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    # Looking at n_rows as well lets both sides of the join share one aggregation and one exchange.
    sizes = bad.groupBy("column").agg(F.count_if(F.col("n_rows") > 0).alias("n_values"))
    return bad.join(sizes, "column")


def dq_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dq_orphan_keys(persons: DataFrame, units: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """Keys with no partner: persons without unit, geography without unit, units without geography.

    A null key has no partner.
    """
    sides = [df.select(F.col(key), F.lit(1 << i).alias("side")) for i, df in enumerate((persons, units, geo))]
    # A bit per table and key; every table is pre-aggregated where it is read, and all keys are dealt once.
    held = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy(key).agg(F.bit_or("side").alias("side"))
    person, unit, place = (F.col("side").bitwiseAND(1 << i) != 0 for i in range(3))
    alone = F.col(key).isNull()
    gaps = F.array(
        F.when(person & (~unit | alone), F.lit("persons without unit")),
        F.when(place & (~unit | alone), F.lit("geography without unit")),
        F.when(unit & (~place | alone), F.lit("units without geography")),
    )
    return held.select(F.explode(F.array_compact(gaps)).alias("gap"), key)


def dq_region_scope(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct regions outside the allowed list; null counts as outside."""
    outside = ~F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.filter(outside).select(column).distinct()


def dq_output_format(outputs: Mapping[str, DataFrame], domains: Mapping[str, Sequence[Any]]) -> DataFrame:
    """``dq_values`` over several output tables, with the table name."""
    out = None
    for name, df in outputs.items():
        found = dq_values(df, domains[name]).withColumn("table", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def output_domains(table) -> list[Any]:
    """Domains of one published table; the patterns and lists are fixed values of the format."""
    from tabguard.functions.domains import Pattern

    cells = sorted({*table.leaf_cells, *table.parents.values(), *range(1, max(table.leaf_cells) + 1)})
    domains = [
        Pattern("REGION_ID", r"1|\d{2}"),
        Categories("REGION_TYPE", ("USA", "STATE")),
        Categories(table.cell, tuple(cells)),
        Pattern("COUNT", r"-?\d+"),
        Categories("NOISE_DISTRIBUTION", ("Discrete Gaussian", "Two-Sided Geometric")),
        Pattern("VARIANCE", r"\d+(\.\d+)?([eE]-?\d+)?"),
    ]
    if table.race is not None:
        domains.append(Categories("ITERATION_CODE", ("*", *"ABCDEFGHI")))
    return domains


def expected_variance_rows(
    spark, budgets: Mapping[str, Mapping[str, object]], taus: Mapping[str, int], definition: str
) -> DataFrame:
    """Stated formula per table, region type, iteration and cell: TABLE, ..., DATA_CELL, EXPECTED.

    DATA_CELL is null where one formula holds for every cell. Derived tables follow their source: the
    owner cell of PH8_num is a sum of two answers, so its variance doubles.
    """
    from tabguard.plans.tables import TABLES
    from tabguard.plans.tabulate import budget_rows

    base = budget_rows(spark, budgets, taus, definition)
    mechanism = "geometric" if definition == "pure" else "discrete_gaussian"
    single = noise_variance(mechanism, F.col("PARAMETER"))
    keys = ["TABLE", "REGION_TYPE", "ITERATION_CODE"]
    out = base.select(*keys, F.lit(None).cast("int").alias("DATA_CELL"), single.alias("EXPECTED"))
    for name, table in TABLES.items():
        if table.derived_from is None:
            continue
        source = base.filter(F.col("TABLE") == table.derived_from).withColumn("TABLE", F.lit(name))
        cells: list[tuple[int | None, int]] = [(2, 2), (3, 1)] if name == "PH8_num" else [(None, 1)]
        for cell, times in cells:
            out = out.unionByName(
                source.select(
                    *keys, F.lit(cell).cast("int").alias("DATA_CELL"), (single * times).alias("EXPECTED")
                )
            )
    return out


def dq_output_variance(outputs: DataFrame, expected: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Output rows whose VARIANCE differs from the formula by more than a relative tolerance.

    Rows of a table, region type and iteration without a budget have no formula and fail as well.
    ``expected`` has at most a few hundred rows, one per budget entry.
    """
    wanted = expected.withColumnRenamed("DATA_CELL", "__cell")
    keys = ["TABLE", "REGION_TYPE", "ITERATION_CODE"]
    condition = F.lit(True)
    for k in keys:
        condition = condition & (outputs[k] == wanted[k])
    condition = condition & (wanted["__cell"].isNull() | (wanted["__cell"] == outputs["DATA_CELL"]))
    joined = outputs.join(wanted, condition, "left").select(
        *[outputs[c] for c in outputs.columns], wanted["EXPECTED"]
    )
    off = F.abs(F.col("VARIANCE") - F.col("EXPECTED")) > F.lit(tolerance) * F.greatest(
        F.abs("VARIANCE"), F.abs("EXPECTED")
    )
    return joined.filter(F.col("EXPECTED").isNull() | F.col("VARIANCE").isNull() | off)


def dq_update_domains(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, to refresh category lists: ``column``, ``value``."""
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.inline(listed)).filter(F.col("value").isNotNull()).distinct()


def dq_unlisted_values(df: DataFrame, columns: Sequence[str], known: DataFrame) -> DataFrame:
    """Distinct values of ``df`` that a category table does not list: ``column``, ``value``, ``n_rows``.

    ``known`` is a table such as ``dq_update_domains`` gives, of any size. Null is never listed.
    """
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    found = df.select(F.inline(listed)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(known.select("column", "value").distinct(), ["column", "value"], "left_anti")


def dq_estimates_counts(estimates: DataFrame) -> DataFrame:
    """Count estimates that are no positive integer or lie over 6 deviations from the noisy count."""
    pred = F.col("PRED")
    reasons = F.array_compact(
        F.array(
            F.when(~((pred == F.floor(pred)) & (pred > 0)), F.lit("not a positive integer")),
            F.when(
                F.abs(pred - F.col("COUNT_NOISY")) > 6 * F.sqrt("VARIANCE"),
                F.lit("over 6 deviations from the noisy count"),
            ),
        )
    )
    return estimates.withColumn("REASONS", F.concat_ws("; ", reasons)).filter(F.col("REASONS") != "")


def dq_estimates_ratios(estimates: DataFrame, low: float, high: float) -> DataFrame:
    """Ratio estimates outside [low, high]: 0 for the two-part tables, 1 for the one-part table."""
    return estimates.filter((F.col("RATIO_PRED") < low) | (F.col("RATIO_PRED") > high))


COUNT_COLUMNS = (
    "GEOID REGION_TYPE ITERATION_CODE DATA_CELL COUNT_NOISY VARIANCE MOE_NOISY PRED PRED_LO PRED_HI"
).split()
TWO_PART_COLUMNS = (
    "GEOID REGION_TYPE ITERATION_CODE DATA_CELL COUNT_NOISY_NUM VARIANCE_NUM MOE_NOISY_NUM "
    "COUNT_NOISY_DENOM VARIANCE_DENOM MOE_NOISY_DENOM RATIO_NOISY RATIO_PRED PRED_NUM PRED_DENOM "
    "RATIO_PRED_LO RATIO_PRED_HI"
).split()
ONE_PART_COLUMNS = (
    "GEOID REGION_TYPE ITERATION_CODE DATA_CELL COUNT_NOISY_DENOM VARIANCE_DENOM MOE_NOISY_DENOM "
    "COUNT_NOISY_NUM VARIANCE_NUM MOE_NOISY_NUM RATIO_NOISY RATIO_PRED RATIO_PRED_LO RATIO_PRED_HI"
).split()
"""Column orders of the estimate files."""


def has_columns(df: DataFrame, order: Sequence[str]) -> bool:
    """Whether a table has exactly these columns in this order."""
    return df.columns == list(order)


def rule_failures(rules: Mapping[str, tuple[Column, str]]) -> Column:
    """Text listing every failed rule as ``FIELD (value) out of range (allowed)``; empty when clean."""
    failed = [
        F.when(
            ~F.coalesce(ok, F.lit(False)),
            F.concat(F.lit(f"{name} ("), F.coalesce(F.col(name).cast("string"), F.lit("None")), F.lit(f") out of range ({allowed})")),
        )
        for name, (ok, allowed) in rules.items()
    ]
    return F.concat_ws(", ", F.array_compact(F.array(*failed)))

