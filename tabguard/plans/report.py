"""Accuracy report: noisy answers against the truth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.operators.joins import left_join_truth
from tabguard.operators.ranks import exact_percentile
from tabguard.plans.tables import TABLES
from tabguard.plans.tabulate import budget_rows

REPORT_KEYS = ["TABLE", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"]


def error_rows(noisy: DataFrame, truth: DataFrame) -> DataFrame:
    """Absolute error per row (and trial, if numbered) of the long form; a cell absent from the truth counts 0."""
    numbered = ["TRIAL"] if "TRIAL" in noisy.columns else []
    joined = left_join_truth(noisy, truth)
    if "ITERATION_CODE" not in joined.columns:
        joined = joined.withColumn("ITERATION_CODE", F.lit("*"))
    return joined.select(
        "TABLE",
        "REGION_ID",
        "REGION_TYPE",
        F.coalesce("ITERATION_CODE", F.lit("*")).alias("ITERATION_CODE"),
        "DATA_CELL",
        F.abs(F.col("NOISY") - F.col("GROUND_TRUTH")).alias("ERROR"),
        *numbered,
    )


def error_trials(trials: DataFrame, truth: DataFrame) -> DataFrame:
    """Errors of trials drawn side by side: ``trials`` is a tabulation with TRIAL, joined with the truth once."""
    if "TRIAL" not in trials.columns:
        raise ValueError("the trials are not numbered")
    return error_rows(trials, truth)


def error_percentile(errors: DataFrame, q: float = 0.9) -> DataFrame:
    """Error percentile with linear interpolation and row count per table, level, iteration, cell."""
    out = exact_percentile(errors, REPORT_KEYS, "ERROR", q, "EXPERIMENTAL_MOE")
    return out.withColumnRenamed("EXPERIMENTAL_MOE_n", "COUNT")


def expected_margin(definition: str, reach: Column, budget: Column) -> Column:
    """Margin of error the noise should give, to one decimal."""
    if definition == "concentrated":
        margin = F.lit(1.64) * reach / F.sqrt(2 * budget)
    else:
        scale = reach / budget
        margin = scale * F.log(F.lit(20.0) / (1 + F.exp(1 / scale)))
    return F.round(margin, 1)


def error_expected_moe(
    report: DataFrame,
    budgets: Mapping[str, Mapping[str, object]],
    taus: Mapping[str, int],
    definition: str,
) -> DataFrame:
    """Add EXPECTED_MOE. Derived tables use their source; the owner cell of PH8_num grows by sqrt(2)."""
    spark = report.sparkSession
    reach = F.lit(None).cast("double")
    for name, t in TABLES.items():
        if t.derived_from is None:
            size = 2.0 if t.of_units else 2.0 * taus[name] + 2
            reach = F.when(F.col("TABLE") == name, F.lit(size)).otherwise(reach)
    margins = budget_rows(spark, budgets, taus, definition).select(
        F.col("TABLE").alias("__source"),
        "REGION_TYPE",
        "ITERATION_CODE",
        expected_margin(definition, reach, F.col("BUDGET")).alias("EXPECTED_MOE"),
    )
    source = F.col("TABLE")
    for name, t in TABLES.items():
        if t.derived_from:
            source = F.when(F.col("TABLE") == name, F.lit(t.derived_from)).otherwise(source)
    joined = report.withColumn("__source", source).join(
        margins, ["__source", "REGION_TYPE", "ITERATION_CODE"], "left"
    )
    owner = (F.col("TABLE") == "PH8_num") & (F.col("DATA_CELL") == 2)
    wider = F.round(F.sqrt(F.lit(2.0)) * F.col("EXPECTED_MOE"), 1)
    return joined.withColumn(
        "EXPECTED_MOE", F.when(owner, wider).otherwise(F.col("EXPECTED_MOE"))
    ).drop("__source")


def error_metric_by_cell(
    truth: DataFrame,
    trials: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, tuple],
) -> DataFrame:
    """Error metrics per cell over repeated trials.

    ``truth`` has TRUE_VALUE and ``trials`` has VALUE and TRIAL besides ``keys``. A metric is (error per
    row, function from the error column to its aggregate, filter or None). All
    metrics come from one aggregation of the long table.
    """
    joined = truth.join(trials, list(keys), "left")
    columns, aggregates = {}, []
    for i, (name, (error, combine, keep)) in enumerate(metrics.items()):
        columns[f"__e{i}"] = error if keep is None else F.when(keep, error)
        aggregates.append(combine(F.col(f"__e{i}")).alias(name))
    wide = joined.withColumns(columns).groupBy(*keys).agg(*aggregates)
    long = wide.unpivot(list(keys), list(metrics), "METRIC", "ERROR")
    return long.filter(F.col("ERROR").isNotNull())
