"""Writers for tabulations, reports and estimates."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.plans.tables import TABLES


def sink_tabulations(answers: DataFrame, folder: str) -> str:
    """Publish all tables of the long form at once; the new release's folder.

    One job writes every table as one pipe-separated file with its own header below a folder that nobody reads yet
    (``TABLE=PH2`` and so on; the rows of a table are its keys, which do not grow with the data). Then one
    row per table is appended to the manifest, as one file, which appears as a whole when it is committed:
    readers see the former release until then and this one afterwards, whatever fails in between.
    """
    spark = answers.sparkSession
    release = f"{folder.rstrip('/')}/releases/{uuid.uuid4().hex}"
    table_lines(answers).write.partitionBy("TABLE").text(release)
    counts = answers.groupBy("TABLE").agg(F.count(F.lit(1)).alias("n_rows"))
    before = latest_release(spark, folder)
    number = 1 if before is None else before[0] + 1
    rows = counts.select(F.lit(number).cast("long").alias("number"), F.lit(release).alias("release"), "TABLE", "n_rows")
    rows.coalesce(1).write.mode("append").json(f"{folder.rstrip('/')}/manifest")
    return release


def table_lines(answers: DataFrame) -> DataFrame:
    """(TABLE, value): each table as lines, its header before its rows, all in one partition."""
    shown = [c for c in answers.columns if c != "TABLE"]
    plain = [name for name, t in TABLES.items() if t.race is None]
    cells = [F.when(~F.col("TABLE").isin(plain), F.col(c)) if c == "ITERATION_CODE" else F.col(c).cast("string") for c in shown]
    data = answers.select("TABLE", F.lit(1).alias("place"), F.concat_ws("|", *cells).alias("value"))
    # concat_ws skips nulls, so tables without iterations have no such column; nothing else is null.
    heads = {}
    for name, t in TABLES.items():
        names = [t.cell if c == "DATA_CELL" else c for c in shown if c != "ITERATION_CODE" or t.race is not None]
        heads[name] = "|".join(names)
    names = F.create_map(*[F.lit(x) for pair in heads.items() for x in pair])
    head = answers.select("TABLE").distinct().select("TABLE", F.lit(0).alias("place"), F.element_at(names, F.col("TABLE")).alias("value"))
    both = head.unionByName(data).repartition("TABLE").sortWithinPartitions("TABLE", "place", "value")
    return both.select("TABLE", "value")


_MANIFEST = "number long, release string, TABLE string, n_rows long"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All published releases: number, folder, and rows per table."""
    return spark.read.schema(_MANIFEST).json(f"{folder.rstrip('/')}/manifest")


def latest_release(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Number and folder of the release that readers see."""
    try:
        row = manifest(spark, folder).agg(F.max(F.struct("number", "release")).alias("r")).first().r
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else (row.number, row.release)


def read_release(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the latest release, as text columns under its published names."""
    latest = latest_release(spark, folder)
    if latest is None:
        raise ValueError(f"nothing is published in {folder}")
    return spark.read.csv(f"{latest[1]}/TABLE={name}", header=True, sep="|")


def sink_tabulations_partitioned(answers: DataFrame, folder: str) -> None:
    """All tables in one dataset, a directory per table, written in parallel."""
    answers.write.partitionBy("TABLE").csv(folder, sep="|", header=True, mode="overwrite")


def sink_error_report(report: DataFrame, folder: str) -> None:
    """Accuracy report as a pipe-separated CSV directory with header; one row per reported cell."""
    report.repartition("TABLE").write.csv(folder, sep="|", header=True, mode="overwrite")


def sink_estimates(estimates: DataFrame, folder: str) -> None:
    """Estimates in a directory per table and region level.

    Columns: TABLE and REGION_TYPE name the directory and stay in the rows as LEVEL for readers of
    single files.
    """
    rows = estimates.withColumn("LEVEL", F.col("REGION_TYPE"))
    rows.write.partitionBy("TABLE", "REGION_TYPE").csv(folder, sep="|", header=True, mode="overwrite")
