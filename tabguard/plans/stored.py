"""Households stored together: persons and units as tables bucketed and sorted by their key.

Tabulations of stored households deal no person anew: windows over a household, the join to its unit and the
cut run where the bucket is read. Storing deals every row once. A bucket is read by one task, so households
too large for that (``crowd``) are kept apart, unbucketed: they are tabulated like any other input, where
rows are cut before they are dealt and skewed joins are split, and the counts are added.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.plans import tabulate
from tabguard.runtime import scratch_path

KEY = "MAFID"
ROWS_PER_BUCKET = 2_000_000
CROWD = 100_000
_LAYOUT = "name string, buckets int, schema string"


@dataclass(frozen=True)
class Households:
    """Stored persons and units (with their state): ordinary ones bucketed by key, crowded ones not."""

    persons: DataFrame
    units: DataFrame
    crowded_persons: DataFrame
    crowded_units: DataFrame
    folder: str
    buckets: int

    def parts(self) -> list[tuple[DataFrame, DataFrame]]:
        return [(self.persons, self.units), (self.crowded_persons, self.crowded_units)]


def store_households(
    persons: DataFrame,
    units: DataFrame,
    geo: DataFrame,
    folder: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    crowd: int = CROWD,
) -> Households:
    """Write persons and units by household below ``folder`` (a new one in the shared folder if none is named).

    ``geo`` is the prepared geography. Rows with a null key are left out: they meet no unit and count in no
    table. Households of more than ``crowd`` persons and units are crowded; there are at most rows / ``crowd``
    of them, and their list is written before it is joined, so that the planner knows its size. The layout is
    written last: a folder without one is not whole, and ``open_households`` refuses it.
    """
    spark = persons.sparkSession
    folder = (folder or scratch_path(spark, "households")).rstrip("/")
    if _layout(spark, folder) is not None:
        raise ValueError(f"{folder} holds households already")
    records = {"persons": persons, "units": tabulate.unit_records(units, geo)}
    sizes = persons.select(KEY).unionByName(units.select(KEY)).filter(F.col(KEY).isNotNull()).groupBy(KEY).count()
    sizes.filter(F.col("count") > crowd).select(KEY).write.mode("overwrite").parquet(f"{folder}/crowded_keys")
    keys = spark.read.schema(sizes.select(KEY).schema).parquet(f"{folder}/crowded_keys")
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(at_least, -(-persons.count() // rows_per_bucket))
    rows = []
    for name, df in records.items():
        known = df.filter(F.col(KEY).isNotNull())
        known.join(keys, KEY, "left_semi").write.mode("overwrite").parquet(f"{folder}/crowded_{name}")
        # One task writes one bucket: the bucket of a row is its place in this repartitioning.
        together = known.join(keys, KEY, "left_anti").repartition(buckets, KEY)
        writer = together.write.mode("overwrite").format("parquet").option("path", f"{folder}/{name}")
        writer.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(_table_name(name))
        rows.append((name, buckets, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)))
    spark.createDataFrame(rows, _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{folder}/layout")
    return open_households(spark, folder)


def open_households(spark: SparkSession, folder: str) -> Households:
    """Households stored earlier, also by another session."""
    folder = folder.rstrip("/")
    layout = _layout(spark, folder)
    if layout is None:
        raise ValueError(f"no households are stored whole in {folder}")
    frames, buckets = {}, 0
    for name in ("persons", "units"):
        row = layout[name]
        buckets, table = row.buckets, _table_name(name)
        spark.sql(
            f"CREATE TABLE {table} ({row.schema}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
            f"INTO {buckets} BUCKETS LOCATION '{folder}/{name}'"
        )
        frames[name] = spark.table(table)
        frames[f"crowded_{name}"] = spark.read.schema(row.schema).parquet(f"{folder}/crowded_{name}")
    return Households(**frames, folder=folder, buckets=buckets)


def _table_name(name: str) -> str:
    return f"tabguard_{name}_{uuid.uuid4().hex}"


def _layout(spark: SparkSession, folder: str) -> dict | None:
    """Rows of the layout by name, at most two; None where there is none."""
    try:
        rows = spark.read.schema(_LAYOUT).json(f"{folder}/layout").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return {r.name: r for r in rows} or None


def exact_stored(households: Households, names: Sequence[str] | None = None) -> DataFrame:
    """``exact_tabulations`` of stored households."""
    parts = [
        tabulate.exact_tabulations(persons, units, None, names, unit_geo=units)
        for persons, units in households.parts()
    ]
    return tabulate.sum_counts(parts)


def cut_stored(
    households: Households,
    taus: Mapping[str, int],
    names: Sequence[str] | None = None,
    digest_columns: Sequence[str] | None = None,
) -> DataFrame:
    """``leaf_counts`` of stored households."""
    parts = [
        tabulate.leaf_counts(persons, units, None, taus, names, digest_columns, unit_geo=units)
        for persons, units in households.parts()
    ]
    return tabulate.sum_counts(parts)


def private_stored(
    households: Households,
    geo: DataFrame,
    taus: Mapping[str, int],
    budgets: Mapping[str, Mapping[str, object]],
    definition: str,
    digest_columns: Sequence[str] | None = None,
    seed: int | None = None,
    trials: int | None = None,
) -> DataFrame:
    """``private_tabulations`` of stored households; ``geo`` gives the regions of the key sets."""
    counts = cut_stored(households, taus, tabulate.budgeted_tables(budgets) or None, digest_columns)
    return tabulate.private_tabulations(
        households.persons, households.units, geo, taus, budgets, definition, seed=seed, trials=trials, counts=counts
    )
