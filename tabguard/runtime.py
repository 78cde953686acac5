"""Session plumbing shared by all modules: tuning, durable cuts in the lineage, scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; none of them changes a result. Skewed shuffle joins are split even where the
# split costs one more exchange, because one key may hold a large share of a table.
_TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cut rows per key before the exchange however many are kept; the cut streams over sorted rows.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on adaptive re-planning and forced skew splitting for this session."""
    for name, value in _TUNING.items():
        spark.conf.set(name, value)
    return spark


def small_table(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A few configuration rows as a local relation, whose known size lets the planner broadcast it."""
    arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate(columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master.

    A folder on one machine would be lost with its executor, so on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="tabguard-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Needed wherever a second evaluation would give another answer (random draws) and for results that
    several later jobs read. The checkpoint is in shared storage, so a lost executor loses nothing.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; callers write to it and read it back."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
