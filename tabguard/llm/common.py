"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.runtime import scratch_path


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once into the shared folder and read back, so that several jobs can use it and a lost
    executor costs nothing but a reread."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Number of shuffle partitions of this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names, so that other columns of the input cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..., for Arrow functions of whole rows, which take no name with a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])
