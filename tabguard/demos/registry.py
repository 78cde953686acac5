"""Registry of demonstration queries: one Spark callable per operator and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabguard.runtime import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``function(spark, folder)`` under ``name`` with its oracle SQL."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(tune(spark), folder)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """A Spark SQL query over the given tables, named in braces: ``SELECT ... FROM {orders}``."""
    names = "region nation customer supplier part orders lineitem events documents labels".split()
    frames = {n: table(spark, folder, n) for n in names if "{" + n + "}" in sql}
    return spark.sql(sql, **frames)


def oracle_text(sql: str) -> str:
    """The same SQL for a database where the tables are views."""
    return sql.replace("{", "").replace("}", "")
