"""Key sets: the explicit, duplicate-free groups an answer is given for."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY_TYPES = (T.IntegerType, T.LongType, T.StringType, T.DateType)


def _checked(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if not isinstance(f.dataType, _KEY_TYPES):
            raise ValueError(f"{f.name}: {f.dataType.simpleString()} cannot be a group key")
    return df.select(
        *[
            F.col(f.name).cast("long").alias(f.name)
            if isinstance(f.dataType, T.IntegerType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _decoded(lists: Mapping[str, Sequence[Any]], number: Column) -> list[Column]:
    """The values that a number below the product of the lists' lengths stands for, the last list turning fastest."""
    columns, stride = [], 1
    for name, items in reversed(lists.items()):
        place = F.pmod(F.call_function("div", number, F.lit(stride)), F.lit(len(items)))
        columns.append(F.get(F.array(*[F.lit(v) for v in items]), place.cast("int")).alias(name))
        stride *= len(items)
    return columns[::-1]


@dataclass(frozen=True)
class Keys:
    """A set of group keys. ``df`` has no duplicate rows; without columns it is the one global group.

    A product of value lists is a range of numbers, decoded by arithmetic where it is read: it is never stored or joined.
    ``lists`` keeps the lists, so that products of products stay so.
    """

    df: DataFrame
    lists: Mapping[str, Sequence[Any]] | None = None

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    @staticmethod
    def of_values(spark: SparkSession, values: Mapping[str, Sequence[Any]]) -> Keys:
        """Product of value lists, each de-duplicated; an empty mapping is the global group."""
        lists = {}
        for name, items in values.items():
            lists[name] = list(dict.fromkeys(items))
            if not lists[name]:
                raise ValueError(f"no values given for key {name}")
        size = math.prod(map(len, lists.values()))
        return Keys(_checked(spark.range(size).select(*_decoded(lists, F.col("id")))), lists)

    @staticmethod
    def of_table(df: DataFrame) -> Keys:
        """Distinct rows of a table."""
        return Keys(_checked(df).dropDuplicates())

    def filter(self, condition: str | Column) -> Keys:
        """Keys for which the predicate holds."""
        return Keys(self.df.filter(condition))

    def project(self, *columns: str) -> Keys:
        """Distinct keys over some of the columns."""
        if not columns or set(columns) - set(self.columns):
            raise ValueError(f"not key columns: {columns}")
        return Keys(self.df.select(*columns).dropDuplicates())

    def times(self, other: Keys) -> Keys:
        """Product of two key sets without a common column; value lists are multiplied as numbers, without a join."""
        from tabguard.operators.joins import cross_join_keys

        if set(self.columns) & set(other.columns):
            raise ValueError("key sets with a common column cannot be multiplied")
        if self.lists is not None and other.lists is not None:
            return Keys.of_values(self.df.sparkSession, {**self.lists, **other.lists})
        table, listed = (self, other) if other.lists is not None else (other, self)
        if listed.lists is None:
            return Keys(cross_join_keys(self.df, other.df))
        size = math.prod(map(len, listed.lists.values()))
        rows = table.df.withColumn("__number", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
        both = _checked(rows.select(*table.columns, *_decoded(listed.lists, F.col("__number"))))
        return Keys(both.select(*self.columns, *other.columns))

    def equality(self, other: Keys) -> DataFrame:
        """One row with ``equal``: whether both hold the same rows, whatever the column order."""
        if set(self.columns) != set(other.columns):
            return self.df.sparkSession.range(1).select(F.lit(False).alias("equal"))
        names = sorted(self.columns)
        signed = self.df.select(*names, F.lit(1).alias("__side")).unionByName(
            other.df.select(*names, F.lit(-1).alias("__side"))
        )
        unmatched = signed.groupBy(*names).agg(F.sum("__side").alias("__d")).filter("__d <> 0")
        return unmatched.agg((F.count(F.lit(1)) == 0).alias("equal"))


def keys_region_domain(geo: DataFrame, key: str, levels: Sequence[str]) -> DataFrame:
    """Distinct regions of every level: REGION_TYPE, REGION_ID."""
    from tabguard.operators.expand import unpivot_regions

    return unpivot_regions(geo, key, levels).select("REGION_TYPE", "REGION_ID").distinct()
