"""Projections, filters and cleaning of protected tables as plain Column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabguard.functions.binning import Bins
from tabguard.functions.clamp import clamp

_INTEGERS = (T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_ALLOWED = (
    *_INTEGERS, *_FLOATS, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType
)


def is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _FLOATS)


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _INTEGERS)


def coerce_types(df: DataFrame) -> DataFrame:
    """Widen integers to long and floats to double, give timestamps the session's time zone.

    Any other type and empty names are errors.
    """
    columns = []
    for f in df.schema.fields:
        if not f.name:
            raise ValueError("columns must have a name")
        if not isinstance(f.dataType, _ALLOWED):
            raise ValueError(f"column {f.name} has the unsupported type {f.dataType.simpleString()}")
        if isinstance(f.dataType, T.IntegerType):
            columns.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            columns.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; unknown sources and names already taken are errors."""
    for old, new in names.items():
        if old not in df.columns:
            raise ValueError(f"no column {old} to rename")
        if not new:
            raise ValueError("columns must have a name")
        if new != old and new in df.columns and new not in names:
            raise ValueError(f"column {new} exists already")
    return df.withColumnsRenamed(dict(names))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection by name; repeated and unknown names are errors."""
    if len(set(columns)) != len(columns):
        raise ValueError("a column is selected twice")
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*columns)


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the SQL predicate holds."""
    return df.filter(F.expr(condition))


def map_augment(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Add computed columns and keep all others."""
    taken = set(new) & set(df.columns)
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    return df.withColumns(dict(new))


def map_replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Only the computed columns."""
    return df.select(*[c.alias(name) for name, c in new.items()])


def bin_column(df: DataFrame, column: str, bins: Bins, name: str | None = None) -> DataFrame:
    """Add the bin of ``column`` as ``<column>_binned`` or ``name``."""
    return map_augment(
        df, {name or f"{column}_binned": bins.column(F.col(column), is_float(df, column))}
    )


def default_value(data_type: T.DataType) -> Any:
    """What a missing value becomes unless told otherwise: 0, 0.0, "" or the epoch."""
    if isinstance(data_type, T.StringType):
        return ""
    if isinstance(data_type, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(data_type, T.TimestampType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp")
    return 0.0 if isinstance(data_type, _FLOATS) else 0


def replace_null_nan(df: DataFrame, values: Mapping[str, Any] | None = None) -> DataFrame:
    """Replace null and NaN in the given columns, or in all by the default of their type."""
    if not values:
        values = {f.name: default_value(f.dataType) for f in df.schema.fields}
    new = {}
    for name, value in values.items():
        bad = F.col(name).isNull()
        if is_float(df, name):
            bad = bad | F.isnan(name)
        new[name] = F.when(bad, F.lit(value)).otherwise(F.col(name))
    return df.withColumns(new)


def _float_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if not columns:
        return [f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATS)]
    for c in columns:
        if not is_float(df, c):
            raise ValueError(f"column {c} cannot hold infinite values")
    return list(columns)


def replace_infinity(
    df: DataFrame, values: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Replace -inf by the first and +inf by the second value of a pair; (0, 0) unless given."""
    values = values or {c: (0.0, 0.0) for c in _float_columns(df, None)}
    _float_columns(df, list(values))
    return df.withColumns(
        {
            c: F.when(F.col(c) == F.lit(float("-inf")), F.lit(float(low)))
            .when(F.col(c) == F.lit(float("inf")), F.lit(float(high)))
            .otherwise(F.col(c))
            for c, (low, high) in values.items()
        }
    )


def drop_null_nan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with null or NaN in one of the columns (all when none is given)."""
    return df.na.drop(subset=list(columns) if columns else None)


def drop_infinity(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with an infinite value in one of the columns; null and NaN rows stay."""
    for c in _float_columns(df, columns):
        infinite = F.col(c).isin(float("inf"), float("-inf"))
        df = df.filter(~F.coalesce(infinite, F.lit(False)))
    return df


def clamp_measure(value: Column, low: Any, high: Any) -> Column:
    """``value`` moved into [low, high]; null stays null."""
    return clamp(value, low, high)


def blank_to_sentinel(df: DataFrame, columns: Sequence[str], sentinel: str) -> DataFrame:
    """Strings of blanks only become ``sentinel``; the empty string stays as it is."""
    return df.withColumns(
        {c: F.when(F.col(c).rlike(r"^\s+\z"), F.lit(sentinel)).otherwise(F.col(c)) for c in columns}
    )


_RULE = re.compile(r"^\s*(\w+)\[(\w+)\]\s*=\s*(.+?)\s*$", re.S)


def recode_columns(df: DataFrame, table: str, rules: Sequence[str]) -> DataFrame:
    """Derived columns from rules ``TABLE[VAR] = <SQL expression>``, applied in order.

    ``TABLE[VAR]`` inside the expression names a column of the row.
    """
    for rule in rules:
        parts = _RULE.match(rule)
        if parts is None:
            raise ValueError(f"not a recode rule: {rule}")
        target, variable, text = parts.groups()
        if target == table:
            df = df.withColumn(variable, F.expr(re.sub(r"\b\w+\[([A-Za-z_]\w*)\]", r"`\1`", text)))
    return df


def out_of_domain_rows(df: DataFrame, domains: Sequence[Any], strategy: str) -> DataFrame:
    """Treat values outside their domain: list the rows (``error``), ``remove`` them, or ``clip``.

    Null is outside every domain. ``error`` returns the offending rows, for the caller to fail on.
    """
    valid = F.lit(True)
    for d in domains:
        valid = valid & F.coalesce(d.valid(), F.lit(False))
    if strategy == "error":
        return df.filter(~valid)
    if strategy == "remove":
        return df.filter(valid)
    if strategy == "clip":
        return df.withColumns({d.column: d.clipped() for d in domains})
    raise ValueError(f"unknown strategy {strategy!r}")


def prepare_geo(geo: DataFrame) -> DataFrame:
    """Geography of housing units with a constant nation level: MAFID, USA, STATE."""
    return geo.filter(~F.col("RTYPE").isin("4", "5")).select(
        "MAFID", F.lit("1").alias("USA"), F.col("TABBLKST").alias("STATE")
    )
