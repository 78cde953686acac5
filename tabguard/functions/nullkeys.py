"""Null-safe equality keys that keep a hash partitioning usable by several operators.

``a <=> b`` plans as equality on ``coalesce(a, default)`` and ``isnull(a)``. Writing both as real
columns lets a window and the join after it share one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _filler(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(data_type, T.TimestampType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp")
    return F.lit(0).cast(data_type)


def with_match_keys(
    df: DataFrame, other: DataFrame, columns: Sequence[str], prefix: str
) -> tuple[DataFrame, list[str]]:
    """Add ``prefix + i`` match columns for ``columns``; equal exactly when the columns are ``<=>``.

    A null flag is added when the column may be null in ``df`` or in ``other``, the table it will be
    joined to, so that both sides carry the same number of match columns.
    """
    added: dict[str, Column] = {}
    for i, name in enumerate(columns):
        field = df.schema[name]
        if field.nullable or other.schema[name].nullable:
            added[f"{prefix}{i}"] = F.coalesce(F.col(name), _filler(field.dataType))
            added[f"{prefix}{i}_null"] = F.col(name).isNull()
        else:
            added[f"{prefix}{i}"] = F.col(name)
    return df.withColumns(added), list(added)
