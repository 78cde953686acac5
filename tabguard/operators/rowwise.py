"""Python functions of one row: any function, a declared and checked schema, a bounded number of rows out.

What Column expressions can say belongs there. These run a function per row on Arrow batches, next to the data and
without an exchange: only the columns the function reads become Python values, all others pass as Arrow arrays.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Row = Mapping[str, Any]

_INTEGERS = {T.ByteType(): 7, T.ShortType(): 15, T.IntegerType(): 31, T.LongType(): 63}
_CLASSES = {
    T.StringType: str,
    T.DoubleType: float,
    T.FloatType: float,
    T.BooleanType: bool,
    T.BinaryType: bytes,
    T.TimestampType: datetime.datetime,
    T.DecimalType: decimal.Decimal,
}


def _wrong(value: Any, field: T.StructField) -> str | None:
    """What keeps a value from the declared type; numbers are not converted into each other."""
    kind = field.dataType
    if value is None:
        return None if field.nullable else "null"
    if kind in _INTEGERS:
        bits = _INTEGERS[kind]
        if isinstance(value, bool) or not isinstance(value, int):
            return type(value).__name__
        return None if -(1 << bits) <= value < 1 << bits else "integer out of range"
    if isinstance(kind, T.DateType):
        fits = isinstance(value, datetime.date) and not isinstance(value, datetime.datetime)
        return None if fits else type(value).__name__
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, (list, tuple)):
            return type(value).__name__
        item = T.StructField(field.name, kind.elementType, kind.containsNull)
        return next((w for w in (_wrong(v, item) for v in value) if w), None)
    return None if isinstance(value, _CLASSES[type(kind)]) else type(value).__name__


def _declared(new: str | T.StructType) -> T.StructType:
    schema = T.StructType.fromDDL(new) if isinstance(new, str) else new
    for f in schema.fields:
        kind = f.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if kind not in _INTEGERS and not isinstance(kind, (*_CLASSES, T.DateType)):
            raise ValueError(f"{f.name}: no check for type {kind.simpleString()}")
    return schema


def _checked(out: Any, schema: T.StructType) -> tuple:
    names = schema.fieldNames()
    if not isinstance(out, Mapping) or set(out) != set(names):
        raise ValueError(f"the function gave {sorted(out) if isinstance(out, Mapping) else type(out).__name__} instead of {names}")
    for f in schema.fields:
        wrong = _wrong(out[f.name], f)
        if wrong:
            raise TypeError(f"the function gave {wrong} for {f.name} {f.dataType.simpleString()}")
    return tuple(out[n] for n in names)


def flat_map_function(
    df: DataFrame,
    function: Callable[[dict], Sequence[Row]],
    new: str | T.StructType,
    max_rows: int | None,
    augment: bool = True,
    inputs: Sequence[str] | None = None,
) -> DataFrame:
    """One row per mapping that ``function`` gives for a row, at most ``max_rows`` of them; the surplus is dropped.

    ``function`` gets a dictionary of the columns ``inputs`` (all without them). ``new`` declares what it gives: every
    mapping has these names, and values of these types, nulls only where allowed; anything else fails the query.
    Only ``max_rows`` mappings are taken from what it gives, so that a generator may be endless. Without a
    bound (``None``) all are. Without ``augment`` only the new columns are kept.
    """
    if max_rows is not None and max_rows < 0:
        raise ValueError("max_rows must not be negative")
    schema = _declared(new)
    read = list(df.columns if inputs is None else inputs)
    missing = set(read) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    taken = set(schema.fieldNames()) & set(df.columns) if augment else set()
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    kept = df.columns if augment else []
    source = df.select(*[c for c in df.columns if c in kept or c in read])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in read}
            for i in range(batch.num_rows):
                for n, out in enumerate(function({c: values[i] for c, values in columns.items()})):
                    if n == max_rows:
                        break
                    places.append(i)
                    rows.append(_checked(out, schema))
            own = [batch.column(batch.schema.get_field_index(c)).take(pa.array(places, pa.int64())) for c in kept]
            made = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*own, *made], [*kept, *types.names])

    fields = [df.schema[c] for c in kept] + schema.fields
    return source.mapInArrow(run, T.StructType(fields))


def map_function(
    df: DataFrame,
    function: Callable[[dict], Row],
    new: str | T.StructType,
    augment: bool = True,
    inputs: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with the mapping that ``function`` gives for it, or only that; see ``flat_map_function``."""
    return flat_map_function(df, lambda row: (function(row),), new, 1, augment, inputs)
