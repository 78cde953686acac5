"""Column domains: validity, integer codes and linear cell indices, as Column expressions.

A domain is either a full-match text pattern, a half-open range cut into equal bins, an ordered list
of split points (closed at the top), or a list of categories.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabguard.functions.clamp import clamp


@dataclass(frozen=True)
class Pattern:
    """Text that matches a regular expression as a whole."""

    column: str
    pattern: str

    def valid(self) -> Column:
        return F.col(self.column).cast("string").rlike(f"^(?:{self.pattern})\\z")

    def clipped(self) -> Column:
        raise ValueError(f"{self.column}: text cannot be clipped to a pattern")


@dataclass(frozen=True)
class Range:
    """Numbers in [low, high), cut into ``bins`` equal bins for encoding."""

    column: str
    low: float
    high: float
    bins: int = 1

    @property
    def size(self) -> int:
        return self.bins

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.bins

    def valid(self) -> Column:
        c = F.col(self.column)
        return (c >= F.lit(self.low)) & (c < F.lit(self.high))

    def clipped(self) -> Column:
        return clamp(F.col(self.column), self.low, self.high)

    def code(self) -> Column:
        raw = F.floor((F.col(self.column) - F.lit(self.low)) / F.lit(self.width))
        # The upper bound itself belongs to the last bin.
        return F.when(raw == self.bins, F.lit(self.bins - 1)).otherwise(raw).cast("long")

    def value(self, code: Column) -> Column:
        low = code * F.lit(self.width) + F.lit(self.low)
        return F.struct(
            low.cast("double").alias("low"), (low + F.lit(self.width)).cast("double").alias("high")
        )


@dataclass(frozen=True)
class Splits:
    """Numbers in [first split, last split], cut at the given points."""

    column: str
    splits: tuple

    @property
    def size(self) -> int:
        return len(self.splits) - 1

    def valid(self) -> Column:
        return F.col(self.column).between(self.splits[0], self.splits[-1])

    def clipped(self) -> Column:
        return clamp(F.col(self.column), self.splits[0], self.splits[-1])

    def code(self) -> Column:
        out = None
        for i, upper in enumerate(self.splits[1:-1]):
            test = F.col(self.column) < F.lit(upper)
            out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
        last = F.lit(self.size - 1)
        out = last if out is None else out.otherwise(last)
        return F.when(F.col(self.column).isNotNull(), out).cast("long")

    def value(self, code: Column) -> Column:
        edges = F.array(*[F.lit(float(s)) for s in self.splits])
        return F.struct(
            F.get(edges, code.cast("int")).alias("low"),
            F.get(edges, code.cast("int") + 1).alias("high"),
        )


@dataclass(frozen=True)
class Categories:
    """One of the listed values; the code is the position in the list."""

    column: str
    values: tuple

    @property
    def size(self) -> int:
        return len(self.values)

    def _list(self) -> Column:
        return F.array(*[F.lit(v) for v in self.values])

    def valid(self) -> Column:
        return F.col(self.column).isin(list(self.values))

    def clipped(self) -> Column:
        raise ValueError(f"{self.column}: categories cannot be clipped")

    def code(self) -> Column:
        position = F.array_position(self._list(), F.col(self.column))
        return F.nullif(position, F.lit(0)).cast("long") - 1

    def value(self, code: Column) -> Column:
        return F.get(self._list(), code.cast("int"))


Domain = Pattern | Range | Splits | Categories


def code_columns(domains: Sequence[Any]) -> dict[str, Column]:
    """Codes 0..n-1 of every column."""
    return {d.column: d.code() for d in domains}


def value_columns(domains: Sequence[Any]) -> dict[str, Column]:
    """Values (categories) or (low, high) intervals behind the codes of every column."""
    return {d.column: d.value(F.col(d.column)) for d in domains}


def _strides(domains: Sequence[Any]) -> list[int]:
    strides, step = [], 1
    for d in reversed(domains):
        strides.append(step)
        step *= d.size
    return strides[::-1]


def cell_index(domains: Sequence[Any]) -> Column:
    """Row-major index of a tuple of codes."""
    index = F.lit(0).cast("long")
    for d, stride in zip(domains, _strides(domains)):
        index = index + F.col(d.column).cast("long") * F.lit(stride)
    return index


def cell_codes(index: Column, domains: Sequence[Any]) -> dict[str, Column]:
    """Codes behind a row-major index."""
    return {
        d.column: F.pmod(F.call_function("div", index, F.lit(stride)), F.lit(d.size)).cast("long")
        for d, stride in zip(domains, _strides(domains))
    }
