"""Random records from declared ranges, one Spark row at a time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Declared:
    """A variable: ``choices`` lists values, ``ranges`` lists number ranges, else text of ``width``.

    One choice or range is picked evenly, then a value evenly inside it. ``kind`` is ``integer``,
    ``decimal`` or ``text``; ``prefix`` is put before the value.
    """

    name: str
    kind: str = "text"
    width: int = 6
    choices: tuple[str, ...] = ()
    ranges: tuple[tuple[float, float], ...] = ()
    prefix: str = ""

    def column(self, seed: int) -> Column:
        value = self._value(seed)
        return F.concat(F.lit(self.prefix), value.cast("string")) if self.prefix else value

    def _value(self, seed: int) -> Column:
        if self.choices:
            return F.get(F.array(*[F.lit(c) for c in self.choices]), _pick(len(self.choices), seed))
        if self.ranges:
            pick = _pick(len(self.ranges), seed)
            low = F.get(F.array(*[F.lit(float(a)) for a, _ in self.ranges]), pick)
            high = F.get(F.array(*[F.lit(float(b)) for _, b in self.ranges]), pick)
            if self.kind == "decimal":
                return low + F.rand(seed + 1) * (high - low)
            return F.floor(low + F.rand(seed + 1) * (high - low + 1)).cast("long")
        if self.kind == "integer":
            return F.floor(F.rand(seed) * F.lit(float(10**self.width))).cast("long")
        letters = [
            F.substring(F.lit(LETTERS), _pick(26, seed + i) + 1, F.lit(1)) for i in range(self.width)
        ]
        return F.concat(*letters)


def _pick(n: int, seed: int) -> Column:
    return F.floor(F.rand(seed) * n).cast("int")


def synthesize_from_schema(rows: DataFrame, variables: Sequence[Declared], seed: int) -> DataFrame:
    """One random record per input row; ``rows`` gives the number and the partitioning.

    Columns of ``rows`` are kept in front. The draws depend on the seed and on the partitioning.
    """
    new = {v.name: v.column(seed + 1000 * i) for i, v in enumerate(variables)}
    return rows.withColumns(new)
