"""Record layouts and field rules of the edited household and person files.

A field rule is (width, allowed codes or ranges, whether blank is allowed). The names, positions,
codes and ranges are fixed values of the file format.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabguard.functions.parse import long_or_null


@dataclass(frozen=True)
class Field:
    """A text field: name, width, type of the typed column, and what is allowed in it.

    ``codes`` are allowed texts after left padding with blanks; ``ranges`` are compared as text of the
    field's width with blanks read as zeros; ``numbers`` are integer ranges.
    """

    name: str
    width: int
    kind: str = "string"
    codes: tuple[str, ...] = ()
    ranges: tuple[tuple[str, str], ...] = ()
    numbers: tuple[tuple[int, int], ...] = ()
    blank: bool = False
    any_integer: bool = False

    def valid(self) -> Column:
        """Whether the raw text of the field is allowed."""
        raw = F.col(self.name)
        ok = F.lit(False)
        if self.codes:
            ok = ok | F.lpad(raw, self.width, " ").isin([c.rjust(self.width) for c in self.codes])
        zeroed = F.lpad(F.regexp_replace(raw, " ", "0"), self.width, " ")
        for low, high in self.ranges:
            inside = zeroed.between(low.rjust(self.width), high.rjust(self.width))
            ok = ok | (inside & (F.length(raw) <= self.width))
        single = [low for low, high in self.numbers if low == high]
        for low, high in self.numbers:
            if low != high:
                ok = ok | F.coalesce(long_or_null(raw).between(low, high), F.lit(False))
        if single:
            ok = ok | F.coalesce(long_or_null(raw).isin(single), F.lit(False))
        if self.any_integer:
            ok = ok | F.trim(raw).rlike(r"^[+-]?\d+\z")
        if self.blank:
            ok = ok | (raw == " " * self.width)
        return F.coalesce(ok & (raw != "None"), F.lit(False))

    def allowed(self) -> str:
        """Allowed values in words, for failure reports."""
        parts = [f"{c}-{c}" for c in self.codes]
        parts += [f"{a}-{b}" for a, b in (*self.ranges, *self.numbers)]
        return ", ".join(parts)


def _digits(first: int, last: int, width: int = 1) -> tuple[str, ...]:
    return tuple(str(i).zfill(width) for i in range(first, last + 1))


_STATES = (("01", "02"), ("04", "06"), ("08", "13"), ("15", "42"), ("44", "51"), ("53", "56"))
_RACE = _digits(1, 63, 2)
_RACE_2010 = _digits(1, 9, 2) + _digits(10, 31, 2)
_GROUP_QUARTERS = (
    "101 102 103 104 105 106 201 202 203 301 401 402 403 404 405 501 601 602 701 702 704 706 801 802 "
    "900 901 903 904"
).split()
_DETAILED_RACE = ((1000, 8999), (9000, 9000), (9500, 9500), (9900, 9900))
_ORIGIN = ((1000, 8999), (9000, 9000), (9100, 9100), (9200, 9200), (9500, 9500), (9900, 9900), (9950, 9950))
_KEY = ((100000001, 899999999),)
_SMALL = ((0, 99),)

UNIT_FIELDS = (
    Field("RTYPE", 1, codes=("2", "4")),
    Field("MAFID", 9, "long", numbers=_KEY),
    Field("BCUSTATEFP", 2, codes=("72",), ranges=_STATES),
    Field("VERSION", 5, "long", numbers=((0, 99999),)),
    Field("FINAL_POP", 5, ranges=(("0", "99999"),)),
    Field("HHLDRAGE", 3, ranges=(("15", "115"),), blank=True),
    Field("HHSPAN", 1, codes=("1", "2"), blank=True),
    Field("HHLDRACE", 1, codes=_digits(1, 6), blank=True),
    Field("HHRACE", 2, codes=_RACE, blank=True),
    Field("TEN", 1, codes=_digits(0, 4)),
    Field("TEN_A", 1, codes=_digits(0, 4)),
    Field("TEN_R", 1, codes=_digits(0, 4)),
    Field("VACS", 1, codes=_digits(0, 7)),
    Field("QGQTYP", 3, codes=tuple(_GROUP_QUARTERS), blank=True),
    Field("GQSEX", 1, codes=_digits(1, 3), blank=True),
    Field("OIDTB", 22, "long", any_integer=True),
    Field("HHT", 1, codes=_digits(0, 7)),
    Field("HHT2", 2, codes=_digits(0, 12, 2)),
    Field("CPLT", 1, codes=_digits(0, 5)),
    Field("UPART", 1, codes=_digits(0, 5)),
    Field("MULTG", 1, codes=_digits(0, 2)),
    Field("PAOC", 1, codes=_digits(0, 4)),
    Field("P18", 2, "long", numbers=_SMALL),
    Field("P60", 2, "long", numbers=_SMALL),
    Field("P65", 2, "long", numbers=_SMALL),
    Field("P75", 2, "long", numbers=_SMALL),
    Field("PAC", 1, codes=_digits(0, 4)),
    Field("HHSEX", 1, codes=_digits(0, 2)),
)

PERSON_FIELDS = (
    Field("RTYPE", 1, codes=("3", "5")),
    Field("MAFID", 9, "long", numbers=_KEY),
    Field("CUF_PNC", 5, "long", numbers=((1, 99999),)),
    Field("BCUSTATEFP", 2, codes=("72",), ranges=_STATES),
    Field("VERSION", 5, "long", numbers=((0, 99999),)),
    Field("QSEX", 1, codes=("1", "2")),
    Field("QAGE", 3, "long", numbers=((0, 115),)),
    Field("QDB", 8, "long", numbers=((19040402, 20200401),)),
    Field("QDOB_MONTH", 2, "long", numbers=((1, 12),)),
    Field("QDOB_DAY", 2, "long", numbers=((1, 31),)),
    Field("QDOB_YEAR", 4, "long", numbers=((1904, 2020),)),
    Field("QSPAN", 4, "long", numbers=_ORIGIN),
    Field("QSPANX", 1, codes=_digits(1, 7)),
    Field("CENHISP", 1, "long", numbers=((1, 2),)),
    Field("QRACE1", 4, "long", numbers=_DETAILED_RACE),
    *(Field(f"QRACE{i}", 4, numbers=_DETAILED_RACE, blank=True) for i in range(2, 9)),
    Field("QRACEX", 1, codes=_digits(1, 6)),
    Field("CENRACE", 2, codes=_RACE),
    Field("RACE2010", 2, codes=_RACE_2010),
    Field("RELSHIP", 2, codes=_digits(20, 38)),
    Field("QGQTYP", 3, codes=tuple(_GROUP_QUARTERS), blank=True),
    Field("LIVE_ALONE", 1, codes=_digits(0, 2)),
)
