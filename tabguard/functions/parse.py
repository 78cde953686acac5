"""Text to numbers without exceptions: ``try_cast`` raises and catches one per bad value, which is slow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?\d{1,18}\z"
_WIDE = r"^[+-]?0*\d{1,19}\z"
_LEAST, _MOST = str(-(2**63)), str(2**63 - 1)
_DECIMAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"


def long_or_null(text: Column) -> Column:
    """Integer between blanks; null for any other text and for integers that a long cannot hold.

    Up to 18 digits fit whatever they are; only longer texts take the way over decimals.
    """
    trimmed = F.trim(text)
    wide = F.when(trimmed.rlike(_WIDE), trimmed.cast("decimal(38,0)"))
    checked = F.when(wide.between(F.lit(_LEAST).cast("decimal(38,0)"), F.lit(_MOST).cast("decimal(38,0)")), wide.cast("long"))
    return F.when(trimmed.rlike(_INTEGER), trimmed.cast("long")).when(F.length(trimmed) > 18, checked)


def number_or_null(text: Column, data_type: str) -> Column:
    """Text as ``data_type``; null where it does not read as one."""
    if data_type in ("long", "bigint"):
        return long_or_null(text)
    if data_type in ("int", "integer"):
        value = long_or_null(text)
        return F.when(value.between(-(2**31), 2**31 - 1), value.cast("int"))
    if data_type == "double":
        trimmed = F.trim(text)
        return F.when(trimmed.rlike(_DECIMAL), trimmed.cast("double"))
    return F.trim(text).try_cast(data_type)
