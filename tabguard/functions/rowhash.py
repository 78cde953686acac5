"""Deterministic ordering of the rows of one key, independent of the order of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(columns: Sequence[str]) -> Column:
    """md5 over the text of ``columns``, joined by ``|``; null columns are skipped by the join."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def digest_order(columns: Sequence[str]) -> list[Column]:
    """Sort order: digest first, then the columns themselves so that a collision is settled too."""
    return [row_digest(columns).asc(), *[F.col(c).asc_nulls_first() for c in columns]]
