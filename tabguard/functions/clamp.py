"""Clipping that keeps nulls (``least`` and ``greatest`` would skip them)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: Any, high: Any) -> Column:
    """``value`` moved into [low, high]; null stays null."""
    low, high = F.lit(low), F.lit(high)
    return F.when(value < low, low).when(value > high, high).otherwise(value)
