"""Operators that turn one row into several, all as ``explode`` over array expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flat_map_rows(
    df: DataFrame,
    items: Column,
    max_rows: int,
    name: str | None = None,
    augment: bool = True,
) -> DataFrame:
    """One row per element of ``items``, at most ``max_rows`` per input row; the surplus is dropped.

    ``items`` is an array of values (``name`` is their column) or of structs (their fields become
    columns). Without ``augment`` only the new columns are kept.
    """
    if max_rows < 0:
        raise ValueError("max_rows must not be negative")
    kept = F.slice(items, 1, max_rows)
    base = [F.col(c) for c in df.columns] if augment else []
    if name is not None:
        return df.select(*base, F.explode(kept).alias(name))
    return df.select(*base, F.inline(kept))


def unpivot_regions(geo: DataFrame, key: str, levels: Sequence[str]) -> DataFrame:
    """One row per unit and region level: key, REGION_TYPE, REGION_ID."""
    return geo.unpivot([key], list(levels), "REGION_TYPE", "REGION_ID")


# Race codes of the single-race groups and their iteration letters, the letter of all
# other races, the ethnicity codes, and the letters of the ethnicity iterations.
SINGLE_RACES = {"01": "A", "02": "B", "03": "C", "04": "D", "05": "E", "06": "F"}
SEVERAL_RACES = "G"
HISPANIC, NOT_HISPANIC = 2, 1
HISPANIC_LETTER, WHITE_NOT_HISPANIC_LETTER = "H", "I"
EVERYBODY = "*"
ITERATIONS = {
    "A-G": ["A", "B", "C", "D", "E", "F", "G"],
    "H,I": ["H", "I"],
    "*": ["*"],
}


def race_letter(race: Column, strict: bool = False) -> Column:
    """A to F for one race, G for any other code, null without one.

    ``strict`` gives G to the valid codes 07 to 63 only, so that "00" has no letter.
    """
    out = F.when(race.isNull(), F.lit(None))
    for code, letter in SINGLE_RACES.items():
        out = out.when(race == code, F.lit(letter))
    if strict:
        return out.when(race.between("07", "63"), F.lit(SEVERAL_RACES))
    return out.otherwise(F.lit(SEVERAL_RACES))


def ethnicity_letter(race: Column, ethnicity: Column) -> Column:
    """H, I, or null where neither applies."""
    return F.when(ethnicity == HISPANIC, F.lit(HISPANIC_LETTER)).when(
        (race == "01") & (ethnicity == NOT_HISPANIC), F.lit(WHITE_NOT_HISPANIC_LETTER)
    )


def iteration_codes(race: Column, ethnicity: Column, strict: bool = False) -> Column:
    """Array of the iterations a record counts in: one of A-G, H or I if any, and ``*``."""
    return F.array_compact(
        F.array(race_letter(race, strict), ethnicity_letter(race, ethnicity), F.lit(EVERYBODY))
    )


def explode_iterations(df: DataFrame, race: str, ethnicity: str) -> DataFrame:
    """One row per population iteration of each record, in ITERATION_CODE."""
    return df.withColumn("ITERATION_CODE", F.explode(iteration_codes(F.col(race), F.col(ethnicity))))


def with_ancestors(leaf: Column, parents: Mapping[int, int], total: int | None = 1) -> Column:
    """Array of a leaf cell, its subtotal if it has one, and the total."""
    out = None
    for child, parent in parents.items():
        cells = [F.lit(child), F.lit(parent), *([] if total is None else [F.lit(total)])]
        value = F.array(*cells)
        out = F.when(leaf == child, value) if out is None else out.when(leaf == child, value)
    plain = F.array(leaf, *([] if total is None else [F.lit(total)]))
    return plain if out is None else out.otherwise(plain)


def explode_cell_hierarchy(
    df: DataFrame, leaf: Column, parents: Mapping[int, int], total: int | None, name: str
) -> DataFrame:
    """One row per level a record counts in: leaf cell, subtotal, total. No leaf, no rows."""
    return (
        df.withColumn("__leaf", leaf.cast("int"))
        .filter(F.col("__leaf").isNotNull())
        .withColumn(name, F.explode(with_ancestors(F.col("__leaf"), parents, total)))
        .drop("__leaf")
    )


def replicate_cells(df: DataFrame, cells: Sequence[int], name: str) -> DataFrame:
    """Repeat every row once per cell id."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(c) for c in cells])))
