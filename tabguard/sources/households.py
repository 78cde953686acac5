"""Views of edited household and person files joined to block geography."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.functions.parse import long_or_null, number_or_null
from tabguard.operators.cleaning import blank_to_sentinel

# Relationship codes that count as family of the householder.
FAMILY_RELATIONS = ["20", "21", "23", "25", "26", "27", "28", "29", "30", "31", "32", "33"]
GEO_COLUMNS = (
    "TABBLKST TABBLKCOU TABTRACTCE TABBLK TABBLKGRPCE REGIONCE DIVISIONCE PLACEFP AIANNHCE"
).split()
RACE_CODES = [f"QRACE{i}" for i in range(1, 9)]


def upper_names(df: DataFrame) -> DataFrame:
    """All column names in capitals."""
    return df.toDF(*[c.upper() for c in df.columns])


def household_geo_join(units: DataFrame, geo: DataFrame) -> DataFrame:
    """Type and key of every unit with the geography of its block."""
    unit = upper_names(units).select("RTYPE", "MAFID", "OIDTB")
    return unit.join(upper_names(geo), F.col("OIDTB") == F.col("OIDTABBLK"))


def derive_family_size(persons: DataFrame, units: DataFrame) -> DataFrame:
    """Units with NPF: family members in housing units of two or more people, 0 unless above 1.

    Persons are counted per unit before they meet the units, so one unit is one row in the join.
    """
    family = (
        persons.filter(F.col("RELSHIP").isin(FAMILY_RELATIONS))
        .groupBy("MAFID")
        .agg(F.count(F.lit(1)).alias("__members"))
    )
    eligible = (long_or_null(F.col("FINAL_POP").cast("string")) >= 2) & (F.col("RTYPE") == "2")
    size = F.when(eligible & (F.col("__members") > 1), F.col("__members"))
    return (
        units.join(family, "MAFID", "left")
        .withColumn("NPF", F.coalesce(size, F.lit(0)).cast("long"))
        .drop("__members")
    )


def normalize_household(units: DataFrame) -> DataFrame:
    """Unit columns typed and ordered: numbers cast, missing ethnicity 0, blank race "00"."""
    out = units.withColumn("FINAL_POP", long_or_null(F.col("FINAL_POP")))
    out = out.withColumn("HHSPAN", F.coalesce(long_or_null(F.col("HHSPAN")), F.lit(0)))
    out = blank_to_sentinel(out, ["HHRACE"], "00")
    return out.select(
        "RTYPE", "MAFID", "FINAL_POP", "NPF", "HHSPAN", "HHRACE", "TEN", "HHT", "HHT2", "CPLT"
    )


def _joined(persons: DataFrame, units: DataFrame, geo: DataFrame) -> DataFrame:
    unit = units.select(*[c for c in units.columns if c == "MAFID" or c not in persons.columns])
    return persons.join(unit, "MAFID").join(geo, F.col("OIDTB") == F.col("OIDTABBLK"))


def person_geo_view(persons: DataFrame, units: DataFrame, geo: DataFrame) -> DataFrame:
    """Persons with block geography, a HOUSEHOLDER flag, and blank race codes as "Null"."""
    flag = F.when(F.col("RELSHIP") == "20", F.lit("True")).otherwise(F.lit("False"))
    out = _joined(persons, units, geo).withColumn("HOUSEHOLDER", flag)
    out = out.withColumns({c: F.col(c).cast("string") for c in [*RACE_CODES, "QSPAN"]})
    out = blank_to_sentinel(out, RACE_CODES, "Null")
    return out.select(
        "QAGE", "QSEX", "HOUSEHOLDER", "TABBLKST", "TABBLKCOU", "TABTRACTCE", "TABBLK", "CENRACE",
        *RACE_CODES, "QSPAN",
    )


def household_head_view(persons: DataFrame, units: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per household head; nonfamily households lose the sex of the householder (6->4, 7->5)."""
    kind = F.when(F.col("HHT") == "6", 4).when(F.col("HHT") == "7", 5)
    heads = persons.filter(F.col("RELSHIP") == "20")
    out = _joined(heads, units.filter(F.col("HHT") != "0"), geo)
    out = out.withColumn("HOUSEHOLD_TYPE", kind.otherwise(number_or_null(F.col("HHT"), "int")))
    out = out.withColumns({c: F.col(c).cast("string") for c in [*RACE_CODES, "QSPAN"]})
    out = out.withColumn("TEN", number_or_null(F.col("TEN"), "int"))
    out = blank_to_sentinel(out, [*RACE_CODES, "HHRACE"], "Null")
    return out.select(
        "TABBLKST", "TABBLKCOU", "TABTRACTCE", "TABBLK", "HHRACE", *RACE_CODES, "QSPAN",
        "HOUSEHOLD_TYPE", "TEN",
    )


def geo_with_units(geo: DataFrame, units: DataFrame) -> DataFrame:
    """Geography of blocks that hold units; a block missing from the geography shows as nulls."""
    blocks = units.select("OIDTB").distinct()
    return geo.join(blocks, F.col("OIDTB") == F.col("OIDTABBLK"), "right").select(*geo.columns)


def popgroup_region_filter(totals: DataFrame, geo: DataFrame, states: Sequence[str]) -> DataFrame:
    """Earlier totals of regions in scope.

    The nation always; states, counties, tracts and places when their composed id is in the geography
    and starts with a chosen state; tribal areas when they lie in the geography of a chosen state.
    """
    state = F.col("TABBLKST")
    county = F.concat(state, F.col("TABBLKCOU"))
    named = {
        "STATE": state,
        "COUNTY": county,
        "TRACT": F.concat(county, F.col("TABTRACTCE")),
        "PLACE": F.concat(state, F.col("PLACEFP")),
        "AIANNH": F.col("AIANNHCE"),
    }
    regions = geo.filter(state.isin(list(states))).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("__kind"), v.alias("__id")) for k, v in named.items()]
            )
        )
    ).distinct()
    kind = F.regexp_replace("REGION_TYPE", "^PR-", "")
    started = F.lit(False)
    for s in states:
        started = started | F.col("REGION_ID").startswith(s)
    nation = F.col("REGION_TYPE") == "USA"
    local = totals.filter(~nation & (started | (F.col("REGION_TYPE") == "AIANNH")))
    within = local.join(
        regions, (kind == F.col("__kind")) & (F.col("REGION_ID") == F.col("__id")), "left_semi"
    )
    return totals.filter(nation).unionByName(within).withColumn("COUNT", number_or_null(F.col("COUNT").cast("string"), "int"))
