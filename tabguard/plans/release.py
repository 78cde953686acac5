"""From household files to published tables: read, check, tabulate, check again, write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.functions.domains import Categories, Pattern, Range
from tabguard.operators.cleaning import prepare_geo
from tabguard.plans import quality, tabulate
from tabguard.plans.tables import TABLES
from tabguard.runtime import materialise
from tabguard.sources.sinks import sink_tabulations
from tabguard.sources.text import scan_csv_typed, scan_restrict_by_region

# Columns and allowed values of the three input files.
SCHEMAS = {
    "persons": "RTYPE string, MAFID long, QAGE long, CENHISP long, CENRACE string, RELSHIP string",
    "units": (
        "RTYPE string, MAFID long, FINAL_POP long, NPF long, HHSPAN long, HHRACE string, TEN string, "
        "HHT string, HHT2 string, CPLT string"
    ),
    "geo": (
        "RTYPE string, MAFID long, TABBLKST string, TABBLKCOU string, TABTRACTCE string, TABBLK string, "
        "TABBLKGRPCE string, REGIONCE string, DIVISIONCE string, PLACEFP string, AIANNHCE string"
    ),
}


def _codes(first: int, last: int, width: int = 1) -> tuple[str, ...]:
    return tuple(str(i).zfill(width) for i in range(first, last + 1))


_KEY = Range("MAFID", 100000001, 900000000)
DOMAINS = {
    "persons": [
        Categories("RTYPE", ("3", "5")),
        _KEY,
        Range("QAGE", 0, 116),
        Categories("CENHISP", (1, 2)),
        Categories("CENRACE", _codes(1, 63, 2)),
        Categories("RELSHIP", _codes(20, 38)),
    ],
    "units": [
        Categories("RTYPE", ("2", "4")),
        _KEY,
        Range("FINAL_POP", 0, 100000),
        Categories("NPF", (0, *range(2, 98))),
        Categories("HHSPAN", (0, 1, 2)),
        Categories("HHRACE", _codes(0, 63, 2)),
        Categories("TEN", _codes(0, 4)),
        Categories("HHT", _codes(0, 7)),
        Categories("HHT2", _codes(0, 12, 2)),
        Categories("CPLT", _codes(0, 5)),
    ],
    "geo": [
        Categories("RTYPE", ("2", "4")),
        _KEY,
        Categories("REGIONCE", ("1", "2", "3", "4", "9")),
        *(
            Pattern(name, rf"\d{{{width}}}")
            for name, width in {
                "TABBLKST": 2,
                "TABBLKCOU": 3,
                "TABTRACTCE": 6,
                "TABBLK": 4,
                "TABBLKGRPCE": 1,
                "DIVISIONCE": 1,
                "PLACEFP": 5,
                "AIANNHCE": 4,
            }.items()
        ),
    ],
}


def read_inputs(spark: SparkSession, folder: str, states: Sequence[str]) -> dict[str, DataFrame]:
    """persons, units and geo of the chosen states from CSV files with header."""
    root = folder.rstrip("/")
    geo = scan_csv_typed(spark, f"{root}/geo.csv", SCHEMAS["geo"], "TABBLKST", states)
    tables = {"geo": geo}
    for name in ("units", "persons"):
        rows = scan_csv_typed(spark, f"{root}/{name}.csv", SCHEMAS[name])
        tables[name] = scan_restrict_by_region(rows, geo, "MAFID")
    return tables


def check_inputs(tables: Mapping[str, DataFrame], states: Sequence[str] | None = None) -> DataFrame:
    """All violations in the inputs: ``check``, ``table``, ``column``, ``value``, ``n_rows``.

    Values outside their domain, repeated keys of units and geography, keys without partner, and states
    out of scope. Empty means the inputs are as expected.
    """
    found = []
    for name, domains in DOMAINS.items():
        bad = quality.dq_values(tables[name], domains)
        found.append(_violations(bad, "value outside domain", name, "column", "value", "n_rows"))
    for name in ("units", "geo"):
        bad = quality.dq_duplicate_keys(tables[name], ["MAFID"])
        found.append(_violations(bad, "repeated key", name, None, "MAFID", "n_rows"))
    orphans = quality.dq_orphan_keys(tables["persons"], tables["units"], tables["geo"], "MAFID")
    found.append(_violations(orphans, "key without partner", None, None, "MAFID", None, table="gap"))
    if states is not None:
        outside = quality.dq_region_scope(tables["geo"], "TABBLKST", states)
        found.append(_violations(outside, "state out of scope", "geo", None, "TABBLKST", None))
    return reduce(DataFrame.unionByName, found)


def _violations(df, check, name, column, value, n_rows, table=None) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        (F.col(table) if table else F.lit(name)).alias("table"),
        (F.col(column) if column else F.lit(value)).alias("column"),
        F.col(value).cast("string").alias("value"),
        (F.col(n_rows) if n_rows else F.lit(None).cast("long")).alias("n_rows"),
    )


def check_outputs(
    answers: DataFrame,
    budgets: Mapping[str, Mapping[str, object]],
    taus: Mapping[str, int],
    definition: str,
    states: Sequence[str],
) -> DataFrame:
    """Violations in noisy tables: format, states out of scope, and variances off the formula."""
    outputs, domains = {}, {}
    for name, t in TABLES.items():
        outputs[name] = tabulate.one_table(answers, name)
        domains[name] = quality.output_domains(t)
    bad = quality.dq_output_format(outputs, domains)
    found = [_violations(bad, "value outside domain", None, "column", "value", "n_rows", table="table")]
    regions = answers.filter("REGION_TYPE = 'STATE'")
    outside = quality.dq_region_scope(regions, "REGION_ID", states)
    found.append(_violations(outside, "state out of scope", "all", None, "REGION_ID", None))
    expected = quality.expected_variance_rows(answers.sparkSession, budgets, taus, definition)
    off = quality.dq_output_variance(answers, expected)
    found.append(_violations(off, "variance off the formula", None, None, "VARIANCE", None, table="TABLE"))
    return reduce(DataFrame.unionByName, found)


def publish_private(
    tables: Mapping[str, DataFrame],
    taus: Mapping[str, int],
    budgets: Mapping[str, Mapping[str, object]],
    definition: str,
    folder: str | None = None,
) -> DataFrame:
    """Noisy tables in long form, drawn once; written per table when a folder is given."""
    geo = prepare_geo(tables["geo"])
    with tabulate.shared_units(tables["units"], geo) as unit_geo:
        counted = materialise(
            tabulate.private_tabulations(
                tables["persons"],
                tables["units"],
                geo,
                taus,
                budgets,
                definition,
                unit_geo=unit_geo,
            )
        )
    answers = counted.unionByName(tabulate.derive_tables(counted))
    if folder is not None:
        sink_tabulations(answers, folder)
    return answers


def publish_exact(tables: Mapping[str, DataFrame], folder: str | None = None) -> DataFrame:
    """True tables in long form; written per table when a folder is given."""
    geo = prepare_geo(tables["geo"])
    with tabulate.shared_units(tables["units"], geo) as unit_geo:
        answers = materialise(
            tabulate.exact_tabulations(
                tables["persons"], tables["units"], geo, unit_geo=unit_geo
            )
        )
    if folder is not None:
        sink_tabulations(answers, folder)
    return answers
