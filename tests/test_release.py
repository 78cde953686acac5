"""End to end on small CSV files, with expected tables written out by hand."""

import math

import pytest

from tabguard.plans import release
from tabguard.sources import sinks
from tabguard.plans.tables import COUNTED, TABLES, WITH_TAU

# Invented households; the column headers are fixed values of the file format. A couple with two children who rent in
# state 38, beside two places that are no household; a mother with two children and a single person in state 17; a place
# in state 51.
PERSONS = """RTYPE,MAFID,QAGE,CENHISP,CENRACE,RELSHIP
3,612300345,41,2,05,20
3,612300345,38,1,05,21
3,612300345,8,2,03,25
3,612300345,3,2,03,25
5,612300352,27,1,04,38
5,612300369,81,2,02,37
3,612100118,33,1,02,20
3,612100118,11,1,02,27
3,612100118,6,1,02,26
3,612100125,58,1,04,20
5,612500501,22,2,01,37
"""
UNITS = """RTYPE,MAFID,FINAL_POP,NPF,HHSPAN,HHRACE,TEN,HHT,HHT2,CPLT
2,612300345,5,4,2,03,3,1,01,1
2,612300352,1,0,1,04,1,4,09,5
4,612300369,1,0,0,00,0,0,00,0
2,612100118,3,3,1,02,2,3,10,5
2,612100125,1,0,1,04,2,6,09,5
4,612500501,1,0,0,00,0,0,00,0
"""
GEO = """RTYPE,MAFID,TABBLKST,TABBLKCOU,TABTRACTCE,TABBLK,TABBLKGRPCE,REGIONCE,DIVISIONCE,PLACEFP,AIANNHCE
2,612300345,38,017,010400,3011,3,2,4,25700,0000
4,612300352,38,017,010400,3012,3,2,4,25700,0000
4,612300369,38,093,967900,1044,1,7,4,40580,0000
2,612100118,17,031,320100,2003,2,2,3,14000,0000
2,612100125,17,119,402700,5021,5,2,3,22255,0000
4,612500501,51,710,004300,1008,1,3,5,57000,0000
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    for name, text in {"persons": PERSONS, "units": UNITS, "geo": GEO}.items():
        (root / f"{name}.csv").write_text(text)
    return str(root)


def plan(value):
    out = {}
    for n in COUNTED:
        levels = ["*"] if TABLES[n].race is None else ["A-G", "H,I", "*"]
        out[n] = {f"{r}_{level}": value for r in ("usa", "state") for level in levels}
    return out


# (cell, count) of each table, worked out by hand; the same for the nation and state 38, and for C, H and *.
EXPECTED = {
    "PH1_num": {1: 4, 2: 2, 3: 2},
    "PH1_denom": {1: 1, 2: 1, 3: 1},
    "PH2": {1: 4, 2: 4, 3: 4},
    "PH3": {1: 2, 3: 2, 4: 2},
    "PH4": {1: 4, 2: 2, 3: 2},
    "PH5_num": {1: 4, 2: 2, 3: 2},
    "PH5_denom": {1: 1, 2: 1, 3: 1},
    "PH6": {1: 2, 2: 2, 3: 1, 5: 1},
    "PH7": {1: 4, 4: 4},
    "PH8_num": {1: 5, 3: 5},
    "PH8_denom": {1: 1, 3: 1},
}


def test_true_tables_of_one_state(spark, folder, tmp_path):
    tables = release.read_inputs(spark, folder, ["38"])
    assert tables["persons"].count() == 6 and tables["units"].count() == 3
    release.publish_exact(tables, str(tmp_path / "out"))
    for name, cells in EXPECTED.items():
        rows = sinks.read_release(spark, str(tmp_path / "out"), name).collect()
        letters = ["*"] if TABLES[name].race is None else ["*", "C", "H"]
        expected = {
            (region, kind, letter, str(cell), str(n))
            for region, kind in (("38", "STATE"), ("1", "USA"))
            for letter in letters
            for cell, n in cells.items()
        }
        got = {
            (r.REGION_ID, r.REGION_TYPE, r.ITERATION_CODE if TABLES[name].race else "*", r[TABLES[name].cell], r.COUNT)
            for r in rows
        }
        assert got == expected, name


def test_noisy_tables_pass_their_checks(spark, folder, tmp_path):
    tables = release.read_inputs(spark, folder, ["38", "17"])
    taus = {n: 5 for n in WITH_TAU}
    for definition in ("pure", "concentrated"):
        out = str(tmp_path / definition)
        answers = release.publish_private(tables, taus, plan("0.5"), definition, out)
        assert release.check_outputs(answers, plan("0.5"), taus, definition, ["38", "17"]).count() == 0
        bad = release.check_outputs(answers, plan("0.25"), taus, definition, ["38"])
        assert {r.check for r in bad.select("check").distinct().collect()} == {
            "state out of scope", "variance off the formula",
        }
        assert sinks.read_release(spark, out, "PH2").count() == 3 * 8
    exact = release.publish_private(tables, taus, plan(math.inf), "pure")
    assert exact.filter("TABLE = 'PH7' AND REGION_ID = '17' AND ITERATION_CODE = '*' AND DATA_CELL = 3").first().COUNT == 4


def test_input_checks(spark, folder):
    tables = release.read_inputs(spark, folder, ["17", "38", "51"])
    found = {(r.check, r.table, r.column, r.value) for r in release.check_inputs(tables, ["38", "17"]).collect()}
    assert found == {
        ("value outside domain", "geo", "REGIONCE", "7"),
        ("state out of scope", "geo", "TABBLKST", "51"),
    }
    worse = {**tables, "units": tables["units"].unionByName(tables["units"].filter("MAFID = 612300345"))}
    worse["persons"] = tables["persons"].selectExpr("RTYPE", "MAFID + 500 AS MAFID", "QAGE + 90 AS QAGE", "CENHISP", "CENRACE", "RELSHIP")
    found = {(r.check, r.table, r.value) for r in release.check_inputs(worse).collect()}
    assert ("repeated key", "units", "612300345") in found
    assert ("key without partner", "persons without unit", "612300845") in found
    assert ("value outside domain", "persons", "131") in found
