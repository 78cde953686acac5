import math

import pytest

from tabguard.operators.cleaning import prepare_geo
from tabguard.plans import stored
from tabguard.plans import tabulate as tab
from tabguard.plans.tables import COUNTED, TABLES, WITH_TAU

P = "RTYPE string, MAFID long, QAGE long, CENHISP long, CENRACE string, RELSHIP string"
U = (
    "RTYPE string, MAFID long, FINAL_POP long, NPF long, HHSPAN long, HHRACE string, TEN string, "
    "HHT string, HHT2 string, CPLT string"
)
G = "RTYPE string, MAFID long, TABBLKST string"


def toy(spark):
    """A lone parent who owns and a couple of one sex who rent, an empty unit and a dormitory; invented."""
    persons = [
        ("3", 612000701, 52, 1, "04", "20"),
        ("3", 612000701, 16, 1, "04", "26"),
        ("3", 612000701, 9, 2, "04", "27"),
        ("3", 612000701, 2, 1, "10", "30"),
        ("3", 612000718, 31, 2, "06", "20"),
        ("3", 612000718, 29, 1, "01", "24"),
        ("3", 612000718, 14, 1, "01", "31"),
        ("5", 612000732, 20, 1, "02", "38"),
    ]
    units = [
        ("2", 612000701, 4, 4, 1, "04", "1", "3", "10", "5"),
        ("2", 612000718, 3, 2, 2, "06", "4", "7", "04", "4"),
        ("2", 612000725, 0, 0, 0, "00", "0", "0", "00", "0"),
        ("4", 612000732, 1, 0, 0, "00", "0", "0", "00", "0"),
    ]
    geo = [("2", 612000701, "17"), ("2", 612000718, "38"), ("2", 612000725, "38"), ("4", 612000732, "17")]
    frames = spark.createDataFrame(persons, P), spark.createDataFrame(units, U), spark.createDataFrame(geo, G)
    return frames[0], frames[1], prepare_geo(frames[2])


def budgets(value):
    out = {}
    for name in COUNTED:
        levels = ["*"] if TABLES[name].race is None else ["A-G", "H,I", "*"]
        out[name] = {f"{r}_{i}": value for r in ("usa", "state") for i in levels}
    return out


def rows(df, name):
    picked = df.filter(f"TABLE = '{name}' AND REGION_TYPE = 'USA'").collect()
    return {(r.ITERATION_CODE, r.DATA_CELL): r.COUNT for r in picked if r.COUNT}


def test_exact_tables(spark):
    out = tab.exact_tabulations(*toy(spark)).cache()
    # Persons by household type: four with the lone parent, three with the couple.
    assert rows(out, "PH2") == {("*", 1): 7, ("*", 5): 3, ("*", 7): 3, ("*", 8): 4, ("*", 10): 4}
    # Own children under 18 of a lone mother: one of 6 to 11, one of 12 or more.
    assert rows(out, "PH6") == {("*", 1): 2, ("*", 12): 2, ("*", 15): 1, ("*", 16): 1}
    assert rows(out, "PH1_num") == {
        ("D", 1): 4, ("D", 2): 3, ("D", 3): 1, ("F", 1): 3, ("F", 2): 1, ("F", 3): 2,
        ("H", 1): 3, ("H", 2): 1, ("H", 3): 2, ("*", 1): 7, ("*", 2): 4, ("*", 3): 3,
    }
    assert rows(out, "PH1_denom")[("*", 2)] == 2
    # Minors by their own race: two own children, a grandchild, and another relative who is white and not Hispanic.
    assert rows(out, "PH3") == {
        ("D", 1): 2, ("D", 3): 2, ("D", 6): 2, ("H", 1): 1, ("H", 3): 1, ("H", 6): 1, ("G", 1): 1, ("G", 8): 1, ("G", 9): 1,
        ("A", 1): 1, ("A", 8): 1, ("A", 10): 1, ("I", 1): 1, ("I", 8): 1, ("I", 10): 1,
        ("*", 1): 4, ("*", 3): 2, ("*", 6): 2, ("*", 8): 2, ("*", 9): 1, ("*", 10): 1,
    }
    # Families are the lone parent's household only; persons of units by tenure.
    assert rows(out, "PH4") == {("D", 1): 4, ("D", 2): 3, ("D", 3): 1, ("*", 1): 4, ("*", 2): 3, ("*", 3): 1}
    assert rows(out, "PH8_num") == {
        ("D", 1): 4, ("D", 2): 4, ("F", 1): 3, ("F", 3): 3, ("H", 1): 3, ("H", 3): 3, ("*", 1): 7, ("*", 2): 4, ("*", 3): 3,
    }
    assert rows(out, "PH4") == rows(out, "PH5_num")


def test_private_at_infinite_budget_equals_exact_leaves(spark):
    persons, units, geo = toy(spark)
    taus = {n: 50 for n in WITH_TAU}
    private = tab.private_tabulations(persons, units, geo, taus, budgets(math.inf), "pure").cache()
    both = private.unionByName(tab.derive_tables(private))
    exact = tab.exact_tabulations(persons, units, geo)
    for name, table in TABLES.items():
        leaves = set(table.leaf_cells)
        truth = {k: v for k, v in rows(exact, name).items() if k[1] in leaves}
        assert rows(both, name) == truth, name
    # USA + 2 states, 10 iterations, 2 cells: every key is present.
    assert private.filter("TABLE = 'PH1_num'").count() == 3 * 10 * 2


@pytest.mark.parametrize("tau,expected", [(4, 8), (5, 9)])
def test_truncation(spark, tau, expected):
    persons = spark.createDataFrame(
        [("3", 612000701, 13, 1, "04", "26")] * 4 + [("3", 612000718, 13, 1, "04", "26")] * 5, P
    )
    units = spark.createDataFrame(
        [("2", m, n, 2, 1, "04", "1", "2", "06", "5") for m, n in [(612000701, 4), (612000718, 5)]], U
    )
    geo = prepare_geo(spark.createDataFrame([("2", 612000701, "17"), ("2", 612000718, "17")], G))
    counts = tab.leaf_counts(persons, units, geo, {n: tau for n in WITH_TAU}).cache()
    for name in WITH_TAU:
        assert set(rows(counts, name).values()) == {expected}, name


def test_duplicate_units_are_dropped(spark):
    persons, units, geo = toy(spark)
    doubled = units.unionByName(units.filter("MAFID = 612000718"))
    counts = tab.leaf_counts(persons, doubled, geo, {n: 5 for n in WITH_TAU})
    assert rows(counts, "PH7") == {("D", 2): 4, ("*", 2): 4}


def test_noise_variance_and_zero_budgets(spark):
    persons, units, geo = toy(spark)
    plan = budgets(1)
    plan["PH3"] = {k: 0 for k in plan["PH3"]}
    plan["PH7"]["state_*"] = 0
    taus = {n: 4 for n in WITH_TAU}
    out = tab.private_tabulations(persons, units, geo, taus, plan, "concentrated", seed=1).cache()
    assert out.filter("TABLE = 'PH3'").count() == 0
    assert out.filter("TABLE = 'PH7' AND REGION_TYPE = 'STATE' AND ITERATION_CODE = '*'").count() == 0
    variances = {r.TABLE: r.VARIANCE for r in out.select("TABLE", "VARIANCE").distinct().collect()}
    assert variances["PH1_num"] == 50.0 and variances["PH1_denom"] == 2.0
    derived = tab.derive_tables(out)
    assert {r.DATA_CELL: r.VARIANCE for r in derived.filter("TABLE = 'PH8_num'").collect()} == {2: 100.0, 3: 50.0}


def test_trials_are_independent_draws_of_one_tabulation(spark):
    persons, units, geo = toy(spark)
    taus = {n: 4 for n in WITH_TAU}
    few, many = (tab.private_tabulations(persons, units, geo, taus, budgets(1), "pure", seed=2, trials=n) for n in (2, 40))
    nodes = [len(d._jdf.queryExecution().executedPlan().toString().splitlines()) for d in (few, many)]
    assert nodes[0] == nodes[1]
    cell = many.where("TABLE = 'PH7' AND REGION_TYPE = 'USA' AND ITERATION_CODE = '*' AND DATA_CELL = 2").collect()
    assert sorted(r.TRIAL for r in cell) == list(range(40)) and len({r.COUNT for r in cell}) > 5
    own = few.where("TABLE = 'PH7'").collect()
    assert {tuple(r) for r in own} <= {tuple(r) for r in many.where("TABLE = 'PH7'").collect()}  # the same key, the same draws


def _exchanges(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [x for x in lines if "Exchange hashpartitioning(MAFID" in x or "Exchange hashpartitioning(knownfloatingpointnormalized(MAFID" in x]


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*tab.LONG).collect())


@pytest.mark.parametrize("crowd", [100, 3])
def test_stored_households(spark, tmp_path, crowd):
    """The same counts from stored households, also where some are crowded, in a plan that deals no person."""
    persons, units, geo = toy(spark)
    nobody = spark.createDataFrame([("3", None, 40, 1, "01", "20")], P)
    persons, taus = persons.unionByName(nobody), {n: 2 for n in WITH_TAU}
    kept = stored.store_households(persons, units, geo, str(tmp_path / "h"), crowd=crowd)
    assert kept.crowded_persons.count() == (0 if crowd == 100 else 7)
    assert kept.persons.count() + kept.crowded_persons.count() == 8
    exact = _sorted(tab.exact_tabulations(persons, units, geo))
    assert _sorted(stored.exact_stored(kept)) == exact
    assert _sorted(stored.exact_stored(stored.open_households(spark, str(tmp_path / "h")), ["PH3"])) == [r for r in exact if r[0] == "PH3"]
    private = stored.private_stored(kept, geo, taus, budgets(math.inf), "pure")  # truncated counts on the whole key set
    assert _sorted(private) == _sorted(tab.private_tabulations(persons, units, geo, taus, budgets(math.inf), "pure"))


def test_stored_plans_deal_no_person(spark, tmp_path):
    persons, units, geo = toy(spark)
    kept = stored.store_households(persons, units, geo, str(tmp_path / "h"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(tab.exact_tabulations(persons, units, geo))
        assert not _exchanges(tab.exact_tabulations(kept.persons, kept.units, None, unit_geo=kept.units))
        taus = {n: 2 for n in WITH_TAU}
        assert not _exchanges(tab.leaf_counts(kept.persons, kept.units, None, taus, unit_geo=kept.units))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_stored_folder_must_be_whole_and_is_not_overwritten(spark, tmp_path):
    persons, units, geo = toy(spark)
    with pytest.raises(ValueError):
        stored.open_households(spark, str(tmp_path / "none"))
    empty = stored.store_households(persons.limit(0), units.limit(0), geo, str(tmp_path / "h"))
    assert stored.exact_stored(empty).count() == 0
    with pytest.raises(ValueError):
        stored.store_households(persons, units, geo, str(tmp_path / "h"))
