import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabguard.functions.domains import Categories, Pattern, Range, Splits, cell_codes, cell_index, code_columns
from tabguard.operators.cleaning import out_of_domain_rows
from tabguard.plans import quality, report, smooth
from tabguard.plans.tables import COUNTED, TABLES

TAUS = {n: 4 for n in ("PH1_num", "PH2", "PH3", "PH4", "PH6", "PH7")}


def budgets(value, names=COUNTED):
    out = {}
    for n in names:
        levels = ["*"] if TABLES[n].race is None else ["A-G", "H,I", "*"]
        out[n] = {f"{r}_{level}": value for r in ("usa", "state") for level in levels}
    return out


def test_domains_roundtrip(spark):
    domains = [Range("a", 0, 10, 5), Splits("b", (0, 1, 4, 8)), Categories("c", ("x", "y"))]
    df = spark.createDataFrame([(0, 0, "x"), (9, 8, "y"), (10, 1, "x"), (3, 4, None)], "a long, b long, c string")
    coded = df.withColumns(code_columns(domains))
    assert [tuple(r) for r in coded.collect()] == [(0, 0, 0), (4, 2, 1), (4, 1, 0), (1, 2, None)]
    index = coded.na.drop().select(cell_index(domains).alias("i"))
    assert [r.i for r in index.collect()] == [0, 29, 26]
    back = index.withColumns(cell_codes(F.col("i"), domains)).select("a", "b", "c")
    assert [tuple(r) for r in back.collect()] == [(0, 0, 0), (4, 2, 1), (4, 1, 0)]
    assert np.ravel_multi_index((4, 2, 1), (5, 3, 2)) == 29


def test_out_of_domain(spark):
    df = spark.createDataFrame([(0, "ab"), (10, "ab"), (5, "abc"), (None, "ab")], "v long, s string")
    domains = [Range("v", 0, 10), Pattern("s", "ab")]
    assert out_of_domain_rows(df, domains, "error").count() == 3
    assert out_of_domain_rows(df, domains, "remove").count() == 1
    assert [r.v for r in out_of_domain_rows(df, domains[:1], "clip").collect()] == [0, 10, 5, None]
    for bad in (lambda: out_of_domain_rows(df, domains, "clip"), lambda: out_of_domain_rows(df, domains, "keep")):
        with pytest.raises(ValueError):
            bad()


def test_dq_values_lists_all(spark):
    df = spark.range(1500).selectExpr("concat('x', cast(id as string)) as v")
    got = quality.dq_values(df, [Pattern("v", r"\d")]).collect()
    assert len(got) == 1500 and {r.n_values for r in got} == {1500} and {r.n_rows for r in got} == {1}
    df = df.selectExpr("substr(v, 2) as v")
    assert quality.dq_values(df.limit(5), [Pattern("v", r"\d+")]).count() == 0


def test_unlisted_values(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "c string, n int")
    known = quality.dq_update_domains(df, ["c"])
    assert {(r.column, r.value) for r in known.collect()} == {("c", "a"), ("c", "b")}
    later = spark.createDataFrame([("b", 1), ("z", 9), ("z", 9), (None, 3)], "c string, n int")
    assert {tuple(r) for r in quality.dq_unlisted_values(later, ["c"], known).collect()} == {("c", "z", 2), ("c", None, 1)}


def test_expected_variances(spark):
    pure = {(r.TABLE, r.DATA_CELL): r.EXPECTED for r in quality.expected_variance_rows(spark, budgets(1), TAUS, "pure").collect()}
    def v(s):
        return 2 * math.exp(-1 / s) / (1 - math.exp(-1 / s)) ** 2
    assert pure[("PH1_num", None)] == pytest.approx(v(10)) and pure[("PH1_denom", None)] == pytest.approx(v(2))
    assert pure[("PH5_num", None)] == pytest.approx(v(10))
    assert pure[("PH8_num", 2)] == pytest.approx(2 * v(10)) and pure[("PH8_num", 3)] == pytest.approx(v(10))
    rho = {(r.TABLE, r.DATA_CELL): r.EXPECTED for r in quality.expected_variance_rows(spark, budgets("0.5"), TAUS, "concentrated").collect()}
    assert rho[("PH7", None)] == 100.0 and rho[("PH8_denom", None)] == 4.0 and rho[("PH8_num", 2)] == 200.0


def test_output_variance_violations(spark):
    rows = [("PH7", "USA", "A", 2, 100.0), ("PH7", "USA", "A", 3, 100.01), ("PH8_num", "USA", "A", 2, 200.00001), ("PH9", "USA", "A", 1, 1.0)]
    df = spark.createDataFrame(rows, "TABLE string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, VARIANCE double")
    bad = quality.dq_output_variance(df, quality.expected_variance_rows(spark, budgets("0.5"), TAUS, "concentrated"))
    assert {(r.TABLE, r.DATA_CELL) for r in bad.collect()} == {("PH7", 3), ("PH9", 1)}


def test_expected_margins(spark):
    cells = [("PH7", "A", 2), ("PH8_num", "A", 2), ("PH8_num", "A", 3), ("PH5_num", "*", 2), ("PH5_denom", "H", 1)]
    df = spark.createDataFrame([(t, "STATE", i, c) for t, i, c in cells], "TABLE string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int")
    b = 10 / 0.5
    wide = round(b * math.log(20 / (1 + math.exp(1 / b))), 1)
    got = {(r.TABLE, r.DATA_CELL): r.EXPECTED_MOE for r in report.error_expected_moe(df, budgets("0.5"), TAUS, "pure").collect()}
    assert got[("PH7", 2)] == wide and got[("PH8_num", 3)] == wide and got[("PH5_num", 2)] == wide
    assert got[("PH8_num", 2)] == round(math.sqrt(2) * wide, 1)
    assert got[("PH5_denom", 1)] == round(4 * math.log(20 / (1 + math.exp(0.25))), 1)


def leaf_rows(spark, rows):
    return spark.createDataFrame(rows, "REGION_ID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT long, VARIANCE double")


def test_posterior_counts(spark):
    leaves = leaf_rows(spark, [("1", "STATE", "A", c, n, 25.0) for c, n in [(2, 5000), (3, -4), (4, 7)]] +
                       [("12", "STATE", "A", c, n, 400.0) for c, n in [(2, -900), (3, 0), (4, 90)]])
    tables = smooth.marginal_cells(leaves, smooth.MARGINS["PH7"])
    out = smooth.posterior_count(tables, smooth.MARGINS["PH7"]).collect()
    assert list(out[0].asDict()) == quality.COUNT_COLUMNS
    by = {(r.GEOID, r.DATA_CELL): r for r in out}
    assert by[("01", 2)].PRED == 5000 and by[("01", 2)].PRED_LO == math.floor(5000 - 1.6448536 * 5)
    for (geo, cell), r in by.items():
        assert 0 <= r.PRED_LO <= r.PRED <= r.PRED_HI
        if cell == 1:
            assert r.PRED == sum(by[(geo, c)].PRED for c in (2, 3, 4))
            assert r.VARIANCE == sum(by[(geo, c)].VARIANCE for c in (2, 3, 4))
    again = smooth.posterior_count(tables.repartition(3), smooth.MARGINS["PH7"]).collect()
    assert sorted(out) == sorted(again)


def test_posterior_two_part(spark):
    keys = ("1", "STATE", "A")
    num = leaf_rows(spark, [(*keys, 2, 600, 25.0), (*keys, 3, 1900, 25.0), ("2", "STATE", "A", 2, -5, 100.0), ("2", "STATE", "A", 3, 3, 100.0)])
    den = leaf_rows(spark, [(*keys, 1, 1000, 9.0), ("2", "STATE", "A", 1, 4, 100.0)])
    for least in (1.0, 2.0):
        out = smooth.posterior_ratio_two_part(smooth.ratio_table(num, den, by_cell=False), least).collect()
        assert list(out[0].asDict()) == quality.TWO_PART_COLUMNS
        by = {(r.GEOID, r.DATA_CELL): r for r in out}
        assert by[("01", 1)].RATIO_PRED == pytest.approx(2.5, rel=0.01)
        assert by[("01", 2)].RATIO_PRED == pytest.approx(0.6, rel=0.02)
        for r in out:
            assert r.RATIO_PRED_LO <= r.RATIO_PRED <= r.RATIO_PRED_HI
            if r.DATA_CELL == 1:
                assert least - 1e-9 <= r.RATIO_PRED_LO and r.RATIO_PRED_HI <= 10 + 1e-9
            assert r.PRED_NUM >= 0 and r.PRED_DENOM >= 1


def test_posterior_one_part(spark):
    num = leaf_rows(spark, [("1", "STATE", "A", 2, 5000, 50.0), ("1", "STATE", "A", 3, -90, 30.0)])
    den = leaf_rows(spark, [("1", "STATE", "A", 2, 2000, 2.0), ("1", "STATE", "A", 3, 1, 2.0)])
    table = smooth.ratio_table(num, den, by_cell=True)
    out = smooth.posterior_ratio_one_part(table).collect()
    assert list(out[0].asDict()) == quality.ONE_PART_COLUMNS
    by = {r.DATA_CELL: r for r in out}
    assert set(by) == {1, 2, 3} and by[2].RATIO_PRED == pytest.approx(2.5, rel=0.01)
    assert all(1 - 1e-9 <= r.RATIO_PRED_LO <= r.RATIO_PRED <= r.RATIO_PRED_HI <= 10 + 1e-9 for r in out)


def test_estimate_checks(spark):
    df = spark.createDataFrame([(5.0, 4.0, 1.0), (0.0, 1.0, 1.0), (2.5, 2.0, 1.0), (50.0, 4.0, 1.0)], "PRED double, COUNT_NOISY double, VARIANCE double")
    bad = {r.PRED: r.REASONS for r in quality.dq_estimates_counts(df).collect()}
    assert bad == {0.0: "not a positive integer", 2.5: "not a positive integer", 50.0: "over 6 deviations from the noisy count"}
    assert not quality.has_columns(df, quality.COUNT_COLUMNS)


def test_trials_and_metrics(spark):
    trials = spark.createDataFrame([("a", 1.0, 0), ("a", 5.0, 1)], "k string, VALUE double, TRIAL int")
    truth = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "k string, TRUE_VALUE double")
    error = F.col("VALUE") - F.col("TRUE_VALUE")
    got = report.error_metric_by_cell(truth, trials, ["k"], {"mse": (error * error, F.avg, None), "max b": (error, F.max, F.col("k") == "b")})
    assert [tuple(r) for r in got.collect()] == [("a", "mse", 5.0)]


def test_trials_of_one_tabulation(spark):
    keys = ["TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"]
    rows = [("PH7", str(i), "STATE", "*", 2, t, 10 + t) for i in range(3) for t in range(4)]
    trials = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in keys[:4]) + ", DATA_CELL int, TRIAL int, COUNT long")
    truth = trials.where("TRIAL = 0 AND REGION_ID <> '2'").drop("TRIAL")
    got = {(r.REGION_ID, r.TRIAL): r.ERROR for r in report.error_trials(trials, truth).collect()}
    assert got == {(str(i), t): t + (10 if i == 2 else 0) for i in range(3) for t in range(4)}
    with pytest.raises(ValueError):
        report.error_trials(truth, truth)


def test_orphans_take_one_exchange_of_keys(spark):
    persons, units, geo = (spark.createDataFrame([(k,) for k in ks], "MAFID long") for ks in ([1, 1, 2, None], [2, 3, None], [3, 4]))
    found = quality.dq_orphan_keys(persons, units, geo, "MAFID")
    assert sorted((r.gap, r.MAFID) for r in found.collect() if r.MAFID is not None) == [
        ("geography without unit", 4), ("persons without unit", 1), ("units without geography", 2),
    ]
    assert sorted(r.gap for r in found.collect() if r.MAFID is None) == ["persons without unit", "units without geography"]
    plan = found.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
