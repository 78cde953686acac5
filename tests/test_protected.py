import math
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tabguard.functions.binning import Bins
from tabguard.operators import aggregates
from tabguard.operators.joins import DropExcess, DropNonUnique
from tabguard.operators.keys import Keys
from tabguard.operators.noise import Bound
from tabguard.plans.budget import Approximate, Concentrated, Ledger, Pure, exact
from tabguard.plans.protected import (
    Account,
    Grouped,
    MaxRows,
    MaxRowsInMaxGroups,
    Protected,
    RowsWithId,
    group_values,
    join_bound,
    max_groups_per_id,
    max_rows_per_group_per_id,
    max_rows_per_id,
)

INF = math.inf


@pytest.fixture(scope="module")
def ids(spark):
    rows = [
        (1, "A", "X", 5, 1.0), (1, "A", "Y", 7, 2.5), (1, "B", "X", 9, 3.0),
        (2, "A", "X", 1, 0.5), (2, "B", "Y", 3, 9.5), (3, "B", "Y", 20, -4.0),
    ]
    return spark.createDataFrame(rows, "id long, g string, g2 string, n long, f double")


def with_id(ids):
    return Protected.load(ids, RowsWithId("id"))


def total(spark):
    return Keys.of_values(spark, {})


def groups(spark):
    return Keys.of_values(spark, {"g": ["A", "B"]})


def test_noise_scales_pure(spark, ids):
    t = with_id(ids)
    for n, low, high, scales in [(1, 0, 10, [10, 2]), (5, 0, 10, [50, 10]), (1, 0, 20, [20, 2]), (5, 0, 20, [100, 10])]:
        q = t.enforce(max_rows_per_id(n)).groupby(total(spark))
        assert [x.parameter for x in q.average("n", low, high).noise(Pure(1))] == scales
        assert [x.parameter for x in q.count().noise(Pure(1))] == [n]


def test_noise_scales_concentrated(spark, ids):
    t = with_id(ids)
    for n, expected in [(1, Fraction(1, 2)), (2, 2), (5, Fraction(25, 2))]:
        q = t.enforce(max_rows_per_id(n)).groupby(total(spark)).count()
        assert [x.parameter for x in q.noise(Concentrated(1))] == [expected]
    q = t.enforce(max_rows_per_id(5)).groupby(total(spark))
    assert [x.parameter for x in q.average("f", 0, 20).noise(Concentrated(1))] == [2500, 25]
    both = t.enforce(max_groups_per_id("g", 2)).enforce(max_rows_per_group_per_id("g", 3))
    grouped = both.groupby(groups(spark)).average("n", 0, 10)
    assert [x.parameter for x in grouped.noise(Concentrated(1))] == [450, 18]
    assert grouped.bound_for(Pure(1)).squared == 36
    ungrouped = both.groupby(total(spark)).average("n", 0, 10)
    assert [x.parameter for x in ungrouped.noise(Concentrated(1))] == [900, 36]


def test_integer_midpoint(spark):
    df = spark.createDataFrame([("0", 1)], "a string, x long")
    q = Protected.load(df, MaxRows(1)).groupby(total(spark)).average("x", -111, 234)
    assert [x.parameter for x in q.noise(Concentrated(11))] == [Fraction(173**2, 11), Fraction(1, 11)]
    assert [x.mechanism for x in q.noise(Concentrated(11))] == ["discrete_gaussian"] * 2


def test_mechanism_rules(spark, ids):
    g = Protected.load(ids, MaxRows(1)).groupby(total(spark))
    assert [x.mechanism for x in g.sum("f", 0, 1).noise(Pure(1))] == ["laplace"]
    assert [x.mechanism for x in g.sum("f", 0, 1).noise(Concentrated(1))] == ["gaussian"]
    assert [x.mechanism for x in g.sum("n", 0, 1).noise(Approximate(1, 0))] == ["geometric"]
    for budget in (Pure(1), Approximate(1, "0.1")):
        with pytest.raises(ValueError):
            g.count(mechanism="gaussian").noise(budget)
    assert g.count().noise(Approximate(2, "0.1"))[0].parameter == Fraction(1, 2)


def test_join_bounds():
    three = 3
    cases = [
        (DropExcess(3), DropExcess(3), 36), (DropExcess(3), DropExcess(1), 24),
        (DropNonUnique(), DropExcess(3), 3 * 3 + 2 * 3), (DropExcess(1), DropExcess(1), 12),
        (DropNonUnique(), DropNonUnique(), 6),
    ]
    for left, right, expected in cases:
        assert join_bound(three, three, left, right) == expected
    # Persons cut to tau, units unique and changing in pairs: 2 * tau + 2.
    for tau in (1, 4, 9):
        assert join_bound(1, 2, DropExcess(tau), DropNonUnique()) == 2 * tau + 2


def test_count_average_with_limits(spark, ids):
    t = with_id(ids).enforce(max_rows_per_id(1))
    out = Account(Pure(INF))
    out.private["t"] = t
    n = out.evaluate(t.groupby(total(spark)).count(), Pure(INF)).collect()
    assert n[0][0] == 3
    by_id = {1: [5, 7, 9], 2: [1, 3], 3: [20]}
    legal = {(min(a, 10) + min(b, 10) + min(c, 10)) / 3 for a in by_id[1] for b in by_id[2] for c in by_id[3]}
    mean = out.evaluate(t.groupby(total(spark)).average("n", 0, 10), Pure(INF)).collect()[0][0]
    assert any(mean == pytest.approx(x) for x in legal)


def test_exact_aggregates_and_empty_groups(spark, ids):
    t = Protected.load(ids, MaxRows(1)).groupby(Keys.of_values(spark, {"g": ["A", "B", "none"]}))
    def answer(q):
        return {r["g"]: r[1] for r in q.measure.exact().collect()}
    assert answer(t.count()) == {"A": 3, "B": 3, "none": 0}
    assert answer(t.sum("n", 0, 10)) == {"A": 13, "B": 22, "none": 0}
    assert answer(t.average("n", 0, 10))["none"] == 5.0
    assert answer(t.variance("n", 0, 10)) == {
        "A": pytest.approx(statistics.pvariance([5, 7, 1])), "B": pytest.approx(statistics.pvariance([9, 3, 10])), "none": 25.0,
    }
    assert answer(t.stdev("f", 0.0, 10.0))["none"] == 5.0
    single = Keys.of_values(spark, {"id": [3]})
    assert Protected.load(ids, MaxRows(1)).groupby(single).variance("n", 0, 10).measure.exact().first()[1] == 25.0
    assert answer(t.count_distinct(["g2"])) == {"A": 2, "B": 2, "none": 0}
    assert t.count_distinct(["id", "g2"]).measure.frame.columns == ["g", "count_distinct(id, g2)"]


def test_nulls_nan_infinity_in_measures(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", INF), ("a", -INF), ("a", 3.0)], "k string, v double")
    t = Protected.load(df, MaxRows(1)).groupby(Keys.of_values(spark, {"k": ["a"]}))
    assert t.sum("v", 0.0, 10.0).measure.exact().first()[1] == 13.0
    assert t.average("v", 0.0, 10.0).measure.exact().first()[1] == pytest.approx(13 / 3)


def test_count_distinct_nulls_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, None), ("a", 2), ("a", None)], "k string, v long")
    keys = Keys.of_table(df.select("k"))
    got = {r["k"]: r["n"] for r in Protected.load(df, MaxRows(1)).groupby(keys).count_distinct(["v"], "n").measure.exact().collect()}
    assert got == {None: 2, "a": 2}


def test_quantiles_fall_between_neighbours(spark, ids):
    t = Protected.load(ids, MaxRows(1)).groupby(total(spark))
    account = Account(Pure(INF))
    account.private["t"] = t.table
    values = sorted([5, 7, 9, 1, 3, 20])
    for q, low, high in [(0.5, values[2], values[3]), (0.0, 0, values[0]), (1.0, values[-1], 30)]:
        got = account.evaluate(t.quantile("n", q, 0, 30), Pure(INF)).first()[0]
        assert low <= got <= high
    noisy = Account(Pure(2))
    noisy.private["t"] = t.table
    value = noisy.evaluate(t.median("n", 0, 30), Pure(2)).first()[0]
    assert 0 <= value <= 30 and noisy.remaining == Pure(0)


def test_limits_follow_operators(spark, ids):
    t = with_id(ids).enforce(max_rows_per_id(4)).enforce(max_groups_per_id("g", 2)).enforce(max_rows_per_group_per_id("g", 3))
    kinds = lambda x: {(limit.kind, limit.column, limit.n) for limit in x.limits}
    assert kinds(t.filter("n > 1")) == kinds(t)
    assert kinds(t.rename({"g": "h"})) == {("rows", None, 4), ("groups", "h", 2), ("rows_in_group", "h", 3)}
    assert kinds(t.select(["id", "n"])) == {("rows", None, 4)}
    assert kinds(t.replace_null_nan({"g": "x"})) == {("rows", None, 4), ("groups", "g", 2)}
    flat = t.flat_map(F.array(F.lit(1), F.lit(2)), 2, "c")
    assert kinds(flat) == {("groups", "g", 2)}
    public = spark.createDataFrame([("X", 1), ("X", 2), ("Y", 3)], "g2 string, z long")
    assert kinds(t.join_public(public)) == {("rows", None, 8), ("groups", "g", 2), ("rows_in_group", "g", 6)}
    other = with_id(ids.select("id", "g", F.col("n").alias("m"))).enforce(max_rows_per_id(2))
    joined = t.join_private(other, on=["id"])
    assert kinds(joined) == {("rows", None, 8), ("groups", "g_left", 2), ("rows_in_group", "g_left", 6)}
    with pytest.raises(ValueError):
        flat.groupby(groups(spark)).count()
    with pytest.raises(ValueError):
        t.select(["n"])
    with pytest.raises(ValueError):
        t.replace_null_nan({"id": 0})
    with pytest.raises(ValueError):
        t.join_private(other, on=["g"])


def test_grouping_column(spark, ids):
    t = Protected.load(ids, MaxRowsInMaxGroups("g", 2, 3))
    assert t.groupby(groups(spark)).count().bound_for(Concentrated(1)) == Bound(Fraction(6), Fraction(18))
    with pytest.raises(ValueError):
        t.groupby(total(spark)).count()
    flat = Protected.load(ids.select("n"), MaxRows(2)).flat_map(F.array(F.lit("A"), F.lit("B"), F.lit("C")), 2, "w", grouping=True)
    assert flat.change == MaxRowsInMaxGroups("w", 4, 1)
    assert flat.df.filter("w = 'C'").count() == 0


def test_budget_ledger():
    ledger = Ledger(Pure(1))
    ledger.spend(Pure("0.4"))
    assert ledger.left == Pure("0.6")
    with pytest.raises(ValueError):
        ledger.spend(Pure("0.61"))
    assert ledger.spend(Pure(exact("0.6") * (1 + Fraction(1, 10**10)))) == Pure("0.6")
    with pytest.raises(ValueError):
        ledger.spend(Pure(0))
    with pytest.raises(ValueError):
        ledger.spend(Concentrated(1))
    both = Ledger(Approximate(1, "0.1"))
    both.spend(Approximate("0.5", 0))
    assert both.left == Approximate("0.5", "0.1")
    assert Ledger(Pure(INF)).spend(Pure(5)) == Pure(5)


def test_answers_are_drawn_once(spark, ids):
    account = Account(Pure(1))
    t = account.add_private("ids", ids, MaxRows(1))
    out = account.evaluate(t.groupby(groups(spark)).count(), Pure(1))
    first = sorted(map(tuple, out.collect()))
    assert first == sorted(map(tuple, out.collect()))
    with pytest.raises(ValueError):
        account.evaluate(t.groupby(groups(spark)).count(), Pure("0.1"))


def test_parts_share_one_budget(spark, ids):
    account = Account(Pure(3))
    t = account.add_private("ids", ids, MaxRows(1))
    parts = account.partition(t, "g", {"a": "A", "b": "B"}, Pure(1))
    assert account.remaining == Pure(2) and set(parts) == {"a", "b"}
    for name, child in parts.items():
        child.evaluate(child.private[name].groupby(total(spark)).count(), Pure(1))
        assert child.remaining == Pure(0)


def test_parts_of_identifier_tables_stay_within_the_budget(spark, ids):
    account = Account(Pure(6))
    t = account.add_private("ids", ids, RowsWithId("id"))
    with pytest.raises(ValueError):
        account.partition(t, "g", {"a": "A", "b": "B", "c": "C"}, Pure(1))
    assert account.remaining == Pure(6)
    bounded = t.enforce(max_groups_per_id("g", 2))
    parts = account.partition(bounded, "g", {"a": "A", "b": "B", "c": "C"}, Pure(1))
    assert account.remaining == Pure(5)
    # an identifier lies in two parts at most
    assert all(2 * child.remaining.epsilon == 1 for child in parts.values())


def test_split_answers_as_parts_do(spark, ids):
    splits = {"a": "A", "b": "B", "c": "nothing"}
    single, joint = Account(Pure(float("inf"))), Account(Pure(float("inf")))
    t = single.add_private("ids", ids, RowsWithId("id")).enforce(max_groups_per_id("g", 2))
    alone = single.partition(t, "g", splits, Pure(float("inf")))
    joint.add_private("ids", ids, RowsWithId("id"))
    parts = joint.split(t, "g", splits, Pure(float("inf")))
    for limits_ in ([max_rows_per_id(1)], [max_rows_per_group_per_id("g2", 1), max_groups_per_id("g2", 1)]):
        bounded = parts
        for limit in limits_:
            bounded = bounded.enforce(limit)
        for build in (lambda g: g.count("m"), lambda g: g.sum("n", 0, 50, "m"), lambda g: g.average("n", 0, 50, "m")):
            got = {r.part: r.m for r in bounded.evaluate(total(spark), build, Pure(float("inf"))).collect()}
            want = {}
            for name, child in alone.items():
                table = child.private[name]
                for limit in limits_:
                    table = table.enforce(limit)
                want[name] = child.evaluate(build(table.groupby(total(spark))), Pure(float("inf"))).first().m
            assert got == want
        middle = bounded.evaluate(total(spark), lambda g: g.median("n", 0, 50, "m"), {"a": Pure(float("inf"))}).collect()
        assert [r.part for r in middle] == ["a"] and 0 <= middle[0].m <= 50


def test_split_spends_per_part(spark, ids):
    account = Account(Pure(3))
    t = account.add_private("ids", ids, MaxRows(1))
    parts = account.split(t, "g", {"a": "A", "it's": "B"}, Pure(2))
    assert account.remaining == Pure(1)
    answer = parts.evaluate(total(spark), lambda g: g.count("m"), {"a": Pure(1), "it's": Pure(2)})
    assert sorted(r.part for r in answer.collect()) == ["a", "it's"]
    assert (parts.ledgers["a"].left, parts.ledgers["it's"].left) == (Pure(1), Pure(0))
    with pytest.raises(ValueError):  # one part cannot pay, so none does
        parts.evaluate(total(spark), lambda g: g.count("m"), Pure(1))
    assert parts.ledgers["a"].left == Pure(1)
    only = parts.apply(lambda p: p.filter("n > 0")).evaluate(groups(spark), lambda g: g.sum("n", 0, 9, "m"), {"a": Pure(1)})
    assert {r.part for r in only.collect()} == {"a"}
    for wrong in (
        lambda: parts.evaluate(total(spark), lambda g: g.count("m"), {"z": Pure(1)}), lambda: parts.evaluate(total(spark), lambda g: g.count("m"), {}),
        lambda: parts.enforce(max_rows_per_id(1)), lambda: parts.apply(lambda p: p.select(["n"])), lambda: account.split(parts.table, "g", {"a": "A"}, Pure(1)),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_noise_of_parts_follows_their_budgets(spark):
    df = spark.range(4000).select((F.floor(F.col("id") / 1000) % 2).alias("g"), (F.col("id") % 1000).alias("k"))
    keys = Keys.of_table(df.select("k"))
    account = Account(Pure(2))
    parts = account.split(account.add_private("t", df, MaxRows(1)), "g", {"wide": 0, "narrow": 1}, Pure(2))
    out = parts.evaluate(keys, lambda g: g.count("n"), {"wide": Pure("0.5"), "narrow": Pure(2)})
    spread = {r.part: r.v for r in out.groupBy("part").agg(F.var_pop("n").alias("v")).collect()}
    assert spread["wide"] > 5 * spread["narrow"]


def test_products_of_value_lists_are_ranges(spark):
    lists = {f"k{i}": list(range(100)) for i in range(4)}
    keys = Keys.of_values(spark, {"k0": lists["k0"], "k1": lists["k1"]}).times(Keys.of_values(spark, {"k2": lists["k2"], "k3": lists["k3"]}))
    df = spark.createDataFrame([(1, 2, 3, 4), (1, 2, 3, 4), (99, 0, 0, 99), (100, 0, 0, 0)], "k0 long, k1 long, k2 long, k3 long")
    answer = aggregates.agg_count(df, keys, "n").exact()
    assert answer.where("n > 0").count() == 2
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert answer.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()[:] == (10**8, 3, 2)
    mixed = Keys.of_values(spark, {"a": ["x", "y", None], "b": [1]})
    assert {tuple(r) for r in mixed.df.collect()} == {("x", 1), ("y", 1), (None, 1)}
    table = Keys.of_table(spark.createDataFrame([(1,), (2,)], "t long")).times(mixed)
    assert table.columns == ["t", "a", "b"] and table.df.count() == 6 and "NestedLoop" not in table.df._jdf.queryExecution().executedPlan().toString()
    assert mixed.times(Keys.of_table(spark.createDataFrame([(1,)], "t long"))).columns == ["a", "b", "t"]


def test_wide_integers_do_not_overflow(spark):
    df = spark.createDataFrame([("A", v) for v in [0, 2_000_000_000] * 20], "g string, x long")
    found = aggregates.agg_variance(df, groups(spark), "x", 0, 2_000_000_000).exact()
    assert {r.g: r.x_variance for r in found.collect()}["A"] == 1e18


def test_bin_labels():
    import datetime as dt

    from tabguard.functions.binning import edge_labels

    assert edge_labels([0.0, 0.5, 1.0]) == ["0.00", "0.50", "1.00"]
    assert edge_labels([0.0, 0.0001]) == ["0.0000", "0.0001"]
    assert edge_labels([1, 20]) == ["1", "20"] and edge_labels(["a", "b"]) == ["'a'", "'b'"]
    day = dt.datetime(2020, 1, 2)
    assert edge_labels([day, day + dt.timedelta(hours=1)]) == ["2020-01-02 00:00", "2020-01-02 01:00"]
    assert edge_labels([day, day + dt.timedelta(milliseconds=5)])[1] == "2020-01-02 00:00:00.005"


def test_group_values(spark):
    df = spark.createDataFrame([("common",)] * 400 + [("rare",)], "k string")
    t = Protected.load(df, MaxRows(1))
    account = Account(Approximate(INF, 1))
    account.private["t"] = t
    assert account.evaluate(group_values(t), Approximate(INF, 0)).count() == 2
    noisy = Account(Approximate(1, "0.000001"))
    noisy.private["t"] = t
    assert [r[0] for r in noisy.evaluate(group_values(t), Approximate(1, "0.000001")).collect()] == ["common"]
    with pytest.raises(ValueError):
        group_values(Protected.load(df.withColumn("id", F.lit(1)), RowsWithId("id")).enforce(max_rows_per_id(1)), ["id"])


def test_histogram_and_bins(spark):
    spec = Bins((0, 5, 10))
    assert spec.bins() == ["[0, 5]", "(5, 10]"]
    df = spark.createDataFrame([(0,), (5,), (6,), (10,), (11,), (None,)], "v long")
    got = [r[0] for r in df.select(spec.column(F.col("v"))).collect()]
    assert got == ["[0, 5]", "[0, 5]", "(5, 10]", "(5, 10]", None, None]
    left = Bins((0.0, 1.5, 3.0), right=False, nan_name="nan")
    assert left.bins() == ["[0.00, 1.50)", "[1.50, 3.00]", "nan"]
    floats = spark.createDataFrame([(0.0,), (1.5,), (3.0,), (float("nan"),), (-0.1,), (3.1,)], "v double")
    got = [r[0] for r in floats.select(left.column(F.col("v"), True)).collect()]
    assert got == ["[0.00, 1.50)", "[1.50, 3.00]", "[1.50, 3.00]", "nan", None, None]
    t = Protected.load(df, MaxRows(1)).groupby(total(spark)).histogram("v", spec)
    assert {r[0]: r[1] for r in t.measure.exact().collect()} == {"[0, 5]": 2, "(5, 10]": 2}
    for bad in ((1,), (1, 1), (2, 1), (1, "a")):
        with pytest.raises(ValueError):
            Bins(bad)


def test_grouped_is_plain(spark, ids):
    assert isinstance(with_id(ids).groupby(groups(spark)), Grouped)
