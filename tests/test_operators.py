import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabguard.functions import gaussian, samplers
from tabguard.functions.rowhash import digest_order
from tabguard.operators import aggregates as agg
from tabguard.operators import cleaning, joins, limits, noise
from tabguard.operators.keys import Keys
from tabguard.operators.ranks import exact_percentile, grouped_ranks
from tabguard.plans.budget import Approximate, Pure


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one id, most of them in one group."""
    return spark.range(6000).select(
        F.col("id").alias("e"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("u"),
        F.when(F.col("id") % 5 > 0, "x").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g"),
    )


def brute_groups(rows, n):
    import hashlib

    groups = {}
    for r in rows:
        groups.setdefault(r.u, set()).add(r.g)
    order = lambda g: (hashlib.md5(g.encode()).hexdigest(), g)
    kept = {u: set(sorted(gs, key=order)[:n]) for u, gs in groups.items()}
    return sorted(r.e for r in rows if r.g in kept[r.u])


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_limit_groups_with_hot_pairs(spark, skewed, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = sorted(r.e for r in limits.limit_groups_per_id(skewed, "u", "g", 2).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute_groups(skewed.collect(), 2)


def test_limits_above_planner_threshold(spark, skewed):
    order = digest_order(["e"])
    small = limits.keep_first(skewed, ["u"], 40, order).collect()
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        by_hand = limits.keep_first(skewed.repartition(7), ["u"], 40, order).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert sorted(small) == sorted(by_hand)


def test_limit_is_independent_of_input_order(spark, skewed):
    a = limits.limit_rows_per_id(skewed, "u", 3).collect()
    b = limits.limit_rows_per_id(skewed.repartition(5).orderBy(F.col("e").desc()), "u", 3).collect()
    assert sorted(a) == sorted(b) and max(Counter(r.u for r in a).values()) == 3


def test_window_group_limit_in_plans(spark, skewed):
    other = spark.range(50).select(F.col("id").alias("u"), (F.col("id") * 2).alias("z"))
    joined = joins.join_private(skewed, other, joins.DropExcess(3), joins.DropNonUnique(), ["u"])
    plan = joined._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    physical = joined._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in physical or "Broadcast" in physical


def test_null_safe_joins(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, v long")
    b = spark.createDataFrame([(None, 10), ("x", 20), ("z", 30)], "k string, v long")
    got = joins.join_public(a, b, ["k"])
    assert got.columns == ["k", "v_left", "v_right"]
    assert sorted(map(str, got.collect())) == sorted(map(str, [(None, 1, 10), ("x", 2, 20)])) or {
        tuple(r) for r in got.collect()
    } == {(None, 1, 10), ("x", 2, 20)}
    empty_text = spark.createDataFrame([("", 5)], "k string, w long")
    assert joins.natural_join(a, empty_text, ["k"]).count() == 0
    cut = joins.join_private(a.union(a), b, joins.DropExcess(1), joins.DropNonUnique(), ["k"])
    assert {tuple(r) for r in cut.collect()} == {(None, 1, 10), ("x", 2, 20)}
    assert joins.join_private(a.union(a), b, joins.DropNonUnique(), joins.DropNonUnique(), ["k"]).count() == 0
    with pytest.raises(ValueError):
        joins.natural_join(a.select("v"), b.select("k"))


def test_join_columns_mixed_nullability(spark):
    a = spark.range(3).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    b = spark.createDataFrame([(0, "p"), (None, "q"), (2, "r")], "k long, t string")
    assert {tuple(r) for r in joins.natural_join(a, b).collect()} == {(0, "a", "p"), (2, "a", "r")}


def test_keys(spark):
    k = Keys.of_values(spark, {"a": [1, 2, 1], "b": ["x", None]})
    assert {tuple(r) for r in k.df.collect()} == {(1, "x"), (1, None), (2, "x"), (2, None)}
    assert k.project("a").df.count() == 2
    assert k.equality(Keys(k.df.select("b", "a"))).first()[0] is True
    assert k.equality(k.filter("a = 1")).first()[0] is False
    assert k.equality(k.project("a")).first()[0] is False
    with pytest.raises(ValueError):
        Keys.of_values(spark, {"a": []})
    with pytest.raises(ValueError):
        Keys.of_table(spark.createDataFrame([(1.5,)], "a double"))
    with pytest.raises(ValueError):
        k.times(k.project("a"))
    assert Keys.of_values(spark, {}).columns == []


def test_ranks_and_percentiles(spark):
    rng = random.Random(4)
    rows = [("hot", float(rng.randrange(400))) for _ in range(3000)] + [("cold", 1.0), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for buckets in (2, 7, 64, 200):
        got = {(r.k, r.value): (r.n, r.before, r.total, r.previous) for r in grouped_ranks(df, ["k"], "v", buckets).collect()}
        for key in ("hot", "cold", None):
            values = sorted(v for k, v in rows if k == key)
            counts = Counter(values)
            before, last = 0, None
            for v in sorted(counts):
                assert got[(key, v)] == (counts[v], before, len(values), last)
                before, last = before + counts[v], v
    for q in (0.0, 0.5, 0.9, 1.0):
        out = {r.k: r.p for r in exact_percentile(df, ["k"], "v", q, "p").collect()}
        assert out["hot"] == pytest.approx(np.quantile([v for k, v in rows if k == "hot"], q))
        assert out["cold"] == 1.0 and out[None] == pytest.approx(3 + 2 * q)
    assert exact_percentile(df, [], "v", 0.5, "p").first().p == pytest.approx(np.median([v for _, v in rows]))


def test_samplers_match_their_variance():
    rng = samplers.KeyedDraws(samplers.secret_key(1), "row")
    for scale in (samplers.Fraction(3, 2), samplers.Fraction(7)):
        draws = [samplers.discrete_laplace(scale, rng) for _ in range(20000)]
        r = math.exp(-1 / scale)
        assert np.var(draws) == pytest.approx(2 * r / (1 - r) ** 2, rel=0.08)
        assert abs(np.mean(draws)) < 0.2 * float(scale)
    for variance in (samplers.Fraction(1, 2), samplers.Fraction(25, 2)):
        draws = [samplers.discrete_gaussian(variance, rng) for _ in range(8000)]
        assert np.var(draws) == pytest.approx(float(variance), rel=0.1)


def test_noise_columns_in_spark(spark):
    df = spark.range(4000).select("id", F.lit(100).cast("long").alias("n"))
    for mechanism, num, den, variance in [
        ("geometric", 4, 1, 31.83), ("discrete_gaussian", 9, 1, 9.0), ("laplace", 2, 1, 8.0), ("gaussian", 9, 1, 9.0),
    ]:
        out = df.select(samplers.add_noise(F.col("n"), mechanism, F.lit(num), F.lit(den), ["id"], key=samplers.secret_key(3)).alias("x"))
        got = out.agg(F.avg("x"), F.var_pop("x")).first()
        assert got[0] == pytest.approx(100, abs=0.5)
        assert got[1] == pytest.approx(variance, rel=0.15)
    zero = df.limit(3).select(samplers.add_noise(F.col("n"), "geometric", F.lit(0), F.lit(1), ["id"]).alias("x"))
    assert {r.x for r in zero.collect()} == {100}


def test_a_second_evaluation_draws_the_same_noise(spark):
    df = spark.range(300).select("id", (F.col("id") % 3 == 0).alias("b"), F.lit(5).cast("long").alias("n"))
    drawn = df.select("id", samplers.add_noise(F.col("n"), "geometric", F.lit(9), F.lit(1), ["id", "b"]).alias("x"))
    first = {r.id: r.x for r in drawn.collect()}
    assert first == {r.id: r.x for r in drawn.collect()}
    column = samplers.add_noise(F.col("n"), "geometric", F.lit(9), F.lit(1), ["id", "b"])
    one = {r.id: r.x for r in df.select("id", column.alias("x")).collect()}
    other = {r.id: r.x for r in df.repartition(5).orderBy(F.desc("id")).select("id", column.alias("x")).collect()}
    assert one == other and one != first  # a new call has a new key
    assert len(set(first.values())) > 10


def test_answers_do_not_rest_on_a_checkpoint(spark):
    df = spark.createDataFrame([(i % 5, float(i)) for i in range(200)], "g long, v double")
    keys = Keys.of_values(spark, {"g": [0, 1, 2, None]})
    measure = agg.agg_average(df, keys, "v", 0.0, 200.0, "mean")
    answer = noise.release(measure, Pure(1), noise.Bound.of_rows(1))
    assert sorted(answer.collect(), key=str) == sorted(answer.collect(), key=str)
    middle = agg.agg_quantile(df, keys, "v", 0.5, 0.0, 200.0, epsilon=1.0)
    assert sorted(middle.collect(), key=str) == sorted(middle.repartition(4).collect(), key=str)
    named = noise.select_groups_private(df, ["g"], Approximate(1, "0.01"))
    assert sorted(named.collect()) == sorted(named.collect())


def test_keyed_bits_are_uniform_and_apart():
    draws = samplers.KeyedDraws(b"k" * 32, "a")
    values = [draws.randrange(6) for _ in range(60000)]
    assert np.abs(np.bincount(values) / 10000 - 1).max() < 0.05
    assert draws.randrange(1) == 0 and all(draws.randrange(3) < 3 for _ in range(100))
    bits = [samplers.KeyedDraws(b"k" * 32, f"row {i}").bits(64) for i in range(4000)]
    share = np.unpackbits(np.array(bits, np.uint64).view(np.uint8)).reshape(4000, 64).mean(axis=0)
    assert len(set(bits)) == 4000 and np.abs(share - 0.5).max() < 0.05
    assert samplers.KeyedDraws(b"k" * 32, "a").bits(600) != samplers.KeyedDraws(b"l" * 32, "a").bits(600)
    again = samplers.KeyedDraws(b"k" * 32, "a")
    whole, parts = samplers.KeyedDraws(b"k" * 32, "a").bits(1100), [again.bits(500), again.bits(600)]
    assert whole == parts[0] | parts[1] << 500


def test_row_texts_tell_rows_apart(spark):
    rows = [("a", "b", None), ("a\",\"c1\":\"b", None, None), ("a", None, "b"), ("ab", "", None), ("a", "b", ""), (None, "b", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    texts = [r[0] for r in df.select(samplers.row_text("n", ["x", "y", "z"])).collect()]
    assert len(set(texts)) == len(rows)
    assert df.select(samplers.row_text("n", [])).first()[0] == "n"


def test_geometric_interval_is_the_inverse(spark):
    for s in (0.4, 1.0, 6.5):
        r = math.exp(-1 / s)
        def cdf(k):
            return 1 - r ** (k + 1) / (1 + r) if k >= 0 else r ** (-k) / (1 + r)
        for p in (0.01, 0.3, 0.5, 0.8, 0.95, 0.999):
            got = spark.range(1).select(noise.noise_interval("geometric", F.lit(s), p)).first()[0]
            assert cdf(got) >= p - 1e-12 and cdf(got - 1) < p + 1e-12


def test_selection_threshold():
    for eps, delta, rows in [(1, 0.01, 1), (2, 1e-6, 1), (1, 1e-3, 4)]:
        e, d = samplers.Fraction(eps), samplers.Fraction(str(delta))
        tau = noise.selection_threshold(e, d, rows)
        r = math.exp(-eps / rows)
        assert rows * r ** (tau - rows) / (1 + r) <= delta * (1 + 1e-9)


def test_truncated_normal_functions():
    rng = np.random.default_rng(1)
    for mean, sd in [(5.0, 2.0), (-3.0, 1.0), (-80.0, 2.0)]:
        n = 4000
        draws = gaussian.truncated_draws(rng, mean, sd, np.zeros(n), np.full(n, np.inf))
        assert draws.min() >= 0
        exact = mean + sd * gaussian.hazard(np.array([-mean / sd]))[0]
        assert draws.mean() == pytest.approx(exact, rel=0.08)
        q = gaussian.truncated_quantile(np.array([0.05, 0.95]), np.full(2, mean), np.full(2, sd), 0.0)
        assert q == pytest.approx(np.quantile(draws, [0.05, 0.95]), rel=0.12, abs=0.02)
    assert gaussian.sum_quantiles([7.0], [3.0], [0.05, 0.95]) == pytest.approx(
        gaussian.truncated_quantile(np.array([0.05, 0.95]), 7.0, 3.0, 0.0), abs=1e-4
    )
    total = sum(gaussian.truncated_draws(rng, m, s, np.zeros(200_000), np.full(200_000, np.inf)) for m, s in [(100, 5), (-9, 2), (3, 7)])
    assert gaussian.sum_quantiles([100, -9, 3], [5, 2, 7], [0.05, 0.5, 0.95]) == pytest.approx(np.quantile(total, [0.05, 0.5, 0.95]), abs=0.1)
    assert list(gaussian.sum_quantiles([4, -2], [0, 0], [0.05])) == [4.0]
    a = np.linspace(-8, 30, 400)
    assert gaussian.fast_upper_tail(a) == pytest.approx(gaussian.upper_tail(a), rel=2e-7)
    inside = gaussian.truncated_draws(rng, 0.0, 1.0, np.full(500, -60.0), np.full(500, -50.0))
    assert inside.min() >= -60 and inside.max() <= -50


def test_cleaning_errors(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "i int, f float, s string")
    assert [t for _, t in cleaning.coerce_types(df).dtypes] == ["bigint", "double", "string"]
    for bad in (lambda: cleaning.rename_columns(df, {"x": "y"}), lambda: cleaning.rename_columns(df, {"i": "s"}),
                lambda: cleaning.select_columns(df, ["i", "i"]), lambda: cleaning.replace_infinity(df, {"s": (0, 1)}),
                lambda: cleaning.map_augment(df, {"s": F.lit(1)}), lambda: cleaning.recode_columns(df, "T", ["nonsense"]),
                lambda: cleaning.coerce_types(spark.range(1).select(F.array("id").alias("a")))):
        with pytest.raises(ValueError):
            bad()
