"""Aggregates over key sets, exact and noisy, and columns that describe noise."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabguard.demos.join_queries import named_beside_counts
from tabguard.demos.registry import derived, oracle_text, query, table
from tabguard.functions.binning import Bins
from tabguard.functions.samplers import add_noise
from tabguard.operators import aggregates as agg
from tabguard.operators.keys import Keys
from tabguard.operators.noise import Noise, noise_columns, noise_interval, noise_variance
from tabguard.plans.budget import Approximate, Concentrated, Pure
from tabguard.plans.protected import (
    Account,
    MaxRows,
    MaxRowsInMaxGroups,
    RowsWithId,
    max_groups_per_id,
    max_rows_per_id,
    label_parts,
)
from tabguard.runtime import materialise

INF = float("inf")

EVENTS = """SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS STRING) ELSE event_type END AS event_type,
  CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 7 = 1 THEN CAST('NaN' AS DOUBLE)
       WHEN event_id % 7 = 2 THEN CAST('Infinity' AS DOUBLE) ELSE value END AS v,
  event_id % 300 AS m FROM {events}"""
E = f"""WITH e AS ({oracle_text(EVENTS)}),
k AS (SELECT unnest(['click', 'error', 'signup', 'nothing']) AS event_type),
f AS (SELECT event_type, CASE WHEN isinf(v) OR v > 200 THEN 200.0::DOUBLE WHEN v < 1 THEN 1.0::DOUBLE ELSE v END AS v
      FROM e WHERE v IS NOT NULL AND NOT isnan(v))"""


def events(spark, folder):
    return derived(spark, folder, EVENTS)


def keys(spark):
    return Keys.of_values(spark, {"event_type": ["click", "error", "signup", "nothing"]})


def rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


@query(
    "agg_count",
    E
    + " SELECT k.event_type, count(e.event_id) AS n FROM k LEFT JOIN e ON k.event_type = e.event_type GROUP BY 1",
)
def agg_count(spark, folder):
    return agg.agg_count(events(spark, folder), keys(spark), "n").exact()


@query("agg_count_total", "SELECT count(*) AS n FROM lineitem")
def agg_count_total(spark, folder):
    return agg.agg_count(table(spark, folder, "lineitem"), Keys.of_values(spark, {}), "n").exact()


@query(
    "agg_count_distinct",
    E
    + """ SELECT k.event_type, (SELECT count(*) FROM (SELECT DISTINCT user_id % 50, e.event_type, m % 7 = 0 FROM e
          WHERE e.event_type = k.event_type)) AS n FROM k""",
)
def agg_count_distinct(spark, folder):
    df = events(spark, folder).withColumns({"u": F.col("user_id") % 50, "z": F.col("m") % 7 == 0})
    return agg.agg_count_distinct(df, keys(spark), ["u", "z"], "n").exact()


@query(
    "agg_count_distinct_ids",
    E
    + """ SELECT k.event_type, count(DISTINCT user_id) AS n FROM k LEFT JOIN e ON k.event_type = e.event_type GROUP BY 1""",
)
def agg_count_distinct_ids(spark, folder):
    return agg.agg_count_distinct_ids(events(spark, folder), keys(spark), "user_id", "n").exact()


@query(
    "agg_sum",
    E
    + """ SELECT k.event_type, round(coalesce(sum(v), 0), 4) AS v_sum,
          (SELECT CAST(coalesce(sum(least(greatest(m, 10), 250)), 0) AS BIGINT) FROM e WHERE e.event_type = k.event_type) AS m_sum
          FROM k LEFT JOIN f ON k.event_type = f.event_type GROUP BY 1""",
)
def agg_sum(spark, folder):
    df, ks = events(spark, folder), keys(spark)
    decimal = rounded(agg.agg_sum(df, ks, "v", 1.0, 200.0).exact(), "v_sum", places=4)
    return decimal.join(agg.agg_sum(df, ks, "m", 10, 250).exact(), "event_type")


@query(
    "agg_average",
    E
    + """ SELECT k.event_type, round(coalesce(avg(v), 100.5), 6) AS v_average
          FROM k LEFT JOIN f ON k.event_type = f.event_type GROUP BY 1""",
)
def agg_average(spark, folder):
    return rounded(agg.agg_average(events(spark, folder), keys(spark), "v", 1.0, 200.0).exact(), "v_average")


_SPREAD = "CASE WHEN count(v) <= 1 THEN 9900.25 ELSE var_pop(v) END"


@query(
    "agg_variance",
    E
    + f""" SELECT k.event_type, round({_SPREAD}, 4) AS v_variance
          FROM k LEFT JOIN f ON k.event_type = f.event_type GROUP BY 1""",
)
def agg_variance(spark, folder):
    out = agg.agg_variance(events(spark, folder), keys(spark), "v", 1.0, 200.0).exact()
    return rounded(out, "v_variance", places=4)


@query(
    "agg_stdev",
    E
    + f""" SELECT k.event_type, round(sqrt({_SPREAD}), 6) AS v_stdev
          FROM k LEFT JOIN f ON k.event_type = f.event_type GROUP BY 1""",
)
def agg_stdev(spark, folder):
    out = agg.agg_stdev(events(spark, folder), keys(spark), "v", 1.0, 200.0).exact()
    return rounded(out, "v_stdev")


def _quantile(name, function, q):
    """Noisy and best quantile, told by what chance cannot change: the range, and how far the rank of the best is off.

    Several intervals may be equally good, so the rank's distance to the wanted one is compared, not the value.
    """

    @query(
        name,
        E
        + f""", r AS (SELECT event_type, v, row_number() OVER (PARTITION BY event_type ORDER BY v) AS i,
               count(*) OVER (PARTITION BY event_type) AS n FROM f),
p AS (SELECT event_type, v AS hi, lag(v, 1, 1.0) OVER (PARTITION BY event_type ORDER BY v) AS lo, min(i) - 1 AS rank, min(n) AS n
      FROM r GROUP BY event_type, v
      UNION ALL SELECT event_type, 200.0, max(v), max(n), max(n) FROM r GROUP BY event_type)
SELECT k.event_type, true AS noisy_in_range, coalesce(min(abs(rank - {q} * n)), 0.0)::DOUBLE AS best_off
FROM k LEFT JOIN (SELECT * FROM p WHERE hi > lo) p ON k.event_type = p.event_type GROUP BY 1""",
    )
    def run(spark, folder):
        df, ks = events(spark, folder), keys(spark)
        extra = {"q": q} if function is agg.agg_quantile else {}
        noisy = function(df, ks, "v", low=1.0, high=200.0, epsilon=1.0, name="noisy", **extra)
        best = function(df, ks, "v", low=1.0, high=200.0, name="best", **extra)
        both = materialise(noisy.join(best, "event_type"))
        values = df.filter("v IS NOT NULL AND NOT isnan(v)").select("event_type", F.greatest(F.least("v", F.lit(200.0)), F.lit(1.0)).alias("v"))
        rows = both.join(values, "event_type", "left").groupBy("event_type", "noisy", "best")
        counted = rows.agg(F.count("v").alias("n"), F.count_if(F.col("v") <= F.col("best")).alias("rank"))
        return counted.select(
            "event_type",
            F.col("noisy").between(1.0, 200.0).alias("noisy_in_range"),
            F.abs(F.col("rank") - F.lit(float(q)) * F.col("n")).alias("best_off"),
        )

    return run


_quantile("agg_quantile", agg.agg_quantile, 0.25)
_quantile("agg_min", agg.agg_min, 0.0)
_quantile("agg_max", agg.agg_max, 1.0)
_quantile("agg_median", agg.agg_median, 0.5)


@query(
    "agg_quantile_gap",
    E
    + """, r AS (SELECT event_type, v, row_number() OVER (PARTITION BY event_type ORDER BY v) AS i,
               count(*) OVER (PARTITION BY event_type) AS n FROM f),
p AS (SELECT event_type, v AS hi, lag(v, 1, 1.0) OVER (PARTITION BY event_type ORDER BY v) AS lo, min(i) - 1 AS rank, min(n) AS n
      FROM r GROUP BY event_type, v
      UNION ALL SELECT event_type, 200.0, max(v), max(n), max(n) FROM r GROUP BY event_type)
SELECT event_type, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY abs(rank - 0.25 * n), lo) AS w
      FROM p WHERE hi > lo) WHERE w = 1 AND event_type IN ('click', 'error', 'signup')""",
)
def agg_quantile_gap(spark, folder):
    """The interval an infinite budget picks, which is where the noisy quantile concentrates."""
    gaps = agg.quantile_gaps(events(spark, folder), keys(spark), "v", 0.25, 1.0, 200.0)
    best = gaps.groupBy("event_type").agg(
        F.max_by(F.struct("lo", "hi"), F.struct("score", -F.col("lo"))).alias("b")
    )
    return best.filter(F.col("event_type").isin("click", "error", "signup")).select("event_type", "b.lo", "b.hi")


@query(
    "agg_histogram",
    E
    + """, b AS (SELECT unnest(['[0, 100]', '(100, 200]', '(200, 250]']) AS m_binned),
x AS (SELECT event_type, CASE WHEN m <= 100 THEN '[0, 100]' WHEN m <= 200 THEN '(100, 200]' WHEN m <= 250 THEN '(200, 250]' END AS m_binned FROM e)
SELECT k.event_type, b.m_binned, count(x.m_binned) AS count FROM k CROSS JOIN b
LEFT JOIN x ON x.event_type = k.event_type AND x.m_binned = b.m_binned GROUP BY 1, 2""",
)
def agg_histogram(spark, folder):
    return agg.agg_histogram(events(spark, folder), keys(spark), "m", Bins((0, 100, 200, 250))).exact()


@query(
    "partition_by_value",
    "SELECT event_type AS part, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events WHERE event_type IN ('click', 'view') GROUP BY 1",
)
def partition(spark, folder):
    parts = label_parts(table(spark, folder, "events"), "event_type", {"click": "click", "view": "view"})
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


@query(
    "account_partition",
    """WITH f AS (SELECT user_id, event_type FROM events WHERE event_type IN ('click', 'view'))
SELECT 'rows' AS kind, event_type AS part, count(*) AS n FROM f GROUP BY ALL
UNION ALL SELECT 'groups', event_type, count(*) FROM f GROUP BY ALL
UNION ALL SELECT 'ids', event_type, count(DISTINCT user_id) FROM f GROUP BY ALL""",
)
def account_partition(spark, folder):
    """Parts of one account for rows, a grouping column and identifiers, exact at infinite budget; each in one scan."""
    source = table(spark, folder, "events").select("user_id", "event_type")
    splits = {"click": "click", "view": "view"}
    whole = Keys.of_values(spark, {"event_type": list(splits)})
    out = None
    for kind, change in {
        "rows": MaxRows(3), "groups": MaxRowsInMaxGroups("event_type", 3, 2), "ids": RowsWithId("user_id"),
    }.items():
        account = Account(Pure(INF))
        protected = account.add_private("events", source, change)
        if kind == "ids":  # no user has more than a thousand types, so nothing is cut
            protected = protected.enforce(max_groups_per_id("event_type", 1000))
        parts = account.split(protected, "event_type", splits, Pure(INF))
        build = lambda g: g.count("n")
        if kind == "ids":
            parts = parts.enforce(max_rows_per_id(10**6))
            build = lambda g: g.count_distinct(["user_id"], "n")
        answers = parts.evaluate(whole, build, Pure(INF))
        rows = answers.where("part = event_type").select(F.lit(kind).alias("kind"), "part", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "account_split_noisy",
    """WITH k AS (SELECT unnest(['click', 'error', 'signup']) AS part)
SELECT part, count(event_type) AS n, round(coalesce(avg(least(greatest(m, 10), 80)), 45), 6) AS mean, true AS n_near, true AS mean_near FROM k LEFT JOIN
(SELECT event_type, event_id % 100 AS m FROM events) e ON part = event_type GROUP BY 1""",
)
def account_split_noisy(spark, folder):
    """Parts at budgets of their own, answered together, beside the truth; forty scales are beyond chance."""
    source = table(spark, folder, "events").select("event_type", (F.col("event_id") % 100).alias("m"))
    names = ["click", "error", "signup"]
    nothing = Keys.of_values(spark, {})
    truth = None
    for budget, suffix in ((INF, ""), (4, "_noisy")):
        account = Account(Pure(budget))
        parts = account.split(account.add_private("events", source, MaxRows(1)), "event_type", dict(zip(names, names)), Pure(budget))
        own = {n: Pure(INF if budget == INF else i + 1) for i, n in enumerate(names)}
        counts = parts.evaluate(nothing, lambda g: g.count(f"n{suffix}"), own)
        both = counts.join(parts.evaluate(nothing, lambda g: g.average("m", 10, 80, f"mean{suffix}"), Pure(budget if budget == INF else 1)), "part")
        truth = both if truth is None else truth.join(both, "part")
    # The mean of n rows has two sums, of scale 2 and 70, at half the budget each.
    return truth.select(
        "part",
        "n",
        F.round("mean", 6).alias("mean"),
        (F.abs(F.col("n_noisy") - F.col("n")) <= 40).alias("n_near"),
        (F.abs(F.col("mean_noisy") - F.col("mean")) <= 2 * 40 * 70 / F.greatest(F.col("n") - 80, F.lit(1))).alias("mean_near"),
    )


@query(
    "cached_view",
    """SELECT event_type, count(*) AS n FROM events WHERE value > 20 GROUP BY 1
UNION ALL SELECT 'all', count(*) FROM events WHERE value > 20""",
)
def cached_view(spark, folder):
    account = Account(Pure(float("inf")))
    base = account.add_private("events", table(spark, folder, "events"), MaxRows(1))
    view = account.create_view("large", base.filter("value > 20"), cache=True)
    types = Keys.of_table(table(spark, folder, "events").select("event_type"))
    by_type = account.evaluate(view.groupby(types).count("n"), Pure(float("inf")))
    total = account.evaluate(view.groupby(Keys.of_values(spark, {})).count("n"), Pure(float("inf")))
    account.delete_view("large")
    return by_type.unionByName(total.withColumn("event_type", F.lit("all")))


@query(
    "evaluate_budgeted",
    """WITH r AS (SELECT event_id, user_id, event_type, event_id % 100 AS m FROM events),
c AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', event_id, user_id, event_type, m)), event_id) <= 20),
g AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY md5(event_type), event_type) AS d FROM c) WHERE d <= 5),
k AS (SELECT unnest(['click', 'error', 'signup', 'nothing']) AS event_type)
SELECT k.event_type, count(m) AS n, round(coalesce(avg(m), 50.0), 6) AS mean, true AS count_near, true AS mean_near
FROM k LEFT JOIN g ON k.event_type = g.event_type GROUP BY 1""",
)
def evaluate_budgeted(spark, folder):
    """Answers without noise beside noisy ones, of which chance decides no more than that they are near."""
    df = table(spark, folder, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 100).alias("m"))
    types = Keys.of_values(spark, {"event_type": ["click", "error", "signup", "nothing"]})
    answers = None
    for whole, part, suffix in ((Pure(INF), Pure(INF), ""), (Pure(3), Pure(1), "_noisy")):
        account = Account(whole)
        base = account.add_private("events", df, RowsWithId("user_id"))
        grouped = base.enforce(max_rows_per_id(20)).enforce(max_groups_per_id("event_type", 5)).groupby(types)
        counts = account.evaluate(grouped.count(f"n{suffix}"), part)
        both = counts.join(account.evaluate(grouped.average("m", 0, 100, f"mean{suffix}"), part), "event_type")
        answers = both if answers is None else answers.join(both, "event_type")
    # Scale 20 for the count, 20 * 50 * 2 for the sum of the mean; 80 scales are beyond chance.
    return answers.select(
        "event_type",
        "n",
        F.round("mean", 6).alias("mean"),
        (F.abs(F.col("n_noisy") - F.col("n")) <= 1600).alias("count_near"),
        (F.abs(F.col("mean_noisy") - F.col("mean")) <= 640_000 / F.greatest(F.col("n") - 3200, F.lit(1))).alias("mean_near"),
    )


@query(
    "evaluate_budgeted_exact",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(event_id AS STRING)), event_id) AS rn FROM (SELECT event_id, user_id, event_type FROM events)),
k AS (SELECT unnest(['click', 'error', 'signup', 'nothing']) AS event_type)
SELECT k.event_type, count(DISTINCT user_id) AS n FROM k LEFT JOIN r ON k.event_type = r.event_type GROUP BY 1""",
)
def evaluate_budgeted_exact(spark, folder):
    account = Account(Concentrated(float("inf")))
    df = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    base = account.add_private("events", df, RowsWithId("user_id"))
    bounded = base.enforce(max_groups_per_id("event_type", 5))
    types = Keys.of_values(spark, {"event_type": ["click", "error", "signup", "nothing"]})
    query_ = bounded.groupby(types).count_distinct(["user_id"], "n")
    return account.evaluate(query_, Concentrated(float("inf")))


COUNTS = "SELECT event_type, user_id % 20 AS bucket, count(*) AS n, sum(CAST(value AS DECIMAL(18, 2))) AS v FROM {events} GROUP BY 1, 2"


def _noisy(name, mechanism, num, den, value, reach, variance):
    """One draw per row; no draw passes ``reach`` by chance, and the draws of a type spread as they should."""

    @query(
        name,
        f"""SELECT event_type, bucket, CAST({value} AS DOUBLE) AS value, true AS near, true AS spread
FROM ({oracle_text(COUNTS)})""",
    )
    def run(spark, folder):
        df = derived(spark, folder, COUNTS)
        keys = ["event_type", "bucket"]
        drawn = add_noise(F.col(value), mechanism, F.lit(num), F.lit(den), keys)
        noisy = df.select(*keys, F.col(value).cast("double").alias("value"), drawn.alias("noisy"))
        noise = F.col("noisy") - F.col("value")
        alike = Window.partitionBy("event_type")  # at most twenty buckets
        return noisy.select(
            "event_type",
            "bucket",
            "value",
            (F.abs(noise) <= reach).alias("near"),
            (F.sum(noise * noise).over(alike) / F.count(noise).over(alike)).between(variance / 100, variance * 30).alias("spread"),
        )

    return run


_noisy("noise_geometric", "geometric", "2", "1", "n", 120, 7.8)
_noisy("noise_laplace", "laplace", "5", "2", "v", 150, 12.5)
_noisy("noise_discrete_gaussian", "discrete_gaussian", "25", "2", "n", 50, 12.5)
_noisy("noise_gaussian", "gaussian", "25", "2", "v", 50, 12.5)

_MECHANISMS = {"geometric": ("2", "1"), "laplace": ("5", "2"), "discrete_gaussian": ("25", "2"), "gaussian": ("25", "2")}


@query(
    "noise_repeats",
    f"""SELECT event_type, bucket, {', '.join(f'true AS {m}' for m in _MECHANISMS)} FROM ({oracle_text(COUNTS)})""",
)
def noise_repeats(spark, folder):
    """Two evaluations of the same draws over different partitions, without a checkpoint, agree in every row."""
    df, keys = derived(spark, folder, COUNTS), ["event_type", "bucket"]
    drawn = {m: add_noise(F.col("n"), m, F.lit(num), F.lit(den), keys).cast("double") for m, (num, den) in _MECHANISMS.items()}
    once = df.select(*keys, *[c.alias(m) for m, c in drawn.items()])
    again = df.repartition(3, "bucket").select(*keys, *[c.alias(f"{m}_again") for m, c in drawn.items()])
    return once.join(again, keys).select(*keys, *[(F.col(m) == F.col(f"{m}_again")).alias(m) for m in drawn])


SCALED = "SELECT event_type, count(*) AS n, CAST(length(event_type) AS DOUBLE) / 2 AS s FROM {events} GROUP BY 1, 3"


@query(
    "noise_description",
    """SELECT event_type, count(*) AS n, 'Two-Sided Geometric' AS "NOISE_DISTRIBUTION",
round(2 * exp(-0.4) / pow(1 - exp(-0.4), 2), 9) AS "VARIANCE" FROM events GROUP BY 1""",
)
def noise_description(spark, folder):
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return rounded(noise_columns(counts, Noise("geometric", Fraction(5, 2))), "VARIANCE", places=9)


@query(
    "noise_interval",
    f"""SELECT event_type, ceil(-s * ln(0.05 * (1 + exp(-1 / s)))) - 1 AS geometric, round(-s * ln(0.1), 9) AS laplace,
round(sqrt(s) * 1.6448536269514722, 9) AS gaussian FROM ({oracle_text(SCALED)})""",
)
def interval(spark, folder):
    df = derived(spark, folder, SCALED)
    kinds = ["geometric", "laplace", "gaussian"]
    return df.select("event_type", *[F.round(noise_interval(k, F.col("s"), 0.95), 9).alias(k) for k in kinds])


@query(
    "noise_variance",
    f"""SELECT event_type, round(2 * exp(-1 / s) / pow(1 - exp(-1 / s), 2), 9) AS geometric, round(2 * s * s, 9) AS laplace,
s AS gaussian FROM ({oracle_text(SCALED)})""",
)
def variance(spark, folder):
    df = derived(spark, folder, SCALED)
    return df.select(
        "event_type",
        F.round(noise_variance("geometric", F.col("s")), 9).alias("geometric"),
        F.round(noise_variance("laplace", F.col("s")), 9).alias("laplace"),
        noise_variance("gaussian", F.col("s")).alias("gaussian"),
    )


@query(
    "evaluate_groups",
    """SELECT event_type, count(*) AS n, true AS plausible FROM (SELECT user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('|', user_id, event_type)), event_type) <= 3) GROUP BY 1""",
)
def evaluate_groups(spark, folder):
    """Group values released from an identifier table, beside the counts that decide on them.

    Threshold 33 and scale 3: a group of 200 rows is named beyond chance.
    """
    from tabguard.operators.limits import limit_rows_per_id
    from tabguard.plans.protected import group_values

    account = Account(Approximate(2, "0.001"))
    df = table(spark, folder, "events").select("user_id", "event_type")
    base = account.add_private("events", df, RowsWithId("user_id")).enforce(max_rows_per_id(3))
    named = account.evaluate(group_values(base, ["event_type"]), Approximate(1, "0.0001"))
    counts = limit_rows_per_id(df, "user_id", 3).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return named_beside_counts(counts, named, ["event_type"], 200)
