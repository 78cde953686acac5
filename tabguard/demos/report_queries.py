"""Data quality, accuracy report, and smoothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.demos.registry import ORACLES, derived, oracle_text, query, table
from tabguard.demos.standin import CTES, DIGEST, UNITS, files
from tabguard.demos.tab_queries import TAUS, all_exact_oracle, budgets, person_oracle, reported_oracle, unit_oracle
from tabguard.functions.domains import Categories, Pattern, Range
from tabguard.operators import joins
from tabguard.plans import quality, report, smooth
from tabguard.plans import tabulate as tab
from tabguard.plans.tables import TABLES
from tabguard.runtime import materialise

BAD_PARTS = """SELECT p_partkey, CASE WHEN p_partkey % 40 = 0 THEN CAST(p_size + 90 AS INT) ELSE p_size END AS p_size,
  CASE WHEN p_partkey % 90 = 0 THEN 'Brand' WHEN p_partkey % 91 = 0 THEN CAST(NULL AS STRING) ELSE p_brand END AS p_brand, p_type
FROM {part}"""


@query(
    "dq_values",
    f"""WITH b AS (SELECT 'p_size' AS "column", CAST(p_size AS STRING) AS value FROM ({oracle_text(BAD_PARTS)}) WHERE p_size < 1 OR p_size >= 100
UNION ALL SELECT 'p_brand', p_brand FROM ({oracle_text(BAD_PARTS)}) WHERE p_brand IS NULL OR NOT regexp_full_match(p_brand, 'Brand#[0-9]+')
UNION ALL SELECT 'p_type', p_type FROM ({oracle_text(BAD_PARTS)}) WHERE p_type NOT IN ('ECONOMY', 'SMALL')),
d AS (SELECT "column", value, count(*) AS n_rows FROM b GROUP BY 1, 2)
SELECT *, count(*) OVER (PARTITION BY "column") AS n_values FROM d""",
)
def dq_values(spark, folder):
    domains = [
        Range("p_size", 1, 100),
        Pattern("p_brand", "Brand#[0-9]+"),
        Categories("p_type", ("ECONOMY", "SMALL")),
    ]
    return quality.dq_values(derived(spark, folder, BAD_PARTS), domains)


@query(
    "dq_duplicate_keys",
    CTES + 'SELECT MAFID AS "MAFID", count(*) AS n_rows FROM units GROUP BY 1 HAVING count(*) > 1',
)
def dq_duplicate_keys(spark, folder):
    return quality.dq_duplicate_keys(derived(spark, folder, UNITS), ["MAFID"])


@query(
    "dq_orphan_keys",
    """WITH p AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber <> 3),
u AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 30 <> 0), g AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 45 <> 1)
SELECT 'persons without unit' AS gap, k FROM p WHERE k NOT IN (SELECT k FROM u)
UNION ALL SELECT 'geography without unit', k FROM g WHERE k NOT IN (SELECT k FROM u)
UNION ALL SELECT 'units without geography', k FROM u WHERE k NOT IN (SELECT k FROM g)""",
)
def dq_orphan_keys(spark, folder):
    persons = derived(spark, folder, "SELECT l_orderkey AS k FROM {lineitem} WHERE l_linenumber <> 3")
    units = derived(spark, folder, "SELECT o_orderkey AS k FROM {orders} WHERE o_orderkey % 30 <> 0")
    geo = derived(spark, folder, "SELECT o_orderkey AS k FROM {orders} WHERE o_orderkey % 45 <> 1")
    return quality.dq_orphan_keys(persons, units, geo, "k")


@query("dq_region_scope", "SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (1, 2, 3, 4, 5)")
def dq_region_scope(spark, folder):
    return quality.dq_region_scope(table(spark, folder, "customer"), "c_nationkey", [1, 2, 3, 4, 5])


def spoiled(spark, folder):
    """Exact PH7 counts with a stated variance that is wrong for some cells."""
    answers = tab.exact_tabulations(*files(spark, folder), ["PH7"])
    variance = F.when((F.col("DATA_CELL") == 2) & (F.col("REGION_ID") > "10"), 31.0).otherwise(32.0)
    return answers.withColumn("VARIANCE", variance).withColumn("NOISE_DISTRIBUTION", F.lit("Discrete Gaussian"))


_PH7 = f"""SELECT 'PH7' AS "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", "COUNT",
CASE WHEN cell = 2 AND "REGION_ID" > '10' THEN 31.0::DOUBLE ELSE 32.0::DOUBLE END AS "VARIANCE",
'Discrete Gaussian' AS "NOISE_DISTRIBUTION" FROM ({person_oracle('PH7', True, 'cell')})"""


@query(
    "dq_output_variance",
    f"""SELECT *, 32.0::DOUBLE AS "EXPECTED" FROM ({_PH7}) WHERE "VARIANCE" <> 32""",
)
def dq_output_variance(spark, folder):
    expected = quality.expected_variance_rows(spark, budgets(1, ["PH7"]), TAUS, "concentrated")
    return quality.dq_output_variance(spoiled(spark, folder), expected)


@query(
    "dq_output_format",
    f"""SELECT "TABLE" AS "table", 'ITERATION_CODE' AS "column", 'Z' AS value, count(*) AS n_rows, 1::BIGINT AS n_values
FROM ({all_exact_oracle()}) WHERE "ITERATION_CODE" = 'C' GROUP BY 1
UNION ALL SELECT "TABLE", upper("TABLE") || '_DATA_CELL', CAST("DATA_CELL" AS VARCHAR), count(*), 2
FROM ({all_exact_oracle()}) WHERE "TABLE" IN ('PH1_denom', 'PH5_denom') AND "DATA_CELL" <> 1 GROUP BY 1, 2, 3""",
)
def dq_output_format(spark, folder):
    """All tables of one counting, of which one letter is spoiled wherever it occurs.

    True denominators repeat their count in two cells that published tables do not have.
    """
    persons, units, geo = files(spark, folder)
    with tab.shared_units(units, geo) as unit_geo:
        known = materialise(tab.exact_tabulations(persons, units, geo, unit_geo=unit_geo))
    wrong = F.when(F.col("ITERATION_CODE") == "C", F.lit("Z")).otherwise(F.col("ITERATION_CODE"))
    spoilt = known.withColumn("ITERATION_CODE", wrong).withColumns(
        {"VARIANCE": F.lit(1.0), "NOISE_DISTRIBUTION": F.lit("Discrete Gaussian")}
    )
    outputs = {name: tab.one_table(spoilt, name) for name in TABLES}
    return quality.dq_output_format(outputs, {name: quality.output_domains(t) for name, t in TABLES.items()})


@query(
    "dq_update_domains",
    """SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS STRING) FROM part""",
)
def dq_update_domains(spark, folder):
    return quality.dq_update_domains(table(spark, folder, "part"), ["p_brand", "p_size"])


ESTIMATES = """SELECT o_orderkey AS id, CAST(o_custkey % 40 AS DOUBLE) AS COUNT_NOISY, 9.0D AS VARIANCE,
  CASE WHEN o_orderkey % 9 = 0 THEN 12.5D WHEN o_orderkey % 10 = 0 THEN 0.0D ELSE CAST(o_orderkey % 50 + 1 AS DOUBLE) END AS PRED FROM {orders}"""
_EST = oracle_text(ESTIMATES).replace("9.0D", "9.0::DOUBLE").replace("12.5D", "12.5::DOUBLE").replace("0.0D", "0.0::DOUBLE")


@query(
    "dq_estimates",
    f"""SELECT id, COUNT_NOISY AS "COUNT_NOISY", VARIANCE AS "VARIANCE", PRED AS "PRED", concat_ws('; ', CASE WHEN PRED <> floor(PRED) OR PRED <= 0 THEN 'not a positive integer' END,
  CASE WHEN abs(PRED - COUNT_NOISY) > 18 THEN 'over 6 deviations from the noisy count' END) AS "REASONS"
FROM ({_EST}) WHERE PRED <> floor(PRED) OR PRED <= 0 OR abs(PRED - COUNT_NOISY) > 18""",
)
def dq_estimates(spark, folder):
    return quality.dq_estimates_counts(derived(spark, folder, ESTIMATES))


RATIOS = "SELECT o_orderkey AS id, CAST(o_orderkey % 120 AS DOUBLE) / 10 AS RATIO_PRED FROM {orders}"


@query(
    "dq_estimates_ratios",
    f"""SELECT id, RATIO_PRED AS "RATIO_PRED" FROM ({oracle_text(RATIOS)}) WHERE RATIO_PRED < 1 OR RATIO_PRED > 10""",
)
def dq_estimates_ratios(spark, folder):
    return quality.dq_estimates_ratios(derived(spark, folder, RATIOS), 1.0, 10.0)


def truth(spark, folder, names):
    return tab.exact_tabulations(*files(spark, folder), names)


def both_answers(spark, folder):
    """All eleven tables at infinite budget, that is truncated only, and the truth; each counted once."""
    persons, units, geo = files(spark, folder)
    with tab.shared_units(units, geo) as unit_geo:
        plan = budgets(float("inf"))
        counted = materialise(tab.private_tabulations(persons, units, geo, TAUS, plan, "pure", DIGEST, unit_geo=unit_geo))
        known = materialise(tab.exact_tabulations(persons, units, geo, unit_geo=unit_geo))
    answers = counted.unionByName(tab.derive_tables(counted))
    return answers.drop("NOISE_DISTRIBUTION", "VARIANCE"), known


_CUT, _TRUE = reported_oracle(), all_exact_oracle()
_TRUE_PH7 = f"""SELECT 'PH7' AS "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", "COUNT"
FROM ({person_oracle('PH7', True, 'cell')}) WHERE cell <> 3"""
_KEYS = '"TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"'


@query(
    "left_join_truth",
    f"""SELECT {_KEYS}, c."COUNT" AS "NOISY", coalesce(t."COUNT", 0) AS "GROUND_TRUTH"
FROM ({_CUT}) c LEFT JOIN (SELECT * FROM ({_TRUE}) WHERE "DATA_CELL" <> 3) t USING ({_KEYS})""",
)
def left_join_truth(spark, folder):
    answers, known = both_answers(spark, folder)
    # A truth with gaps: cells that are not in it count zero.
    return joins.left_join_truth(answers, known.filter("DATA_CELL <> 3"))


_ERRORS = f"""SELECT {_KEYS}, abs(c."COUNT" - coalesce(t."COUNT", 0)) AS "ERROR"
FROM ({_CUT}) c LEFT JOIN ({_TRUE}) t USING ({_KEYS})"""


def errors(spark, folder):
    return report.error_rows(*both_answers(spark, folder))


@query("error_rows", _ERRORS)
def error_rows(spark, folder):
    return errors(spark, folder)


@query(
    "error_trials",
    f"""SELECT {_KEYS}, abs(c - coalesce(t."COUNT", 0)) AS "ERROR", i AS "TRIAL" FROM
(SELECT 'PH7' AS "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", "COUNT" AS c FROM ({person_oracle('PH7', False, 'cell')})) k
LEFT JOIN ({_TRUE_PH7}) t USING ({_KEYS}) CROSS JOIN (SELECT unnest([0, 1, 2])::INTEGER AS i)""",
)
def error_trials(spark, folder):
    """Three trials of one tabulation at infinite budget, whose errors are those of the cut alone."""
    known = truth(spark, folder, ["PH7"]).filter("DATA_CELL <> 3")
    plan = budgets(float("inf"), ["PH7"])
    trials = tab.private_tabulations(*files(spark, folder), TAUS, plan, "pure", DIGEST, trials=3)
    return report.error_trials(trials, known)


@query(
    "error_trials_noisy",
    f"""SELECT 'PH7' AS "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", i AS "TRIAL", true AS plausible
FROM ({person_oracle('PH7', False, 'cell')}) CROSS JOIN (SELECT unnest(range(20))::INTEGER AS i)""",
)
def error_trials_noisy(spark, folder):
    """Twenty noisy trials of one table against the truth, drawn side by side.

    Cut and noise of scale 8 take no answer further from the truth than the truth itself and 60 scales.
    """
    known = truth(spark, folder, ["PH7"])
    noisy = tab.private_tabulations(*files(spark, folder), TAUS, budgets(1, ["PH7"]), "pure", DIGEST, trials=20)
    keys = ["TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"]
    real = known.select(*keys, F.col("COUNT").alias("__true"))
    errors_ = report.error_trials(noisy, known).join(real, keys, "left")
    near = F.col("ERROR").between(0, F.coalesce("__true", F.lit(0)) + 480)
    return errors_.select(*keys, "TRIAL", near.alias("plausible"))


@query(
    "error_percentile",
    f"""SELECT "TABLE", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", round(quantile_cont("ERROR", 0.9), 6) AS "EXPERIMENTAL_MOE", count(*) AS "COUNT"
FROM ({_ERRORS}) GROUP BY 1, 2, 3, 4""",
)
def error_percentile(spark, folder):
    out = report.error_percentile(errors(spark, folder))
    return out.withColumn("EXPERIMENTAL_MOE", F.round("EXPERIMENTAL_MOE", 6))


@query(
    "error_percentile_large",
    """SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.9), 4) AS p, count(*) AS p_n FROM orders GROUP BY 1""",
)
def error_percentile_large(spark, folder):
    """The same percentile over few keys with very many distinct values each."""
    from tabguard.operators.ranks import exact_percentile

    out = exact_percentile(table(spark, folder, "orders"), ["o_orderstatus"], "o_totalprice", 0.9, "p")
    return out.withColumn("p", F.round("p", 4))


def reach_sql(of):
    """The rows that one household can change of each table, by name."""
    cases = []
    for n, t in TABLES.items():
        source = TABLES[t.derived_from or n]
        size = 2.0 if source.of_units else 2.0 * TAUS[source.name] + 2
        cases.append(f"WHEN '{n}' THEN {size}::DOUBLE")
    return f"CASE {of} {' '.join(cases)} END"


@query(
    "error_expected_moe",
    f"""WITH r AS (SELECT *, round(1.64 * {reach_sql('"TABLE"')} / sqrt(2 * 0.5), 1) AS m FROM ({ORACLES["error_percentile"]}))
SELECT * EXCLUDE (m), CASE WHEN "TABLE" = 'PH8_num' AND "DATA_CELL" = 2 THEN round(sqrt(2) * m, 1) ELSE m END AS "EXPECTED_MOE" FROM r""",
)
def error_expected_moe(spark, folder):
    """The report of all tables with the margins that the noise should give."""
    summary = report.error_percentile(errors(spark, folder))
    summary = summary.withColumn("EXPERIMENTAL_MOE", F.round("EXPERIMENTAL_MOE", 6))
    return report.error_expected_moe(summary, budgets("0.5"), TAUS, "concentrated")


TRIALS = """SELECT l_orderkey AS k, l_linenumber AS TRIAL, sum(CAST(l_quantity AS BIGINT)) AS VALUE FROM {lineitem} GROUP BY 1, 2"""
REAL = "SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_custkey % 50 AS BIGINT) AS TRUE_VALUE FROM {orders}"


@query(
    "error_metric_by_cell",
    f"""WITH j AS (SELECT r.k, s, CAST(VALUE - TRUE_VALUE AS DOUBLE) AS e FROM ({oracle_text(REAL)}) r LEFT JOIN ({oracle_text(TRIALS)}) t ON r.k = t.k),
m AS (SELECT k, 'squared' AS "METRIC", round(avg(e * e), 6) AS "ERROR" FROM j GROUP BY 1
UNION ALL SELECT k, 'spread of F', round(stddev_pop(e), 6) FROM j WHERE s = 'F' GROUP BY 1)
SELECT * FROM m WHERE "ERROR" IS NOT NULL""",
)
def error_metric_by_cell(spark, folder):
    error = (F.col("VALUE") - F.col("TRUE_VALUE")).cast("double")
    metrics = {
        "squared": (error * error, F.avg, None),
        "spread of F": (error, F.stddev_pop, F.col("s") == "F"),
    }
    out = report.error_metric_by_cell(
        derived(spark, folder, REAL), derived(spark, folder, TRIALS), ["k"], metrics
    )
    return out.withColumn("ERROR", F.round("ERROR", 6))


# Smoothing: exact leaf counts with a constant variance stand in for noisy answers.


def leaves(spark, folder, name, variance=30.0):
    rows = tab.exact_tabulations(*files(spark, folder), [name]).filter(
        F.col("DATA_CELL").isin(TABLES[name].leaf_cells)
    )
    if TABLES[name].of_units and TABLES[name].leaf_cells != [1]:
        rows = rows.filter("DATA_CELL <> 1")
    return rows.withColumn("VARIANCE", F.lit(variance)).drop("TABLE")


def _leaf_sql(name, cell_filter):
    source = unit_oracle(name, True) if name in ("PH1_denom", "PH8_denom") else person_oracle(name, True, "cell")
    cell = '"' + TABLES[name].cell + '"' if name in ("PH1_denom", "PH8_denom") else "cell"
    return f"""SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", {cell} AS cell, "COUNT" AS n FROM ({source}) WHERE {cell} {cell_filter}"""


@query("region_types_present", """SELECT 'USA' AS "REGION_TYPE" UNION ALL SELECT 'STATE'""")
def region_types_present(spark, folder):
    nation = tab.exact_tabulations(*files(spark, folder), ["PH7"])
    tract = nation.filter("REGION_TYPE = 'USA'").withColumn("REGION_TYPE", F.lit("TRACT"))
    return smooth.region_types_present(nation.unionByName(tract))


@query("pad_region_id", """SELECT c_custkey, lpad(CAST(c_nationkey AS STRING), 2, '0') AS "GEOID" FROM customer""")
def pad_region_id(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", smooth.pad_region_id(F.col("c_nationkey")).alias("GEOID")
    )


@query("margin_of_error", "SELECT o_orderkey, round(1.6448536269514722 * sqrt(o_custkey), 6) AS moe FROM orders")
def margin(spark, folder):
    from tabguard.operators.noise import margin_of_error

    return table(spark, folder, "orders").select(
        "o_orderkey", F.round(margin_of_error(F.col("o_custkey")), 6).alias("moe")
    )


_PH3_LEAVES = _leaf_sql("PH3", "IN (2, 4, 5, 6, 7, 9, 10)")


@query(
    "marginal_cells",
    f"""WITH l AS ({_PH3_LEAVES}), m AS (SELECT * FROM (VALUES (3,4),(3,5),(3,6),(3,7),(8,9),(8,10),(1,2),(1,4),(1,5),(1,6),(1,7),(1,9),(1,10)) t(dest, src)),
a AS (SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell, n, 30.0::DOUBLE AS v FROM l
UNION ALL SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", dest, CAST(sum(n) AS BIGINT), 30.0::DOUBLE * count(*) FROM l JOIN m ON cell = src GROUP BY 1, 2, 3, 4)
SELECT lpad("REGION_ID", 2, '0') AS "GEOID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", n AS "COUNT_NOISY", v AS "VARIANCE",
round(1.6448536269514722 * sqrt(v), 6) AS "MOE_NOISY" FROM a""",
)
def marginal_cells(spark, folder):
    out = smooth.marginal_cells(leaves(spark, folder, "PH3"), smooth.MARGINS["PH3"])
    return out.withColumn("MOE_NOISY", F.round("MOE_NOISY", 6))


def ratio_input(spark, folder):
    """PH1: numerator cells 2 and 3, one denominator cell."""
    num = leaves(spark, folder, "PH1_num")
    den = leaves(spark, folder, "PH1_denom", 2.0)
    return num, den


_NUM, _DEN = _leaf_sql("PH1_num", "IN (2, 3)"), _leaf_sql("PH1_denom", "= 1")
_NUM_PH5 = f"""SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell, "COUNT" AS n FROM ({person_oracle('PH4', True, 'cell')}) WHERE cell IN (2, 3)"""
_DEN_PH5 = f"""SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "PH5_DENOM_DATA_CELL" AS cell, "COUNT" AS n FROM ({unit_oracle('PH5_denom', True)})
WHERE "PH5_DENOM_DATA_CELL" = 1"""
_SIDES = f"""WITH l AS ({_NUM}), nn AS (SELECT * , 30.0::DOUBLE AS v FROM l UNION ALL
SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", 1, CAST(sum(n) AS BIGINT), 30.0::DOUBLE * count(*) FROM l GROUP BY 1, 2, 3),
dd AS (SELECT *, 2.0::DOUBLE AS v FROM ({_DEN}))"""
_Z = "1.6448536269514722"


@query(
    "ratio_table",
    _SIDES
    + f""" SELECT lpad(nn."REGION_ID", 2, '0') AS "GEOID", nn."REGION_TYPE", nn."ITERATION_CODE", nn.cell AS "DATA_CELL", nn.n AS "COUNT_NOISY_NUM",
nn.v AS "VARIANCE_NUM", round({_Z} * sqrt(nn.v), 6) AS "MOE_NOISY_NUM", dd.n AS "COUNT_NOISY_DENOM", dd.v AS "VARIANCE_DENOM",
round({_Z} * sqrt(dd.v), 6) AS "MOE_NOISY_DENOM", round(nn.n / nullif(dd.n, 0), 9) AS "RATIO_NOISY"
FROM nn LEFT JOIN dd ON nn."REGION_ID" = dd."REGION_ID" AND nn."REGION_TYPE" = dd."REGION_TYPE" AND nn."ITERATION_CODE" = dd."ITERATION_CODE" """,
)
def ratio_table(spark, folder):
    out = smooth.ratio_table(*ratio_input(spark, folder), by_cell=False)
    return out.withColumns(
        {
            "RATIO_NOISY": F.round("RATIO_NOISY", 9),
            "MOE_NOISY_NUM": F.round("MOE_NOISY_NUM", 6),
            "MOE_NOISY_DENOM": F.round("MOE_NOISY_DENOM", 6),
        }
    )


_HALF = 'nn."REGION_ID", nn."REGION_TYPE", nn."ITERATION_CODE"'


@query(
    "join_num_denom_broadcast_cell",
    _SIDES
    + f""" SELECT {_HALF}, nn.cell AS "DATA_CELL", nn.n AS num, dd.n AS den FROM nn
LEFT JOIN dd ON nn."REGION_ID" = dd."REGION_ID" AND nn."REGION_TYPE" = dd."REGION_TYPE" AND nn."ITERATION_CODE" = dd."ITERATION_CODE" """,
)
def join_num_denom_broadcast_cell(spark, folder):
    num, den = ratio_input(spark, folder)
    num = smooth.with_total_cell(num).withColumnRenamed("COUNT", "num").drop("VARIANCE")
    return joins.join_num_denom_broadcast_cell(num, den.withColumnRenamed("COUNT", "den").drop("VARIANCE"))


@query(
    "join_num_denom_by_cell",
    _SIDES
    + f""", d2 AS ({_leaf_sql('PH8_denom', 'IN (2, 3)')})
SELECT d2."REGION_ID", d2."REGION_TYPE", d2."ITERATION_CODE", d2.cell AS "DATA_CELL", d2.n AS den, nn.n AS num FROM d2
LEFT JOIN nn ON nn."REGION_ID" = d2."REGION_ID" AND nn."REGION_TYPE" = d2."REGION_TYPE" AND nn."ITERATION_CODE" = d2."ITERATION_CODE" AND nn.cell = d2.cell""",
)
def join_num_denom_by_cell(spark, folder):
    num = leaves(spark, folder, "PH1_num").withColumnRenamed("COUNT", "num").drop("VARIANCE")
    den = leaves(spark, folder, "PH8_denom").withColumnRenamed("COUNT", "den").drop("VARIANCE")
    return joins.join_num_denom_by_cell(num, den)


# Leaf cells of the tables that the count model serves, and the leaves behind their margins.
_COUNT_LEAVES = {n: [c for c in TABLES[n].leaf_cells if c not in smooth.MARGINS[n]] for n in smooth.MARGINS}
_ALL_LEAVES = " UNION ALL ".join(
    f"""SELECT '{n}' AS "TABLE", "REGION_ID", "REGION_TYPE", {'"ITERATION_CODE"' if TABLES[n].race else "'*'"} AS "ITERATION_CODE", cell, "COUNT" AS n
FROM ({person_oracle(n, True, 'cell')}) WHERE cell IN ({', '.join(map(str, cells))})"""
    for n, cells in _COUNT_LEAVES.items()
)
_ALL_MARGINS = ", ".join(
    f"('{n}', {dest}, {src})" for n, margins in smooth.MARGINS.items() for dest, sources in margins.items() for src in sources
)


def count_estimates(spark, folder):
    """All five tables of counts, tabulated together."""
    exact = materialise(tab.exact_tabulations(*files(spark, folder), list(smooth.MARGINS)))
    out = []
    for name, margins in smooth.MARGINS.items():
        leaf = (F.col("TABLE") == name) & F.col("DATA_CELL").isin(_COUNT_LEAVES[name])
        rows = exact.filter(leaf).withColumn("VARIANCE", F.lit(30.0)).drop("TABLE")
        out.append(smooth.posterior_count(smooth.marginal_cells(rows, margins), margins).withColumn("TABLE", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


# Mean of the truncated normal with the normal distribution function summed up by Simpson's rule.
_LEAF_MEANS = f"""WITH l AS ({_ALL_LEAVES}), z AS (SELECT *, n / sqrt(30.0::DOUBLE) AS a FROM l),
p AS (SELECT *, exp(-a * a / 2) / sqrt(2 * pi()) AS phi, CASE WHEN a > 9 THEN 1.0::DOUBLE ELSE 0.5 + a / 1200 / sqrt(2 * pi()) * list_sum(
  list_transform(range(0, 401), lambda i: CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-(a * i / 400) * (a * i / 400) / 2))) END AS tail FROM z),
m AS (SELECT "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell, n, CASE WHEN a > 38 THEN n ELSE round(n + phi / tail * sqrt(30.0::DOUBLE)) END AS pred FROM p),
g AS (SELECT * FROM (VALUES {_ALL_MARGINS}) t("TABLE", dest, src))"""


@query(
    "posterior_count_mean",
    _LEAF_MEANS
    + """ SELECT "TABLE", lpad("REGION_ID", 2, '0') AS "GEOID", "REGION_TYPE", "ITERATION_CODE", CAST(cell AS INTEGER) AS "DATA_CELL", CAST(n AS DOUBLE) AS "COUNT_NOISY", CAST(pred AS DOUBLE) AS "PRED" FROM m
UNION ALL SELECT m."TABLE", lpad("REGION_ID", 2, '0'), "REGION_TYPE", "ITERATION_CODE", CAST(dest AS INTEGER), CAST(sum(n) AS DOUBLE), CAST(sum(pred) AS DOUBLE)
FROM m JOIN g ON m."TABLE" = g."TABLE" AND m.cell = g.src GROUP BY m."TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", dest""",
)
def posterior_count_mean(spark, folder):
    out = count_estimates(spark, folder)
    return out.select("TABLE", "GEOID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", "COUNT_NOISY", "PRED")


# Ends of the leaves' intervals from a table of the normal distribution function, summed by the trapezoid rule in steps of
# 1/1000 and read backwards by linear interpolation.
_LEAF_ENDS = f"""WITH l AS ({_ALL_LEAVES}),
g AS (SELECT i / 1000.0::DOUBLE AS x, exp(-x * x / 2) / sqrt(2 * pi()) AS phi FROM (SELECT unnest(range(-9000, 9001)) AS i)),
c AS (SELECT x, sum((phi + before) / 2000) OVER (ORDER BY x) AS p FROM (SELECT x, phi, coalesce(lag(phi) OVER (ORDER BY x), 0) AS before FROM g)),
s AS (SELECT x, p, coalesce(lead(p) OVER (ORDER BY x) - p, 0) AS step FROM c),
a AS (SELECT l.*, greatest(-n / sqrt(30.0::DOUBLE), -9) AS a FROM l),
b AS (SELECT a.*, s.p + (a.a - s.x) * 1000 * s.step AS below FROM a ASOF JOIN s ON a.a >= s.x),
u AS (SELECT b.*, below + 0.05 * (1 - below) AS lo, below + 0.95 * (1 - below) AS hi FROM b),
v AS (SELECT u.*, n + sqrt(30.0::DOUBLE) * (s.x + (lo - s.p) / s.step / 1000) AS low FROM u ASOF JOIN s ON u.lo >= s.p),
w AS (SELECT v.*, n + sqrt(30.0::DOUBLE) * (s.x + (hi - s.p) / s.step / 1000) AS high FROM v ASOF JOIN s ON v.hi >= s.p),
t AS (SELECT * FROM (VALUES {_ALL_MARGINS}) t("TABLE", dest, src))"""


@query(
    "posterior_count_interval",
    _LEAF_ENDS
    + """ SELECT "TABLE", lpad("REGION_ID", 2, '0') AS "GEOID", "REGION_TYPE", "ITERATION_CODE", CAST(cell AS INTEGER) AS "DATA_CELL",
floor(low) AS "PRED_LO", ceil(high) AS "PRED_HI", true AS fits FROM w
UNION ALL SELECT DISTINCT w."TABLE", lpad("REGION_ID", 2, '0'), "REGION_TYPE", "ITERATION_CODE", CAST(dest AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), true
FROM w JOIN t ON w."TABLE" = t."TABLE" AND w.cell = t.src""",
)
def posterior_count_interval(spark, folder):
    """Intervals of leaves as they are; those of margins by whether they hold the mean and are about as wide as they
    can be, 1.645 deviations to each side."""
    out = count_estimates(spark, folder)
    leaf = F.lit(False)
    for name, cells in _COUNT_LEAVES.items():
        leaf = leaf | ((F.col("TABLE") == name) & F.col("DATA_CELL").isin(cells))
    widest = 2 * 1.6448536269514722 * F.sqrt("VARIANCE") + 3
    # The mean sums rounded leaves, each up to a half off.
    off = 0.5 * F.col("VARIANCE") / 30.0
    holds = F.col("PRED").between(F.col("PRED_LO") - off, F.col("PRED_HI") + off)
    fits = holds & (F.col("PRED_HI") - F.col("PRED_LO") <= widest)
    return out.select(
        "TABLE",
        "GEOID",
        "REGION_TYPE",
        "ITERATION_CODE",
        "DATA_CELL",
        F.when(leaf, F.col("PRED_LO")).alias("PRED_LO"),
        F.when(leaf, F.col("PRED_HI")).alias("PRED_HI"),
        (leaf | fits).alias("fits"),
    )


def ratio_checks(estimates, least):
    """Noisy ratios with what must hold of their estimates: within the bounds, inside their interval, and near the noisy
    ratio where the denominator is large and the ratio lies well inside the bounds."""
    least_here = F.when(F.col("DATA_CELL") == 1, F.lit(least)).otherwise(0.0) if least else F.lit(1.0)
    noisy, den = F.col("RATIO_NOISY"), F.col("COUNT_NOISY_DENOM")
    spread = F.sqrt(F.col("VARIANCE_NUM") + noisy * noisy * F.col("VARIANCE_DENOM")) / den
    clear = (den > 200) & (noisy - 8 * spread > 1.0) & (noisy + 8 * spread < smooth.TRUN)
    return estimates.select(
        "GEOID",
        "REGION_TYPE",
        "ITERATION_CODE",
        "DATA_CELL",
        F.round("RATIO_NOISY", 9).alias("RATIO_NOISY"),
        F.col("RATIO_PRED").between(least_here, smooth.TRUN).alias("bounded"),
        F.col("RATIO_PRED").between(F.col("RATIO_PRED_LO"), F.col("RATIO_PRED_HI")).alias("inside"),
        (~F.coalesce(clear, F.lit(False)) | (F.abs(F.col("RATIO_PRED") - noisy) <= spread)).alias("near"),
    )


_RATIO_ORACLE = """ SELECT lpad(nn."REGION_ID", 2, '0') AS "GEOID", nn."REGION_TYPE", nn."ITERATION_CODE", CAST(nn.cell AS INTEGER) AS "DATA_CELL",
round(nn.n / nullif(dd.n, 0), 9) AS "RATIO_NOISY", true AS bounded, true AS inside, true AS near
FROM nn LEFT JOIN dd ON nn."REGION_ID" = dd."REGION_ID" AND nn."REGION_TYPE" = dd."REGION_TYPE" AND nn."ITERATION_CODE" = dd."ITERATION_CODE" """


@query("posterior_ratio_two_part", _SIDES + _RATIO_ORACLE)
def posterior_ratio_two_part(spark, folder):
    both = smooth.ratio_table(*ratio_input(spark, folder), by_cell=False)
    return ratio_checks(smooth.posterior_ratio_two_part(both, 1.0), 1.0)


def ratio_input_families(spark, folder):
    """PH5: adults and children of families over families, whose ratio of all ages is two at least."""
    return leaves(spark, folder, "PH5_num"), leaves(spark, folder, "PH5_denom", 2.0)


_PH5_SIDES = _SIDES.replace(f"({_NUM})", "(" + _NUM_PH5 + ")").replace(f"({_DEN})", "(" + _DEN_PH5 + ")")


@query("posterior_ratio_two_part_families", _PH5_SIDES + _RATIO_ORACLE)
def posterior_ratio_two_part_families(spark, folder):
    both = smooth.ratio_table(*ratio_input_families(spark, folder), by_cell=False)
    return ratio_checks(smooth.posterior_ratio_two_part(both, 2.0), 2.0)


@query(
    "posterior_ratio_one_part",
    f"""WITH l AS (SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", CASE WHEN cell IN (2, 3) THEN 2 ELSE 3 END AS cell, sum(n) AS n
FROM ({_leaf_sql('PH7', 'IN (2, 3, 4)')}) GROUP BY ALL),
m AS ({_leaf_sql('PH8_denom', 'IN (2, 3)')}),
nn AS (SELECT * FROM l UNION ALL SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", 1, sum(n) FROM l GROUP BY 1, 2, 3),
dd AS (SELECT * FROM m UNION ALL SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", 1, sum(n) FROM m GROUP BY 1, 2, 3)"""
    + _RATIO_ORACLE.replace("FROM nn LEFT JOIN dd", "FROM dd LEFT JOIN nn").replace("lpad(nn.", "lpad(dd.")
    .replace(', nn."REGION_TYPE", nn."ITERATION_CODE", CAST(nn.cell', ', dd."REGION_TYPE", dd."ITERATION_CODE", CAST(dd.cell')
    + " AND nn.cell = dd.cell",
)
def posterior_ratio_one_part(spark, folder):
    num = leaves(spark, folder, "PH7").withColumn(
        "DATA_CELL", F.when(F.col("DATA_CELL").isin(2, 3), 2).otherwise(3)
    )
    keys = ["REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"]
    num = num.groupBy(*keys).agg(F.sum("COUNT").alias("COUNT"), F.sum("VARIANCE").alias("VARIANCE"))
    den = leaves(spark, folder, "PH8_denom", 2.0)
    return ratio_checks(smooth.posterior_ratio_one_part(smooth.ratio_table(num, den, by_cell=True)), None)


SUMMARY = """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'PH1' WHEN o_orderkey % 3 = 1 THEN 'PH5' ELSE 'PH8' END AS TABLE_NAME,
 CAST(o_orderkey % 3 + 1 AS INT) AS DATA_CELL, CAST(o_custkey % 60 - 5 AS DOUBLE) AS A, CAST(o_custkey % 13 AS DOUBLE) - 1 AS B,
 CAST(o_orderkey % 17 AS DOUBLE) AS W FROM {orders}"""


@query(
    "model_summary_counts",
    f"""WITH s AS ({oracle_text(SUMMARY)}), x AS (SELECT TABLE_NAME AS t, 'NM' AS k, A AS v, W * 2 AS w FROM s
UNION ALL SELECT TABLE_NAME, 'PRED', A + 3, W + 1 FROM s)
SELECT t AS "TABLE", k AS "KIND", min(v) AS "MIN", max(v) AS "MAX", round(100 * avg(CASE WHEN v <= 0 THEN 1.0 ELSE 0.0 END), 6) AS "P_NEG",
median(w) AS "LEN" FROM x GROUP BY 1, 2""",
)
def model_summary_counts(spark, folder):
    s = derived(spark, folder, SUMMARY)
    estimates = s.select(
        F.col("TABLE_NAME").alias("TABLE"),
        F.col("A").alias("COUNT_NOISY"),
        F.col("W").alias("MOE_NOISY"),
        (F.col("A") + 3).alias("PRED"),
        F.lit(0.0).alias("PRED_LO"),
        (F.col("W") + 1).alias("PRED_HI"),
    )
    return smooth.model_summary_counts(estimates).withColumn("P_NEG", F.round("P_NEG", 6))


@query(
    "model_summary_ratios",
    f"""WITH s AS ({oracle_text(SUMMARY)}), x AS (SELECT TABLE_NAME AS t, 'NM' AS k, DATA_CELL AS c, B AS v, CAST(NULL AS DOUBLE) AS w FROM s
UNION ALL SELECT TABLE_NAME, 'PRED', DATA_CELL, B + 1, W FROM s)
SELECT t AS "TABLE", k AS "KIND", min(v) AS "MIN", max(v) AS "MAX", round(100 * avg(CASE WHEN (c = 1 AND (v < CASE WHEN t = 'PH5' THEN 2 ELSE 1 END OR v > 10))
OR (c <> 1 AND v < 0) THEN 1.0 ELSE 0.0 END), 6) AS "P_BAD", round(avg(w), 6) AS "LEN" FROM x GROUP BY 1, 2""",
)
def model_summary_ratios(spark, folder):
    s = derived(spark, folder, SUMMARY)
    estimates = s.select(
        F.col("TABLE_NAME").alias("TABLE"),
        "DATA_CELL",
        F.col("B").alias("RATIO_NOISY"),
        (F.col("B") + 1).alias("RATIO_PRED"),
        F.lit(0.0).alias("RATIO_PRED_LO"),
        F.col("W").alias("RATIO_PRED_HI"),
    )
    out = smooth.model_summary_ratios(estimates)
    return out.withColumns({"P_BAD": F.round("P_BAD", 6), "LEN": F.round("LEN", 6)})



