"""Projections, filters, cleaning, domains and row expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabguard.demos.registry import derived, oracle_text, query, table
from tabguard.functions.binning import Bins
from tabguard.functions.domains import (
    Categories,
    Pattern,
    Range,
    Splits,
    cell_codes,
    cell_index,
    code_columns,
    value_columns,
)
from tabguard.operators import cleaning, expand, rowwise

DIRTY = """
SELECT event_id, user_id, event_type,
       CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) WHEN event_id % 7 = 1 THEN CAST('NaN' AS DOUBLE)
            WHEN event_id % 7 = 2 THEN CAST('Infinity' AS DOUBLE)
            WHEN event_id % 7 = 3 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS v,
       CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS STRING) ELSE event_type END AS kind,
       CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS BIGINT) ELSE user_id END AS who
FROM {events}
"""
D = f"WITH d AS ({oracle_text(DIRTY)})"


def dirty(spark, folder):
    return derived(spark, folder, DIRTY)


@query(
    "coerce_types",
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part",
)
def coerce_types(spark, folder):
    return cleaning.coerce_types(table(spark, folder, "part"))


@query("rename_columns", "SELECT p_partkey AS part, p_size AS size, p_brand FROM part")
def rename_columns(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand")
    return cleaning.rename_columns(part, {"p_partkey": "part", "p_size": "size"})


@query("select_columns", "SELECT p_partkey, p_brand FROM part")
def select_columns(spark, folder):
    return cleaning.select_columns(table(spark, folder, "part"), ["p_partkey", "p_brand"])


@query("filter_rows", "SELECT p_partkey, p_size FROM part WHERE p_size > 10 AND p_brand LIKE 'Brand#1%'")
def filter_rows(spark, folder):
    part = table(spark, folder, "part")
    kept = cleaning.filter_rows(part, "p_size > 10 AND p_brand LIKE 'Brand#1%'")
    return kept.select("p_partkey", "p_size")


@query(
    "map_augment",
    "SELECT p_partkey, p_size, p_size * 2 AS twice, upper(p_brand) AS label, p_brand FROM part",
)
def map_augment(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand")
    new = {"twice": F.col("p_size") * 2, "label": F.upper("p_brand")}
    return cleaning.map_augment(part, new)


@query("map_replace", "SELECT p_size % 10 AS digit, length(p_name) AS n FROM part")
def map_replace(spark, folder):
    new = {"digit": F.col("p_size") % 10, "n": F.length("p_name").cast("long")}
    return cleaning.map_replace(table(spark, folder, "part"), new)


@query(
    "bin_column",
    """
SELECT p_partkey, p_size,
       CASE WHEN p_size >= 5 AND p_size <= 15 THEN '[5, 15]' WHEN p_size > 15 AND p_size <= 30 THEN '(15, 30]'
            WHEN p_size > 30 AND p_size <= 45 THEN '(30, 45]' END AS right_bin,
       CASE WHEN p_size >= 5 AND p_size < 15 THEN 'a' WHEN p_size >= 15 AND p_size < 30 THEN 'b'
            WHEN p_size >= 30 AND p_size < 45 THEN 'a' END AS left_bin
FROM part""",
)
def bin_column(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    out = cleaning.bin_column(part, "p_size", Bins((5, 15, 30, 45)), "right_bin")
    left = Bins((5, 15, 30, 45), ("a", "b", "a"), right=False, closed_ends=False)
    return cleaning.bin_column(out, "p_size", left, "left_bin")


@query(
    "replace_null_nan",
    D
    + """ SELECT event_id, coalesce(kind, 'none') AS kind, coalesce(who, 0) AS who,
       CASE WHEN v IS NULL OR isnan(v) THEN -1.0::DOUBLE ELSE v END AS v FROM d""",
)
def replace_null_nan(spark, folder):
    df = dirty(spark, folder).select("event_id", "v", "kind", "who")
    out = cleaning.replace_null_nan(df, {"v": -1.0, "kind": "none"})
    return cleaning.replace_null_nan(out)


@query(
    "replace_infinity",
    D
    + """ SELECT event_id, CASE WHEN v = CAST('Infinity' AS DOUBLE) THEN 200.0::DOUBLE
       WHEN v = CAST('-Infinity' AS DOUBLE) THEN -5.0::DOUBLE ELSE v END AS v FROM d""",
)
def replace_infinity(spark, folder):
    return cleaning.replace_infinity(dirty(spark, folder).select("event_id", "v"), {"v": (-5.0, 200.0)})


@query("drop_null_nan", D + " SELECT event_id, kind, v FROM d WHERE v IS NOT NULL AND NOT isnan(v)")
def drop_null_nan(spark, folder):
    return cleaning.drop_null_nan(dirty(spark, folder).select("event_id", "kind", "v"), ["v"])


@query("drop_infinity", D + " SELECT event_id, v FROM d WHERE v IS NULL OR NOT isinf(v)")
def drop_infinity(spark, folder):
    return cleaning.drop_infinity(dirty(spark, folder).select("event_id", "v"), ["v"])


@query("clamp_measure", "SELECT event_id, CASE WHEN value < 10 THEN 10.0::DOUBLE WHEN value > 90 THEN 90.0::DOUBLE ELSE value END AS v FROM events")
def clamp_measure(spark, folder):
    value = cleaning.clamp_measure(F.col("value"), 10.0, 90.0)
    return table(spark, folder, "events").select("event_id", value.alias("v"))


@query(
    "prepare_geo",
    """SELECT o_orderkey AS "MAFID", '1' AS "USA", lpad(CAST(c_nationkey AS STRING), 2, '0') AS "STATE"
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 25 <> 0""",
)
def prepare_geo(spark, folder):
    from tabguard.demos.standin import GEO

    return cleaning.prepare_geo(derived(spark, folder, GEO))


BLANKS = "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '   ' WHEN p_size % 3 = 1 THEN '' ELSE p_brand END AS b FROM {part}"


@query(
    "blank_to_sentinel",
    f"SELECT p_partkey, CASE WHEN length(b) > 0 AND trim(b) = '' THEN 'Null' ELSE b END AS b FROM ({oracle_text(BLANKS)})",
)
def blank_to_sentinel(spark, folder):
    return cleaning.blank_to_sentinel(derived(spark, folder, BLANKS), ["b"], "Null")


@query(
    "recode_columns",
    """SELECT p_partkey, p_size, CASE WHEN p_size < 10 THEN 'S' ELSE 'L' END AS cls,
       concat(CASE WHEN p_size < 10 THEN 'S' ELSE 'L' END, '/', p_brand) AS tag, p_brand FROM part""",
)
def recode_columns(spark, folder):
    rules = [
        "PART[cls]=CASE WHEN PART[p_size] < 10 THEN 'S' ELSE 'L' END",
        "PART[tag]=concat(PART[cls], '/', PART[p_brand])",
        "OTHER[x]=1",
    ]
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand")
    return cleaning.recode_columns(part, "PART", rules)


DOMAINS = [
    Range("l_quantity", 0, 51, 3),
    Splits("l_linenumber", (1, 2, 4, 7)),
    Categories("l_returnflag", ("A", "N", "R")),
]
_CODES = """CAST(floor(l_quantity / 17) AS BIGINT) AS l_quantity,
       CAST(CASE WHEN l_linenumber < 2 THEN 0 WHEN l_linenumber < 4 THEN 1 ELSE 2 END AS BIGINT) AS l_linenumber,
       CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS l_returnflag"""


def coded(spark, folder):
    items = table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_quantity", "l_linenumber", "l_returnflag").withColumns(
        code_columns(DOMAINS)
    )


@query("encode_domain", f"SELECT l_orderkey, {_CODES} FROM lineitem")
def encode_domain(spark, folder):
    return coded(spark, folder)


@query(
    "decode_domain",
    f"""SELECT l_orderkey, l_quantity * 17.0::DOUBLE AS q_low, l_quantity * 17.0::DOUBLE + 17 AS q_high,
       CASE l_linenumber WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 2.0 ELSE 4.0 END AS n_low,
       CASE l_linenumber WHEN 0 THEN 2.0::DOUBLE WHEN 1 THEN 4.0 ELSE 7.0 END AS n_high,
       CASE l_returnflag WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS l_returnflag
FROM (SELECT l_orderkey, {_CODES} FROM lineitem)""",
)
def decode_domain(spark, folder):
    out = coded(spark, folder).withColumns(value_columns(DOMAINS))
    return out.select(
        "l_orderkey",
        F.col("l_quantity.low").alias("q_low"),
        F.col("l_quantity.high").alias("q_high"),
        F.col("l_linenumber.low").alias("n_low"),
        F.col("l_linenumber.high").alias("n_high"),
        "l_returnflag",
    )


@query(
    "encode_cell_index",
    f"SELECT l_orderkey, l_quantity * 9 + l_linenumber * 3 + l_returnflag AS cell FROM (SELECT l_orderkey, {_CODES} FROM lineitem)",
)
def encode_cell_index(spark, folder):
    return coded(spark, folder).select("l_orderkey", cell_index(DOMAINS).alias("cell"))


@query(
    "decode_cell_index",
    """SELECT p_partkey, p_partkey % 27 AS cell, (p_partkey % 27) // 9 AS l_quantity,
       ((p_partkey % 27) // 3) % 3 AS l_linenumber, (p_partkey % 27) % 3 AS l_returnflag FROM part""",
)
def decode_cell_index(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", (F.col("p_partkey") % 27).alias("cell"))
    return part.withColumns(cell_codes(F.col("cell"), DOMAINS))


BOUNDED = [Range("p_size", 5, 40), Pattern("p_brand", r"Brand#1\d?")]


@query(
    "out_of_domain_rows",
    """SELECT 'error' AS strategy, p_partkey, p_size, p_brand FROM part
WHERE NOT (p_size >= 5 AND p_size < 40 AND regexp_full_match(p_brand, 'Brand#1[0-9]?'))
UNION ALL SELECT 'remove', p_partkey, p_size, p_brand FROM part
WHERE p_size >= 5 AND p_size < 40 AND regexp_full_match(p_brand, 'Brand#1[0-9]?')
UNION ALL SELECT 'clip', p_partkey, least(greatest(p_size, 5), 40), p_brand FROM part""",
)
def out_of_domain_rows(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_brand")
    out = None
    for strategy in ("error", "remove", "clip"):
        domains = BOUNDED if strategy != "clip" else BOUNDED[:1]
        rows = cleaning.out_of_domain_rows(part, domains, strategy)
        rows = rows.withColumn("strategy", F.lit(strategy))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "flat_map_rows",
    "SELECT p_partkey, unnest(list_slice(string_split(p_name, ' '), 1, 2)) AS word FROM part",
)
def flat_map_rows(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return expand.flat_map_rows(part, F.split("p_name", " "), 2, "word").drop("p_name")


@query(
    "flat_map_grouping",
    """WITH w AS (SELECT unnest(list_slice(string_split(p_name, ' '), 1, 2)) AS word FROM part),
k AS (SELECT DISTINCT word FROM w)
SELECT k.word, count(w.word) AS count FROM k LEFT JOIN w ON k.word = w.word GROUP BY 1""",
)
def flat_map_grouping(spark, folder):
    from tabguard.operators.keys import Keys
    from tabguard.plans.protected import MaxRows, Protected

    part = table(spark, folder, "part").select("p_name")
    words = Protected.load(part, MaxRows(1)).flat_map(F.split("p_name", " "), 2, "word", grouping=True)
    keys = Keys.of_table(expand.flat_map_rows(part, F.split("p_name", " "), 2, "word", augment=False))
    return words.groupby(keys).count().measure.exact()


def orbit(n):
    """n and what follows it: half of an even number, three times an odd one and one more; ends at 1."""
    while n != 1:
        yield n
        n = n // 2 if n % 2 == 0 else 3 * n + 1
    yield 1


_ORBITS = """WITH RECURSIVE o AS (SELECT p_partkey, CAST(p_size AS BIGINT) AS n, 0 AS i FROM part
UNION ALL SELECT p_partkey, CASE WHEN n % 2 = 0 THEN n // 2 ELSE 3 * n + 1 END, i + 1 FROM o WHERE n <> 1)"""


@query(
    "map_function",
    f"""{_ORBITS} SELECT p_partkey, count(*) - 1 AS steps, max(n) AS peak, any_value(g) AS common
FROM o JOIN (SELECT p_partkey, gcd(p_partkey, p_size) AS g FROM part) USING (p_partkey) GROUP BY 1""",
)
def map_function(spark, folder):
    """Loops of unknown length, which no Column expression has."""
    import math

    def follow(row):
        path = list(orbit(row["p_size"]))
        return {"steps": len(path) - 1, "peak": max(path), "common": math.gcd(row["p_partkey"], row["p_size"])}

    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    return rowwise.map_function(part, follow, "steps long, peak long, common long", inputs=["p_partkey", "p_size"]).drop("p_size", "p_name")


@query("flat_map_function", f"{_ORBITS} SELECT p_partkey, CAST(i AS INTEGER) AS place, n FROM o WHERE i < 6")
def flat_map_function(spark, folder):
    def places(row):
        return ({"place": i, "n": n} for i, n in enumerate(orbit(row["p_size"])))

    part = table(spark, folder, "part").select("p_partkey", "p_size")
    return rowwise.flat_map_function(part, places, "place int, n long", 6, inputs=["p_size"]).drop("p_size")


@query(
    "flat_map_function_grouping",
    f"""{_ORBITS}, k AS (SELECT unnest([1, 2, 4, 8, 16, 5, 10, 3]) AS n)
SELECT CAST(k.n AS BIGINT) AS n, count(o.n) AS count FROM k LEFT JOIN (SELECT n FROM o WHERE i < 9) o ON k.n = o.n GROUP BY 1""",
)
def flat_map_function_grouping(spark, folder):
    """A grouping column from a function: one row meets at most nine groups."""
    from tabguard.operators.keys import Keys
    from tabguard.plans.protected import MaxRows, Protected

    sizes = Protected.load(table(spark, folder, "part").select("p_size"), MaxRows(1))
    met = sizes.flat_map_function(lambda row: ({"n": n} for n in orbit(row["p_size"])), "n long", 9, grouping=True)
    return met.groupby(Keys.of_values(spark, {"n": [1, 2, 4, 8, 16, 5, 10, 3]})).count().measure.exact()


@query(
    "unpivot_regions",
    """SELECT o_orderkey AS "MAFID", 'USA' AS "REGION_TYPE", '1' AS "REGION_ID" FROM orders WHERE o_orderkey % 25 <> 0
UNION ALL SELECT o_orderkey, 'STATE', lpad(CAST(c_nationkey AS STRING), 2, '0')
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 25 <> 0""",
)
def unpivot_regions(spark, folder):
    from tabguard.demos.standin import files

    return expand.unpivot_regions(files(spark, folder)[2], "MAFID", ["USA", "STATE"])


@query(
    "explode_iterations",
    """WITH u AS (SELECT o_orderkey AS k, lpad(CAST(o_custkey % 10 + 1 AS STRING), 2, '0') AS race,
  CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS eth FROM orders)
SELECT k, '*' AS "ITERATION_CODE" FROM u
UNION ALL SELECT k, CASE race WHEN '01' THEN 'A' WHEN '02' THEN 'B' WHEN '03' THEN 'C' WHEN '04' THEN 'D'
  WHEN '05' THEN 'E' WHEN '06' THEN 'F' ELSE 'G' END FROM u
UNION ALL SELECT k, 'H' FROM u WHERE eth = 2
UNION ALL SELECT k, 'I' FROM u WHERE eth = 1 AND race = '01'""",
)
def explode_iterations(spark, folder):
    sql = """SELECT o_orderkey AS k, lpad(CAST(o_custkey % 10 + 1 AS STRING), 2, '0') AS race,
  CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS eth FROM {orders}"""
    out = expand.explode_iterations(derived(spark, folder, sql), "race", "eth")
    return out.select("k", "ITERATION_CODE")


@query(
    "explode_cell_hierarchy",
    """WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 3 WHEN l_quantity < 20 THEN 4
  WHEN l_quantity < 40 THEN 6 ELSE 7 END AS leaf FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(unnest([leaf, CASE WHEN leaf < 5 THEN 2 ELSE 5 END, 1]) AS INTEGER) AS cell FROM x""",
)
def explode_cell_hierarchy(spark, folder):
    q = F.col("l_quantity")
    leaf = F.when(q < 10, 3).when(q < 20, 4).when(q < 40, 6).otherwise(7)
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = expand.explode_cell_hierarchy(items, leaf, {3: 2, 4: 2, 6: 5, 7: 5}, 1, "cell")
    return out.drop("l_quantity")


@query(
    "replicate_cells",
    """SELECT o_orderstatus, n, CAST(unnest([1, 2, 3]) AS INTEGER) AS cell
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""",
)
def replicate_cells(spark, folder):
    counts = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return expand.replicate_cells(counts, [1, 2, 3], "cell")
