"""Joins, contribution bounds and key sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabguard.demos.registry import derived, oracle_text, query, table
from tabguard.operators import joins, limits
from tabguard.operators.keys import Keys
from tabguard.operators.noise import select_groups_private
from tabguard.plans.budget import Approximate
from tabguard.runtime import materialise

SUPPLY = """SELECT s_suppkey, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN CAST(NULL AS INT) ELSE s_nationkey END AS k
FROM {supplier}"""
PLACES = """SELECT CASE WHEN n_nationkey % 5 = 0 THEN CAST(NULL AS INT) ELSE n_nationkey END AS k, n_name AS name, n_regionkey
FROM {nation}"""


@query(
    "join_public",
    f"""SELECT a.k, a.s_suppkey, a.name AS name_left, b.name AS name_right, b.n_regionkey
FROM ({oracle_text(SUPPLY)}) a JOIN ({oracle_text(PLACES)}) b ON a.k IS NOT DISTINCT FROM b.k""",
)
def join_public(spark, folder):
    return joins.join_public(derived(spark, folder, SUPPLY), derived(spark, folder, PLACES), ["k"])


LINES = "SELECT l_orderkey AS k, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM {lineitem}"
_LINE_DIGEST = "md5(concat_ws('|', CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING)))"
LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_linenumber"]
ORDERS = "SELECT o_orderkey AS k, o_custkey, o_orderstatus FROM {orders}"


@query(
    "join_private_drop_excess",
    f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {_LINE_DIGEST}, l_partkey, l_suppkey, l_linenumber) AS rn
  FROM ({oracle_text(LINES)})),
b AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderstatus FROM orders)
SELECT a.k, l_partkey, l_suppkey, l_linenumber, l_returnflag, c AS o_custkey, o_orderstatus
FROM a JOIN b ON a.k = b.k WHERE rn <= 3""",
)
def join_private_drop_excess(spark, folder):
    left, right = derived(spark, folder, LINES), derived(spark, folder, ORDERS)
    cut = joins.DropExcess(3, LINE_COLUMNS)
    return joins.join_private(left, right, cut, joins.DropExcess(1, ["o_custkey"]), ["k"])


@query(
    "join_private_drop_non_unique",
    f"""WITH a AS (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM ({oracle_text(LINES)}))
SELECT a.k, l_partkey, l_suppkey, l_linenumber, l_returnflag, o_custkey, o_orderstatus
FROM a JOIN orders ON a.k = o_orderkey WHERE n = 1""",
)
def join_private_drop_non_unique(spark, folder):
    left, right = derived(spark, folder, LINES), derived(spark, folder, ORDERS)
    return joins.join_private(left, right, joins.DropNonUnique(), joins.DropNonUnique(), ["k"])


BY_USER = "SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY 1, 2"


@query(
    "join_private_ids",
    f"""SELECT e.user_id, e.event_type, e.event_id, s.n FROM events e
JOIN ({oracle_text(BY_USER)}) s ON e.user_id = s.user_id AND e.event_type = s.event_type""",
)
def join_private_ids(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    return joins.join_private_ids(events, derived(spark, folder, BY_USER))


@query("join_fanout_bound", "SELECT max(n) AS max_rows_per_key FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)")
def join_fanout_bound(spark, folder):
    return joins.join_fanout_bound(table(spark, folder, "orders"), ["o_custkey"])


@query(
    "anti_join_keys",
    "SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def anti_join_keys(spark, folder):
    left = derived(spark, folder, "SELECT c_custkey AS k FROM {customer}")
    right = derived(spark, folder, "SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F'")
    return joins.anti_join_keys(left, right, "k")


@query(
    "cross_join_keys",
    """SELECT * FROM (SELECT DISTINCT l_returnflag FROM lineitem) CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders)""",
)
def cross_join_keys(spark, folder):
    flags = Keys.of_table(table(spark, folder, "lineitem").select("l_returnflag"))
    return flags.times(Keys.of_table(table(spark, folder, "orders").select("o_orderstatus"))).df


def events(spark, folder):
    return table(spark, folder, "events").select("event_id", "user_id", "event_type")


_E = "md5(CAST(event_id AS STRING)), event_id"
_G = "md5(event_type), event_type"


@query(
    "limit_rows_per_id",
    f"""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_E}) AS rn
FROM events) WHERE rn <= 5""",
)
def limit_rows_per_id(spark, folder):
    return limits.limit_rows_per_id(events(spark, folder), "user_id", 5, ["event_id"])


@query(
    "limit_groups_per_id",
    f"""SELECT event_id, user_id, event_type FROM (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY {_G}) AS rn
FROM events) WHERE rn <= 2""",
)
def limit_groups_per_id(spark, folder):
    return limits.limit_groups_per_id(events(spark, folder), "user_id", "event_type", 2)


@query(
    "limit_rows_per_group_per_id",
    f"""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {_E}) AS rn
FROM events) WHERE rn <= 3""",
)
def limit_rows_per_group_per_id(spark, folder):
    return limits.limit_rows_per_group_per_id(events(spark, folder), "user_id", "event_type", 3, ["event_id"])


@query(
    "limit_groups_then_rows",
    f"""SELECT event_id, user_id, event_type FROM (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY {_G}) AS g,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY {_E}) AS rn FROM events) WHERE g <= 2 AND rn <= 3""",
)
def limit_groups_then_rows(spark, folder):
    return limits.limit_groups_then_rows(events(spark, folder), "user_id", "event_type", 2, 3, ["event_id"])


@query(
    "keys_from_values",
    """WITH k AS (SELECT unnest(['F', 'O', 'X']) AS o_orderstatus)
SELECT k.o_orderstatus, f.o_orderpriority, count(o.o_orderkey) AS count FROM k
CROSS JOIN (SELECT unnest(['1-URGENT', '5-LOW']) AS o_orderpriority) f
LEFT JOIN orders o ON o.o_orderstatus = k.o_orderstatus AND o.o_orderpriority = f.o_orderpriority GROUP BY 1, 2""",
)
def keys_from_values(spark, folder):
    from tabguard.operators.aggregates import agg_count

    values = {"o_orderstatus": ["F", "O", "X", "F"], "o_orderpriority": ["1-URGENT", "5-LOW"]}
    return agg_count(table(spark, folder, "orders"), Keys.of_values(spark, values)).exact()


USER_KEYS = "SELECT event_type, user_id % 10 AS bucket FROM {events}"


@query("keys_from_table", f"SELECT DISTINCT * FROM ({oracle_text(USER_KEYS)})")
def keys_from_table(spark, folder):
    return Keys.of_table(derived(spark, folder, USER_KEYS)).df


@query("keys_filter", f"SELECT DISTINCT * FROM ({oracle_text(USER_KEYS)}) WHERE bucket > 4")
def keys_filter(spark, folder):
    return Keys.of_table(derived(spark, folder, USER_KEYS)).filter("bucket > 4").df


@query("keys_project", f"SELECT DISTINCT bucket FROM ({oracle_text(USER_KEYS)})")
def keys_project(spark, folder):
    return Keys.of_table(derived(spark, folder, USER_KEYS)).project("bucket").df


@query(
    "keys_equal",
    f"""WITH k AS (SELECT DISTINCT * FROM ({oracle_text(USER_KEYS)})), p AS (SELECT DISTINCT * FROM k WHERE bucket > 0)
SELECT 'itself' AS other, NOT EXISTS (SELECT * FROM k EXCEPT SELECT * FROM k) AS equal
UNION ALL SELECT 'part', NOT EXISTS (SELECT * FROM k EXCEPT SELECT * FROM p)""",
)
def keys_equal(spark, folder):
    keys = Keys.of_table(derived(spark, folder, USER_KEYS))
    same = Keys(keys.df.select("bucket", "event_type"))
    a = keys.equality(same).withColumn("other", F.lit("itself"))
    return a.unionByName(keys.equality(keys.filter("bucket > 0")).withColumn("other", F.lit("part")))


@query(
    "keys_region_domain",
    """SELECT DISTINCT 'STATE' AS "REGION_TYPE", lpad(CAST(c_nationkey AS STRING), 2, '0') AS "REGION_ID"
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 25 <> 0
UNION ALL SELECT 'USA', '1' WHERE EXISTS (SELECT * FROM orders WHERE o_orderkey % 25 <> 0)""",
)
def keys_region_domain(spark, folder):
    from tabguard.demos.standin import files
    from tabguard.operators.keys import keys_region_domain as domain

    return domain(files(spark, folder)[2], "MAFID", ["USA", "STATE"])


@query("select_groups_private", f"SELECT DISTINCT * FROM ({oracle_text(USER_KEYS)})")
def select_groups_at_infinite_budget(spark, folder):
    df = derived(spark, folder, USER_KEYS)
    return select_groups_private(df, ["event_type", "bucket"], Approximate(float("inf"), 0))


def named_beside_counts(counts, named, columns, certain):
    """Groups with their count ``n``; implausible are large ones that were not named and named ones without rows."""
    both = counts.join(named.withColumn("named", F.lit(True)), columns, "full")
    sure = F.when(F.col("n").isNull(), False).when(F.col("n") >= certain, F.coalesce("named", F.lit(False))).otherwise(True)
    return both.select(*columns, "n", sure.alias("plausible"))


@query(
    "select_groups_private_noisy",
    f"SELECT event_type, bucket, count(*) AS n, true AS plausible FROM ({oracle_text(USER_KEYS)}) GROUP BY 1, 2",
)
def select_groups_noisy(spark, folder):
    """Threshold 13 and scale 1: a group of 80 rows is named beyond chance."""
    df = derived(spark, folder, USER_KEYS)
    columns = ["event_type", "bucket"]
    named = materialise(select_groups_private(df, columns, Approximate(1, "0.00001")))
    return named_beside_counts(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), named, columns, 80)
