"""Readers and writers: the given tables rendered as text in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabguard.demos.registry import ORACLES, derived, oracle_text, query, table
from tabguard.demos.report_queries import errors, leaves, reach_sql
from tabguard.demos.standin import DIGEST, files
from tabguard.demos.tab_queries import TAUS, budgets, person_oracle
from tabguard.plans import report, smooth
from tabguard.plans import tabulate as tab
from tabguard.plans.tables import TABLES, WITH_TAU
from tabguard.runtime import materialise, scratch_path
from tabguard.sources import households, sinks, synth, text
from tabguard.sources.layouts import PERSON_FIELDS, UNIT_FIELDS

SUPPLIERS = "SELECT s_suppkey, s_name, lpad(CAST(s_nationkey AS STRING), 2, '0') AS state, s_acctbal FROM {supplier}"
SUPPLIER_SCHEMA = "s_suppkey long, s_name string, state string, s_acctbal double"


def _csv(spark, folder, sql, label, sep=","):
    path = scratch_path(spark, label)
    derived(spark, folder, sql).write.csv(path, header=True, sep=sep)
    return path


def _lines(df, label, *columns, sep):
    path = scratch_path(df.sparkSession, label)
    df.select(F.concat_ws(sep, *columns).alias("value")).write.text(path)
    return path


@query("scan_csv_typed", f"SELECT * FROM ({oracle_text(SUPPLIERS)}) WHERE state IN ('01', '02', '03', '17')")
def scan_csv_typed(spark, folder):
    path = _csv(spark, folder, SUPPLIERS, "csv")
    return text.scan_csv_typed(spark, path, SUPPLIER_SCHEMA, "state", ["01", "02", "03", "17"])


@query(
    "scan_restrict_by_region",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3))""",
)
def scan_restrict_by_region(spark, folder):
    geo = derived(spark, folder, "SELECT c_custkey AS o_custkey FROM {customer} WHERE c_nationkey IN (1, 2, 3)")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return text.scan_restrict_by_region(orders, geo, "o_custkey")


@query("scan_csv_directory", oracle_text(SUPPLIERS))
def scan_csv_directory(spark, folder):
    path = scratch_path(spark, "parts")
    rows = derived(spark, folder, SUPPLIERS)
    rows.repartition(4).write.csv(path, header=True)
    rows.filter("s_suppkey < 0").write.mode("append").csv(path, header=True)
    return text.scan_csv_directory(spark, path, SUPPLIER_SCHEMA)


# A record per order and per line item, in the layout of the edited files. Some hold invalid codes.
UNIT_RECORD = """SELECT CASE WHEN o_orderkey % 25 = 0 THEN '4' ELSE '2' END AS RTYPE,
 CAST(100000001 + o_orderkey AS STRING) AS MAFID,
 CASE WHEN o_orderkey % 97 = 0 THEN '03' ELSE lpad(CAST(o_custkey % 2 + 1 AS STRING), 2, '0') END AS BCUSTATEFP,
 '00001' AS VERSION, lpad(CAST(o_orderkey % 7 + 1 AS STRING), 5, ' ') AS FINAL_POP,
 CASE WHEN o_orderkey % 6 = 0 THEN '   ' ELSE lpad(CAST(15 + o_custkey % 101 AS STRING), 3, ' ') END AS HHLDRAGE,
 CASE WHEN o_orderkey % 6 = 0 THEN ' ' ELSE CAST(o_custkey % 2 + 1 AS STRING) END AS HHSPAN, '1' AS HHLDRACE,
 CASE WHEN o_orderkey % 6 = 0 THEN '  ' ELSE lpad(CAST(o_custkey % 63 + 1 AS STRING), 2, '0') END AS HHRACE,
 CASE WHEN o_orderkey % 101 = 0 THEN '9' ELSE CAST(o_orderkey % 5 AS STRING) END AS TEN, '1' AS TEN_A, '2' AS TEN_R, '0' AS VACS,
 CASE WHEN o_orderkey % 25 = 0 THEN '301' ELSE '   ' END AS QGQTYP, ' ' AS GQSEX,
 lpad(CAST(1000 + o_custkey AS STRING), 22, '0') AS OIDTB, CAST(o_orderkey % 8 AS STRING) AS HHT,
 lpad(CAST(o_custkey % 13 AS STRING), 2, '0') AS HHT2, CAST(o_orderkey % 6 AS STRING) AS CPLT, '0' AS UPART, '0' AS MULTG, '0' AS PAOC,
 CASE WHEN o_orderkey % 103 = 0 THEN 'x1' ELSE ' 1' END AS P18, ' 0' AS P60, ' 0' AS P65, ' 0' AS P75, '0' AS PAC, '1' AS HHSEX
FROM {orders}"""
PERSON_RECORD = """SELECT '3' AS RTYPE, CAST(100000001 + l_orderkey AS STRING) AS MAFID, lpad(CAST(l_linenumber AS STRING), 5, ' ') AS CUF_PNC,
 '01' AS BCUSTATEFP, '00001' AS VERSION, CAST(l_partkey % 2 + 1 AS STRING) AS QSEX, lpad(CAST(CAST(l_quantity AS INT) AS STRING), 3, ' ') AS QAGE,
 CASE WHEN l_partkey % 89 = 0 THEN '19030101' ELSE '19800704' END AS QDB, '07' AS QDOB_MONTH, '04' AS QDOB_DAY, '1980' AS QDOB_YEAR,
 '1000' AS QSPAN, '1' AS QSPANX, CAST(l_suppkey % 2 + 1 AS STRING) AS CENHISP, '1000' AS QRACE1,
 CASE WHEN l_partkey % 3 = 0 THEN '2000' ELSE '    ' END AS QRACE2, '    ' AS QRACE3, '    ' AS QRACE4, '    ' AS QRACE5, '    ' AS QRACE6,
 '    ' AS QRACE7, '    ' AS QRACE8, '1' AS QRACEX, lpad(CAST(l_suppkey % 63 + 1 AS STRING), 2, '0') AS CENRACE, '01' AS RACE2010,
 CASE WHEN l_linenumber = 1 THEN '20' ELSE CAST(21 + l_partkey % 16 AS STRING) END AS RELSHIP, '   ' AS QGQTYP, '0' AS LIVE_ALONE
FROM {lineitem}"""
BLOCKS = """SELECT CAST(1000 + c_custkey AS BIGINT) AS OIDTABBLK, lpad(CAST(c_nationkey AS STRING), 2, '0') AS TABBLKST,
 lpad(CAST(c_custkey % 7 AS STRING), 3, '0') AS TABBLKCOU, lpad(CAST(c_custkey % 31 AS STRING), 6, '0') AS TABTRACTCE, '1001' AS TABBLK,
 '1' AS TABBLKGRPCE, '1' AS REGIONCE, '1' AS DIVISIONCE, lpad(CAST(c_custkey % 11 AS STRING), 5, '0') AS PLACEFP,
 lpad(CAST(c_custkey % 5 AS STRING), 4, '0') AS AIANNHCE FROM {customer} WHERE c_custkey % 40 <> 0"""
_U, _P, _B = (oracle_text(s) for s in (UNIT_RECORD, PERSON_RECORD, BLOCKS))


def _typed_sql(fields, source):
    columns = [
        f'TRY_CAST(trim({f.name}) AS BIGINT) AS "{f.name}"' if f.kind == "long" else f'{f.name} AS "{f.name}"'
        for f in fields
    ]
    return f"SELECT {', '.join(columns)} FROM ({source})"


def damaged(record, fields, sep):
    """SQL for the records as lines (``value``, ``k``), of which some are cut short, empty, or have a field too many."""
    line = f"concat_ws('{sep}', {', '.join(f.name for f in fields)})"
    more = f"WHEN k % 227 = 0 THEN concat(line, '{sep}x')" if sep else ""
    return f"""SELECT CASE WHEN k % 211 = 0 THEN substr(line, 1, 40) WHEN k % 223 = 0 THEN '' {more} ELSE line END AS value, k
    FROM (SELECT {line} AS line, CAST(MAFID AS BIGINT) AS k FROM ({record}) r) l"""


def _is_broken(sep):
    return "k % 211 = 0 OR k % 223 = 0" + (" OR k % 227 = 0" if sep else "")


def _why(fields, piped):
    by_place = f"length(value) || ' characters instead of {sum(f.width for f in fields)}'"
    by_pipe = f"len(string_split(value, '|')) || ' fields instead of {len(fields)}'"
    return f"CASE WHEN {piped} THEN {by_pipe} ELSE {by_place} END"


def _scanned_sql(fields, source, sep):
    """Typed records of the whole lines, and the broken ones with why."""
    lines = damaged(source, fields, sep)
    whole = _typed_sql(fields, f"SELECT * FROM (SELECT *, CAST(MAFID AS BIGINT) AS k FROM ({source})) WHERE NOT ({_is_broken(sep)})")
    nulls = ", ".join("NULL" for _ in fields)
    return f"""SELECT *, CAST(NULL AS VARCHAR) AS "BROKEN_LINE", CAST(NULL AS VARCHAR) AS "REASONS" FROM ({whole})
    UNION ALL SELECT {nulls}, value, {_why(fields, 'true' if sep else 'false')} FROM ({lines}) WHERE {_is_broken(sep)}"""


def record_lines(spark, folder, sql, fields, label, sep=""):
    path = scratch_path(spark, label)
    derived(spark, folder, damaged(sql, fields, sep)).select("value").write.text(path)
    return path


@query("scan_fixed_width_unit", _scanned_sql(UNIT_FIELDS, _U, ""))
def scan_fixed_width_unit(spark, folder):
    path = record_lines(spark, folder, UNIT_RECORD, UNIT_FIELDS, "units")
    return text.scan_fixed_width_unit(spark, path).drop(*text.PLACE)


@query("scan_fixed_width_person", _scanned_sql(PERSON_FIELDS, _P, ""))
def scan_fixed_width_person(spark, folder):
    path = record_lines(spark, folder, PERSON_RECORD, PERSON_FIELDS, "persons")
    return text.scan_fixed_width_person(spark, path).drop(*text.PLACE)


@query("scan_pipe_record", _scanned_sql(UNIT_FIELDS, _U, "|"))
def scan_pipe_record(spark, folder):
    path = record_lines(spark, folder, UNIT_RECORD, UNIT_FIELDS, "pipes", sep="|")
    both = text.quarantine(text.scan_pipe_record(spark, path, UNIT_FIELDS), scratch_path(spark, "quarantine"))
    return both.records.drop(*text.PLACE).unionByName(both.rejects.drop(*text.PLACE), allowMissingColumns=True)


@query(
    "reject_counts",
    f"""SELECT {_why(UNIT_FIELDS, 'true')} AS "REASONS", count(*) AS n_lines FROM ({damaged(_U, UNIT_FIELDS, '|')}) WHERE {_is_broken('|')} GROUP BY 1""",
)
def reject_counts(spark, folder):
    path = record_lines(spark, folder, UNIT_RECORD, UNIT_FIELDS, "pipes", sep="|")
    both = text.quarantine(text.scan_pipe_record(spark, path, UNIT_FIELDS), scratch_path(spark, "quarantine"))
    return text.reject_counts(both.rejects).groupBy("REASONS").agg(F.sum("n_lines").alias("n_lines"))


_GEO_NAMES = "OIDTABBLK TABBLKST TABBLKCOU TABTRACTCE TABBLK TABBLKGRPCE REGIONCE DIVISIONCE PLACEFP AIANNHCE".split()


def _quoted(names, prefix=""):
    return ", ".join(f'{prefix}{n} AS "{n}"' for n in names)


@query("scan_geo_reference", f"SELECT {_quoted(_GEO_NAMES)} FROM ({_B})")
def scan_geo_reference(spark, folder):
    return text.scan_geo_reference(spark, _csv(spark, folder, BLOCKS, "geo", sep="|"))


@query(
    "scan_state_files",
    """SELECT concat(c_custkey, '|', c_name, '|', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS value FROM customer WHERE c_nationkey IN (4, 9, 21)""",
)
def scan_state_files(spark, folder):
    people = table(spark, folder, "customer")
    state = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    path = scratch_path(spark, "states")
    lines = people.select(F.concat_ws("|", "c_custkey", "c_name", state).alias("value"), state.alias("s"))
    lines.write.partitionBy("s").text(path)
    return text.scan_state_files(spark, f"{path}/", "s=%s", ["04", "09", "21"]).select("value")


@query(
    "scan_schema_described",
    "SELECT 'delimiter' AS kind, s_suppkey AS k, s_name AS name, s_acctbal AS balance FROM supplier UNION ALL SELECT 'columns', s_suppkey, s_name, s_acctbal FROM supplier",
)
def scan_schema_described(spark, folder):
    suppliers = table(spark, folder, "supplier")
    V = text.Variable
    parted = _lines(suppliers, "delimited", "s_suppkey", "s_name", "s_acctbal", sep="^")
    by_place = text.scan_schema_described(
        spark.read.text(parted),
        [V("k", "long", 0), V("name", "string", 1), V("balance", "double", 2)],
        "^",
    )
    cut = _lines(
        suppliers, "columns", F.lpad(F.col("s_suppkey").cast("string"), 12, " "), "s_name",
        F.lpad(F.col("s_acctbal").cast("string"), 14, " "), sep="",
    )
    by_column = text.scan_schema_described(
        spark.read.text(cut),
        [V("k", "long", start=1, width=12), V("name", start=13, width=18), V("balance", "double", start=31, width=14)],
    )
    kind = F.lit("delimiter").alias("kind")
    return by_place.select(kind, "*").unionByName(by_column.select(F.lit("columns").alias("kind"), "*"))


def annotated(spark, folder, where, label):
    """Customers as one text file: comment lines, a header, data in key order."""
    path = scratch_path(spark, label)
    rows = derived(
        spark,
        folder,
        f"""SELECT 0 AS o, c_custkey AS k, concat('# note ', CAST(c_custkey AS STRING)) AS value FROM {{customer}} WHERE {where} AND c_custkey % 500 = 3
        UNION ALL SELECT 1, -1, 'key|name' FROM {{region}} WHERE r_regionkey = 0
        UNION ALL SELECT 2, c_custkey, concat(CAST(c_custkey AS STRING), '|', c_name) FROM {{customer}} WHERE {where}""",
    )
    rows.orderBy("o", "k").select("value").write.text(path)
    return text.text_split_annotations(text.numbered_lines(spark, path))


_SPLIT = """SELECT '# note ' || c_custkey AS value, 'comment' AS kind FROM customer WHERE c_custkey % 500 = 3
UNION ALL SELECT 'key|name', 'header' UNION ALL SELECT c_custkey || '|' || c_name, 'data' FROM customer"""


@query("text_split_annotations", _SPLIT)
def text_split_annotations(spark, folder):
    return annotated(spark, folder, "true", "notes").select("value", "kind")


@query(
    "text_concat_annotated",
    """SELECT 1 AS part, '# records: ' || count(*) || ' (combined)' AS value FROM customer
UNION ALL SELECT 2, '#' UNION ALL SELECT 3, '# even note ' || c_custkey FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 500 = 3
UNION ALL SELECT 4, '#' UNION ALL SELECT 5, '# odd note ' || c_custkey FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 500 = 3
UNION ALL SELECT 6, 'key|name' UNION ALL SELECT 7, c_custkey || '|' || c_name FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 8, c_custkey || '|' || c_name FROM customer WHERE c_custkey % 2 = 1""",
)
def text_concat_annotated(spark, folder):
    even = annotated(spark, folder, "c_custkey % 2 = 0", "even")
    odd = annotated(spark, folder, "c_custkey % 2 = 1", "odd")
    return text.text_concat_annotated(even, odd, ("even", "odd")).select("part", "value")


def unit_frame(spark, folder):
    return text.typed_fields(derived(spark, folder, UNIT_RECORD), UNIT_FIELDS)


def person_frame(spark, folder):
    return text.typed_fields(derived(spark, folder, PERSON_RECORD), PERSON_FIELDS)


_UT, _PT = f"({_typed_sql(UNIT_FIELDS, _U)})", f"({_typed_sql(PERSON_FIELDS, _P)})"


@query(
    "household_geo_join",
    f"""SELECT u."RTYPE", u."MAFID", u."OIDTB", {_quoted(_GEO_NAMES, 'b.')} FROM {_UT} u JOIN ({_B}) b ON u."OIDTB" = b.OIDTABBLK""",
)
def household_geo_join(spark, folder):
    return households.household_geo_join(unit_frame(spark, folder), derived(spark, folder, BLOCKS))


_NPF = f"""WITH u AS (SELECT * FROM {_UT}), f AS (SELECT "MAFID" AS k, count(*) AS n FROM {_PT}
 WHERE "RELSHIP" IN ('20','21','23','25','26','27','28','29','30','31','32','33') GROUP BY 1),
h AS (SELECT u.*, CASE WHEN CAST(trim("FINAL_POP") AS INT) >= 2 AND "RTYPE" = '2' AND n > 1 THEN n ELSE 0 END AS "NPF" FROM u LEFT JOIN f ON u."MAFID" = f.k)"""


@query("derive_family_size", _NPF + ' SELECT "MAFID", "NPF" FROM h')
def derive_family_size(spark, folder):
    out = households.derive_family_size(person_frame(spark, folder), unit_frame(spark, folder))
    return out.select("MAFID", "NPF")


@query(
    "normalize_household",
    _NPF
    + """ SELECT "RTYPE", "MAFID", CAST(trim("FINAL_POP") AS BIGINT) AS "FINAL_POP", "NPF", coalesce(TRY_CAST(trim("HHSPAN") AS BIGINT), 0) AS "HHSPAN",
CASE WHEN trim("HHRACE") = '' THEN '00' ELSE "HHRACE" END AS "HHRACE", "TEN", "HHT", "HHT2", "CPLT" FROM h""",
)
def normalize_household(spark, folder):
    sized = households.derive_family_size(person_frame(spark, folder), unit_frame(spark, folder))
    return households.normalize_household(sized)


_RACES = ", ".join(
    f"""CASE WHEN CAST("QRACE{i}" AS STRING) = '    ' THEN 'Null' ELSE CAST("QRACE{i}" AS STRING) END AS "QRACE{i}\"""" for i in range(1, 9)
)
_PLACES = 'TABBLKST AS "TABBLKST", TABBLKCOU AS "TABBLKCOU", TABTRACTCE AS "TABTRACTCE", TABBLK AS "TABBLK"'
_PUG = f"""FROM {_PT} p JOIN {_UT} u ON p."MAFID" = u."MAFID" JOIN ({_B}) b ON u."OIDTB" = b.OIDTABBLK"""


@query(
    "person_geo_view",
    f"""SELECT "QAGE", "QSEX", CASE WHEN "RELSHIP" = '20' THEN 'True' ELSE 'False' END AS "HOUSEHOLDER", {_PLACES}, "CENRACE", {_RACES},
CAST("QSPAN" AS STRING) AS "QSPAN" {_PUG}""",
)
def person_geo_view(spark, folder):
    return households.person_geo_view(
        person_frame(spark, folder), unit_frame(spark, folder), derived(spark, folder, BLOCKS)
    )


@query(
    "household_head_view",
    f"""SELECT {_PLACES}, CASE WHEN trim("HHRACE") = '' THEN 'Null' ELSE "HHRACE" END AS "HHRACE", {_RACES}, CAST("QSPAN" AS STRING) AS "QSPAN",
CAST(CASE "HHT" WHEN '6' THEN '4' WHEN '7' THEN '5' ELSE "HHT" END AS INTEGER) AS "HOUSEHOLD_TYPE", CAST("TEN" AS INTEGER) AS "TEN"
{_PUG} WHERE "RELSHIP" = '20' AND "HHT" <> '0'""",
)
def household_head_view(spark, folder):
    return households.household_head_view(
        person_frame(spark, folder), unit_frame(spark, folder), derived(spark, folder, BLOCKS)
    )


@query(
    "geo_with_units",
    f"""SELECT {_quoted(_GEO_NAMES, 'b.')} FROM (SELECT DISTINCT "OIDTB" FROM {_UT}) u LEFT JOIN ({_B}) b ON u."OIDTB" = b.OIDTABBLK""",
)
def geo_with_units(spark, folder):
    return households.geo_with_units(derived(spark, folder, BLOCKS), unit_frame(spark, folder))


TOTALS = """WITH c AS (SELECT lpad(CAST(c_nationkey AS STRING), 2, '0') AS s, lpad(CAST(c_custkey % 7 AS STRING), 3, '0') AS cc,
 lpad(CAST(c_custkey % 31 AS STRING), 6, '0') AS t, lpad(CAST(c_custkey % 13 AS STRING), 5, '0') AS p, lpad(CAST(c_custkey % 8 AS STRING), 4, '0') AS a FROM {customer})
SELECT '1' AS REGION_ID, 'USA' AS REGION_TYPE, CAST(count(*) AS STRING) AS COUNT FROM c
UNION ALL SELECT s, CASE WHEN s > '15' THEN 'PR-STATE' ELSE 'STATE' END, CAST(count(*) AS STRING) FROM c GROUP BY 1, 2
UNION ALL SELECT concat(s, cc), 'COUNTY', CAST(count(*) AS STRING) FROM c GROUP BY 1
UNION ALL SELECT concat(s, cc, t), 'TRACT', CAST(count(*) AS STRING) FROM c GROUP BY 1
UNION ALL SELECT concat(s, p), 'PLACE', CAST(count(*) AS STRING) FROM c GROUP BY 1
UNION ALL SELECT a, 'AIANNH', CAST(count(*) AS STRING) FROM c GROUP BY 1"""


@query(
    "popgroup_region_filter",
    f"""WITH g AS (SELECT * FROM ({_B}) WHERE TABBLKST IN ('03', '16')), t AS ({oracle_text(TOTALS)}), k AS (SELECT DISTINCT 'STATE' AS kind, TABBLKST AS id FROM g
UNION SELECT 'COUNTY', concat(TABBLKST, TABBLKCOU) FROM g UNION SELECT 'TRACT', concat(TABBLKST, TABBLKCOU, TABTRACTCE) FROM g
UNION SELECT 'PLACE', concat(TABBLKST, PLACEFP) FROM g UNION SELECT 'AIANNH', AIANNHCE FROM g)
SELECT REGION_ID AS "REGION_ID", REGION_TYPE AS "REGION_TYPE", CAST(COUNT AS INTEGER) AS "COUNT" FROM t WHERE REGION_TYPE = 'USA'
OR ((REGION_TYPE = 'AIANNH' OR substr(REGION_ID, 1, 2) IN ('03', '16')) AND EXISTS (SELECT * FROM k WHERE kind = replace(REGION_TYPE, 'PR-', '') AND id = REGION_ID))""",
)
def popgroup_region_filter(spark, folder):
    totals, geo = derived(spark, folder, TOTALS), derived(spark, folder, BLOCKS)
    return households.popgroup_region_filter(totals, geo, ["03", "16"])


def dirty(record, fields, key, step):
    """SQL for the records in which each field in turn holds a text that its rule does not allow."""
    bad = [f"CASE WHEN {key} % {step} = {i} THEN '{'x' * f.width}' ELSE {f.name} END AS {f.name}" for i, f in enumerate(fields, 1)]
    return f"SELECT {', '.join(bad)} FROM ({record}) r"


UNIT_KEY, PERSON_KEY = "CAST(MAFID AS BIGINT)", "(CAST(MAFID AS BIGINT) * 7 + CAST(trim(CUF_PNC) AS BIGINT))"
DIRTY_UNIT = dirty(f"SELECT * FROM ({UNIT_RECORD}) u", UNIT_FIELDS, UNIT_KEY, 401)
DIRTY_PERSON = dirty(f"SELECT * FROM ({PERSON_RECORD}) p", PERSON_FIELDS, PERSON_KEY, 401)


def _broken_of(sep):
    """Whether a record's line is damaged, by its key; a record whose key is spoilt is never damaged."""
    return f"coalesce(k % 211 = 0 OR k % 223 = 0{' OR k % 227 = 0' if sep else ''}, false)"


def _rules_sql(record, fields, sep, shown, own):
    """Names of the failed fields of each record by the rules' own reading in SQL, and the broken lines."""
    dirty_sql = oracle_text(record)
    failed = ", ".join(f"CASE WHEN {f.name} = '{'x' * f.width}'{' OR ' + own[f.name] if f.name in own else ''} THEN '{f.name}' END" for f in fields)
    return f"""WITH r AS ({dirty_sql}), n AS (SELECT *, TRY_CAST(MAFID AS BIGINT) AS k, concat_ws(', ', {failed}) AS fields,
        concat_ws('{sep}', {', '.join(f.name for f in fields)}) AS line FROM r),
    b AS (SELECT CASE WHEN k % 211 = 0 THEN substr(line, 1, 40) WHEN k % 223 = 0 THEN '' ELSE concat(line, '{sep}x') END AS value FROM n WHERE {_broken_of(sep)})
    SELECT {', '.join(f'{c} AS "{c}"' for c in shown)}, fields, CAST(NULL AS VARCHAR) AS "BROKEN_LINE", CAST(NULL AS VARCHAR) AS why FROM n
    WHERE fields <> '' AND NOT {_broken_of(sep)}
    UNION ALL SELECT {', '.join('NULL' for _ in shown)}, '', value, {_why(fields, "contains(value, '|')")} FROM b"""


def _rule_lines(spark, folder, record, fields, label, sep):
    """Damaged lines of the dirty records; a spoilt key damages nothing."""
    line = f"concat_ws('{sep}', {', '.join(f.name for f in fields)})"
    more = f"WHEN k % 227 = 0 THEN concat(line, '{sep}x')" if sep else ""
    sql = f"""SELECT CASE WHEN k % 211 = 0 THEN substr(line, 1, 40) WHEN k % 223 = 0 THEN '' {more} ELSE line END AS value
    FROM (SELECT {line} AS line, TRY_CAST(MAFID AS BIGINT) AS k FROM ({record}) d) l"""
    path = scratch_path(spark, label)
    derived(spark, folder, sql).write.text(path)
    return text.numbered_lines(spark, path)


def _shown_failures(bad, *columns):
    why = F.when(F.col("BROKEN_LINE").isNotNull(), F.col("REASONS")).alias("why")
    return bad.select(*columns, _failed_fields(), "BROKEN_LINE", why)


_UNIT_OWN = {"BCUSTATEFP": "BCUSTATEFP = '03'", "TEN": "TEN = '9'", "P18": "P18 = 'x1'"}


@query("dq_record_rules_unit", _rules_sql(DIRTY_UNIT, UNIT_FIELDS, "", ["MAFID"], _UNIT_OWN))
def dq_record_rules_unit(spark, folder):
    lines = _rule_lines(spark, folder, DIRTY_UNIT, UNIT_FIELDS, "units", "")
    return _shown_failures(text.dq_record_rules_unit(text.cut_records(lines, UNIT_FIELDS)), "MAFID")


def _failed_fields():
    """Names of the failed fields out of the reasons."""
    names = F.regexp_extract_all("REASONS", F.lit(r"(\w+) \([^()]*\) out of range"), F.lit(1))
    return F.concat_ws(", ", names).alias("fields")


@query("dq_record_rules_person", _rules_sql(DIRTY_PERSON, PERSON_FIELDS, "|", ["MAFID", "CUF_PNC"], {"QDB": "QDB < '19040402'"}))
def dq_record_rules_person(spark, folder):
    lines = _rule_lines(spark, folder, DIRTY_PERSON, PERSON_FIELDS, "persons", "|")
    return _shown_failures(text.dq_record_rules_person(text.cut_records(lines, PERSON_FIELDS)), "MAFID", "CUF_PNC")


@query("count_rows_per_file", "SELECT count(*) AS n_rows FROM customer GROUP BY c_nationkey")
def count_rows_per_file(spark, folder):
    path = scratch_path(spark, "files")
    people = table(spark, folder, "customer")
    lines = people.select(F.concat_ws("|", "c_custkey", "c_name").alias("value"), "c_nationkey")
    lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    return text.count_rows_per_file(spark, path).select("n_rows")


@query(
    "synthesize_from_schema",
    """SELECT o_orderkey, true AS rtype_ok, true AS age_ok, true AS income_ok, true AS name_ok, true AS code_ok FROM orders""",
)
def synthesize_from_schema(spark, folder):
    """One random record per order, told by whether each value keeps to its declared range."""
    rows = table(spark, folder, "orders").select("o_orderkey")
    V = synth.Declared
    drawn = synth.synthesize_from_schema(
        rows,
        [
            V("RTYPE", choices=("2", "4")),
            V("AGE", "integer", ranges=((0, 17), (18, 115))),
            V("INCOME", "decimal", ranges=((0, 1), (100, 200))),
            V("NAME", width=8),
            V("CODE", "integer", width=3, prefix="C"),
        ],
        seed=11,
    )
    return drawn.select(
        "o_orderkey",
        F.col("RTYPE").isin("2", "4").alias("rtype_ok"),
        F.col("AGE").between(0, 115).alias("age_ok"),
        (F.col("INCOME").between(0, 1) | F.col("INCOME").between(100, 200)).alias("income_ok"),
        F.col("NAME").rlike("^[A-Z]{8}$").alias("name_ok"),
        F.col("CODE").rlike("^C[0-9]{1,3}$").alias("code_ok"),
    )


_WRITTEN = """SELECT '{0}' AS "TABLE", "REGION_ID", "REGION_TYPE", cell AS "DATA_CELL", "COUNT", 0.0::DOUBLE AS "VARIANCE" FROM ({1})"""


@query(
    "sink_tabulations",
    " UNION ALL ".join(_WRITTEN.format(n, person_oracle(n, False, "cell")) for n in WITH_TAU),
)
def sink_tabulations(spark, folder):
    """All tables of persons at infinite budget, published at once and read back."""
    persons, units, geo = files(spark, folder)
    plan = budgets(float("inf"), WITH_TAU)
    answers = materialise(tab.private_tabulations(persons, units, geo, TAUS, plan, "pure", DIGEST))
    path = scratch_path(spark, "tables")
    sinks.sink_tabulations(answers, path)
    out = None
    for n in WITH_TAU:
        rows = sinks.read_release(spark, path, n).select(
            F.lit(n).alias("TABLE"),
            "REGION_ID",
            "REGION_TYPE",
            F.col(TABLES[n].cell).cast("int").alias("DATA_CELL"),
            F.col("COUNT").cast("long").alias("COUNT"),
            F.col("VARIANCE").cast("double").alias("VARIANCE"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


_REPORT = ORACLES["error_percentile"]


@query(
    "sink_error_report",
    f"""SELECT "TABLE", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", "EXPERIMENTAL_MOE", "COUNT",
CASE WHEN "TABLE" = 'PH8_num' AND "DATA_CELL" = 2 THEN round(sqrt(2) * m, 1) ELSE m END AS "EXPECTED_MOE"
FROM (SELECT *, round(s * ln(20 / (1 + exp(1 / s))), 1) AS m FROM (SELECT *, {reach_sql('"TABLE"')} AS s FROM ({_REPORT})))""",
)
def sink_error_report(spark, folder):
    summary = report.error_percentile(errors(spark, folder))
    path = scratch_path(spark, "report")
    sinks.sink_error_report(report.error_expected_moe(summary, budgets(1), TAUS, "pure"), path)
    schema = (
        "TABLE string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, EXPERIMENTAL_MOE double, "
        "COUNT long, EXPECTED_MOE double"
    )
    back = spark.read.csv(path, header=True, sep="|", schema=_in_file_order(spark, path, schema))
    return back.withColumn("EXPERIMENTAL_MOE", F.round("EXPERIMENTAL_MOE", 6))


def _in_file_order(spark, path, schema):
    """The schema with its columns in the order of the file's header."""
    kinds = dict(part.split(" ") for part in schema.split(", "))
    names = spark.read.csv(path, header=True, sep="|").columns
    return ", ".join(f"{n} {kinds[n]}" for n in names)


@query("sink_estimates", ORACLES["marginal_cells"].replace('round(1.6448536269514722 * sqrt(v), 6) AS "MOE_NOISY"', "'PH3' AS \"TABLE\""))
def sink_estimates(spark, folder):
    """Cells with their margins, written per table and region level and read back."""
    cells = smooth.marginal_cells(leaves(spark, folder, "PH3"), smooth.MARGINS["PH3"]).drop("MOE_NOISY")
    path = scratch_path(spark, "estimates")
    sinks.sink_estimates(cells.withColumn("TABLE", F.lit("PH3")), path)
    back = spark.read.csv(path, header=True, sep="|")
    return back.select(
        "TABLE",
        "GEOID",
        "REGION_TYPE",
        "ITERATION_CODE",
        F.col("DATA_CELL").cast("int").alias("DATA_CELL"),
        F.col("COUNT_NOISY").cast("long").alias("COUNT_NOISY"),
        F.col("VARIANCE").cast("double").alias("VARIANCE"),
    )
