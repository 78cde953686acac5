"""Stand-ins for the household files, derived from the given tables by SQL both engines understand."""

from __future__ import annotations

from tabguard.demos.registry import derived, oracle_text
from tabguard.operators.cleaning import prepare_geo

PERSONS = """
SELECT CASE WHEN l_partkey % 20 = 0 THEN '5' ELSE '3' END AS RTYPE, l_orderkey AS MAFID,
       CAST(l_quantity AS BIGINT) AS QAGE,
       CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS CENHISP,
       lpad(CAST(l_suppkey % 9 + 1 AS STRING), 2, '0') AS CENRACE,
       CAST(20 + l_partkey % 17 AS STRING) AS RELSHIP,
       concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                 CAST(l_linenumber AS STRING)) AS PID
FROM {lineitem}
"""
_UNIT = """
SELECT CASE WHEN o_orderkey % 25 = 0 THEN '4' ELSE '2' END AS RTYPE, o_orderkey AS MAFID,
       CAST(o_orderkey % 7 + 1 AS BIGINT) AS FINAL_POP, CAST(0 AS BIGINT) AS NPF,
       CAST(CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS HHSPAN,
       lpad(CAST(o_custkey % 10 + 1 AS STRING), 2, '0') AS HHRACE,
       CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN '2'
            WHEN o_orderkey % 2 = 0 THEN '3' ELSE '4' END AS TEN,
       CAST(o_orderkey % 8 AS STRING) AS HHT, lpad(CAST(o_custkey % 13 AS STRING), 2, '0') AS HHT2,
       CAST(o_orderkey % 6 AS STRING) AS CPLT
FROM {orders}
"""
UNITS = f"{_UNIT} UNION ALL {_UNIT} WHERE o_orderkey % 50 = 7"
"""One unit in fifty has a second row with the same key."""
GEO = """
SELECT CASE WHEN o_orderkey % 25 = 0 THEN '4' ELSE '2' END AS RTYPE, o_orderkey AS MAFID,
       lpad(CAST(c_nationkey AS STRING), 2, '0') AS TABBLKST
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
CTES = f"""
WITH persons AS ({oracle_text(PERSONS)}), units AS ({oracle_text(UNITS)}),
rawgeo AS ({oracle_text(GEO)}),
geo AS (SELECT MAFID, '1' AS USA, TABBLKST AS STATE FROM rawgeo WHERE RTYPE NOT IN ('4', '5')),
unitgeo AS (SELECT units.*, geo.STATE FROM units JOIN geo ON units.MAFID = geo.MAFID)
"""
DIGEST = ["PID"]


def files(spark, folder):
    """persons, units and prepared geography."""
    persons = derived(spark, folder, PERSONS)
    units = derived(spark, folder, UNITS)
    return persons, units, prepare_geo(derived(spark, folder, GEO))
