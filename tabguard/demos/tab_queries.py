"""The eleven tables on stand-in household files: truncated leaf counts on full key sets, and true counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabguard.demos.registry import query, table
from tabguard.demos.standin import CTES, DIGEST, files
from tabguard.plans import stored
from tabguard.plans import tabulate as tab
from tabguard.plans.tables import COUNTED, TABLES, WITH_TAU
from tabguard.runtime import materialise

TAUS = {"PH1_num": 3, "PH2": 3, "PH3": 2, "PH4": 3, "PH6": 2, "PH7": 3}
INFINITE = float("inf")


def budgets(value, names=COUNTED):
    out = {}
    for n in names:
        levels = ["*"] if TABLES[n].race is None else ["A-G", "H,I", "*"]
        out[n] = {f"{r}_{level}": value for r in ("usa", "state") for level in levels}
    return out


# The oracles spell every rule out again, independently of the rule tables of the package.
_FAMILY = "relship IN ('20','21','23','25','26','27','28','29','30','31','32','33')"
_CHILD = "relship IN ('25','26','27')"
_HOUSEHOLD = "u.rtype = '2' AND u.hht <> '0'"
_AGE = "CASE WHEN qage < 18 THEN 2 WHEN qage >= 18 THEN 3 END"
_SPEC = {
    "PH1_num": ("p.rtype = '3'", _AGE, {}, True, [2, 3]),
    "PH2": (
        "p.rtype = '3'",
        """CASE WHEN hht2 IN ('01','02') THEN CASE cplt WHEN '1' THEN 3 WHEN '2' THEN 4 END
           WHEN hht2 IN ('03','04') THEN CASE cplt WHEN '3' THEN 6 WHEN '4' THEN 7 END
           WHEN hht2 = '09' THEN 9 WHEN hht2 IN ('10','11','12') THEN 10
           WHEN hht2 = '05' THEN 12 WHEN hht2 IN ('06','07','08') THEN 13 END""",
        {2: "cell IN (3,4) OR (cell IS NULL AND hht2 IN ('01','02'))", 5: "cell IN (6,7) OR (cell IS NULL AND hht2 IN ('03','04'))",
         8: "cell IN (9,10)", 11: "cell IN (12,13)", 1: "true"},
        False,
        [3, 4, 6, 7, 9, 10, 12, 13],
    ),
    "PH3": (
        "p.rtype = '3' AND qage < 18",
        f"""CASE WHEN relship IN ('20','21','22','23','24','34','35','36') THEN 2
           WHEN {_CHILD} THEN CASE hht2 WHEN '01' THEN 4 WHEN '03' THEN 5 WHEN '10' THEN 6 WHEN '06' THEN 7 END
           WHEN relship = '30' THEN 9 WHEN relship IN ('28','29','31','32','33') THEN 10 END""",
        {3: f"{_CHILD}", 8: "cell IN (9,10)", 1: "true"},
        True,
        [2, 4, 5, 6, 7, 9, 10],
    ),
    "PH4": (_FAMILY, _AGE, {1: "true"}, True, [2, 3]),
    "PH6": (
        f"{_CHILD} AND qage < 18",
        """CASE hht2 WHEN '01' THEN 3 WHEN '03' THEN 8 WHEN '10' THEN 13 WHEN '06' THEN 18 END
           + CASE WHEN qage < 4 THEN 0 WHEN qage <= 5 THEN 1 WHEN qage <= 11 THEN 2 ELSE 3 END""",
        {2: "cell BETWEEN 3 AND 6", 7: "cell BETWEEN 8 AND 11", 12: "cell BETWEEN 13 AND 16",
         17: "cell BETWEEN 18 AND 21", 1: "true"},
        False,
        [*range(3, 7), *range(8, 12), *range(13, 17), *range(18, 22)],
    ),
    "PH7": (
        "p.rtype = '3'",
        "CASE ten WHEN '1' THEN 2 WHEN '2' THEN 3 WHEN '3' THEN 4 WHEN '4' THEN 4 END",
        {1: "cell IS NOT NULL"},
        True,
        [2, 3, 4],
    ),
}
_SPEC["PH1_num"] = (*_SPEC["PH1_num"][:2], {1: "cell IS NOT NULL"}, *_SPEC["PH1_num"][3:])
_UNIT_SPEC = {
    "PH1_denom": (_HOUSEHOLD, "1", [1], [1, 2, 3]),
    "PH5_denom": ("u.hht IN ('1','2','3')", "1", [1], [1, 2, 3]),
    "PH8_denom": (_HOUSEHOLD, "CASE WHEN ten IN ('1','2') THEN 2 WHEN ten IN ('3','4') THEN 3 END", [2, 3], None),
}


def _spread(source: str, race: str, eth: str, letters: bool, strict: bool, amount: str) -> str:
    """Counts per region, iteration and cell of ``source`` (columns STATE, race, eth, cell)."""
    parts = [f"SELECT STATE, '*' AS it, cell, {amount} AS amount FROM {source}"]
    if letters:
        other = f"CASE WHEN {race} BETWEEN '07' AND '63' THEN 'G' END" if strict else "'G'"
        single = " ".join(f"WHEN '0{i + 1}' THEN '{c}'" for i, c in enumerate("ABCDEF"))
        parts.append(f"SELECT STATE, CASE {race} {single} ELSE {other} END, cell, {amount} FROM {source}")
        parts.append(f"SELECT STATE, 'H', cell, {amount} FROM {source} WHERE {eth} = 2")
        parts.append(f"SELECT STATE, 'I', cell, {amount} FROM {source} WHERE {eth} = 1 AND {race} = '01'")
    rows = " UNION ALL ".join(parts)
    return f"""SELECT rt, rid, it, cell, CAST(sum(amount) AS BIGINT) AS n FROM (
  SELECT 'USA' AS rt, '1' AS rid, it, cell, amount FROM ({rows}) UNION ALL
  SELECT 'STATE', STATE, it, cell, amount FROM ({rows})) WHERE it IS NOT NULL AND cell IS NOT NULL GROUP BY ALL"""


def _final(counts: str, cell_name: str, letters: bool, cells: list[int] | None) -> str:
    """Name the columns; with ``cells`` fill the whole key set with zeros."""
    iteration = ', c.it AS "ITERATION_CODE"' if letters else ""
    if cells is None:
        return f"""SELECT rid AS "REGION_ID", rt AS "REGION_TYPE"{iteration}, CAST(cell AS INTEGER) AS "{cell_name}",
  n AS "COUNT" FROM ({counts}) c"""
    its = list("*ABCDEFGHI") if letters else ["*"]
    keys = f"""SELECT * FROM (SELECT 'USA' AS rt, '1' AS rid UNION ALL SELECT DISTINCT 'STATE', STATE FROM geo)
  CROSS JOIN (SELECT unnest({its}) AS it) CROSS JOIN (SELECT unnest({cells}) AS cell)"""
    iteration = ', k.it AS "ITERATION_CODE"' if letters else ""
    return f"""SELECT k.rid AS "REGION_ID", k.rt AS "REGION_TYPE"{iteration}, CAST(k.cell AS INTEGER) AS "{cell_name}",
  coalesce(c.n, 0) AS "COUNT" FROM ({keys}) k LEFT JOIN ({counts}) c
  ON k.rt = c.rt AND k.rid = c.rid AND k.it = c.it AND k.cell = c.cell"""


def person_oracle(name: str, exact: bool, cell_name: str | None = None) -> str:
    universe, leaf, parents, letters, cells = _SPEC[name]
    race, eth = ("cenrace", "cenhisp") if name == "PH3" else ("hhrace", "hhspan")
    if exact:
        where = {"PH1_num": _HOUSEHOLD, "PH4": "u.hht IN ('1','2','3')"}.get(name, "true")
        joined = f"""SELECT u.*, p.qage, p.relship, p.cenrace, p.cenhisp, {leaf} AS cell
          FROM persons p JOIN unitgeo u ON p.MAFID = u.MAFID WHERE {universe} AND {where}"""
        ups = "".join(
            f" UNION ALL SELECT * REPLACE ({c} AS cell) FROM leafs WHERE {test}" for c, test in parents.items()
        )
        source = f"(WITH leafs AS ({joined}) SELECT * FROM leafs WHERE cell IS NOT NULL{ups})"
    else:
        unit_where = "WHERE hht <= '3'" if name == "PH4" else ""
        source = f"""(SELECT u.*, p.qage, p.relship, p.cenrace, p.cenhisp, {leaf} AS cell FROM
          (SELECT *, row_number() OVER (PARTITION BY MAFID ORDER BY md5(PID), PID) AS rn FROM persons p WHERE {universe}) p
          JOIN (SELECT * FROM unitgeo {unit_where} QUALIFY count(*) OVER (PARTITION BY MAFID) = 1) u ON p.MAFID = u.MAFID
          WHERE rn <= {TAUS[name]})"""
    counts = _spread(source, race, eth, letters, not exact, "1")
    return CTES + _final(counts, cell_name or TABLES[name].cell, letters, None if exact else cells)


def unit_oracle(name: str, exact: bool) -> str:
    universe, leaf, cells, replicas = _UNIT_SPEC[name]
    base = f"SELECT u.*, {leaf} AS cell FROM unitgeo u WHERE {universe}"
    if exact and replicas:
        base = f"SELECT * REPLACE (unnest({replicas}) AS cell) FROM ({base})"
    elif exact:
        base = f"SELECT * FROM ({base}) UNION ALL SELECT * REPLACE (1 AS cell) FROM ({base}) WHERE cell IS NOT NULL"
    counts = _spread(f"({base})", "hhrace", "hhspan", True, not exact, "1")
    return CTES + _final(counts, TABLES[name].cell, True, None if exact else cells)


def ph8_num_exact_oracle() -> str:
    base = f"SELECT u.*, CASE WHEN ten IN ('1','2') THEN 2 WHEN ten IN ('3','4') THEN 3 END AS cell FROM unitgeo u WHERE {_HOUSEHOLD}"
    base = f"SELECT * FROM ({base}) UNION ALL SELECT * REPLACE (1 AS cell) FROM ({base}) WHERE cell IS NOT NULL"
    counts = _spread(f"({base})", "hhrace", "hhspan", True, False, "final_pop")
    return CTES + _final(counts, "PH8_NUM_DATA_CELL", True, None)


def _private(spark, folder, name):
    persons, units, geo = files(spark, folder)
    plan = budgets(INFINITE, [name])
    return tab.private_tabulations(persons, units, geo, TAUS, plan, "pure", DIGEST)


def _counts_only(df):
    return df.drop("NOISE_DISTRIBUTION", "VARIANCE")


def _register(name: str) -> None:
    t = TABLES[name]
    if t.derived_from is None:
        oracle = unit_oracle(name, False) if t.of_units else person_oracle(name, False)

        @query(f"tab_{name.lower()}", oracle)
        def private(spark, folder):
            return _counts_only(tab.one_table(_private(spark, folder, name), name))

    if name == "PH8_num":
        exact_oracle = ph8_num_exact_oracle()
    elif t.of_units:
        exact_oracle = unit_oracle(name, True)
    else:
        exact_oracle = person_oracle("PH4" if name == "PH5_num" else name, True, t.cell)

    @query(f"tab_{name.lower()}_exact", exact_oracle)
    def exact(spark, folder):
        return tab.one_table(tab.exact_tabulations(*files(spark, folder), [name]), name)


for _name in TABLES:
    _register(_name)


@query("tab_ph5_num", person_oracle("PH4", False, "PH5_NUM_DATA_CELL"))
def ph5_num(spark, folder):
    answers = _private(spark, folder, "PH4")
    return _counts_only(tab.one_table(tab.derive_tables(answers), "PH5_num"))


@query(
    "tab_ph8_num",
    f"""SELECT "REGION_ID", "REGION_TYPE", "ITERATION_CODE", CAST(CASE WHEN cell IN (2, 3) THEN 2 ELSE 3 END AS INTEGER) AS "PH8_NUM_DATA_CELL",
CAST(sum("COUNT") AS BIGINT) AS "COUNT" FROM ({person_oracle('PH7', False, 'cell')}) GROUP BY ALL""",
)
def ph8_num(spark, folder):
    answers = _private(spark, folder, "PH7")
    return _counts_only(tab.one_table(tab.derive_tables(answers), "PH8_num"))


def _all_noisy_oracle() -> str:
    """The whole key set with the stated variances: reach^2 / (2 * 0.5) with reach 2 tau + 2, or 2 for tables of units."""
    parts = []
    for n in [*COUNTED, "PH5_num", "PH8_num"]:
        t, source = TABLES[n], {"PH5_num": "PH4", "PH8_num": "PH7"}.get(n, n)
        variance = 4 if t.of_units and n in COUNTED else (2 * TAUS[source] + 2) ** 2
        if n in COUNTED and t.of_units:
            sql, cell = unit_oracle(n, False), f'"{t.cell}"'
        else:
            sql, cell = person_oracle(source, False, "cell"), "cell"
        it = '"ITERATION_CODE"' if t.race else "'*'"
        base = f"""SELECT '{n}' AS "TABLE", "REGION_ID", "REGION_TYPE", {it} AS "ITERATION_CODE", {{}} AS "DATA_CELL", {{}} AS "VARIANCE",
'Discrete Gaussian' AS "NOISE_DISTRIBUTION", true AS plausible FROM ({sql})"""
        if n == "PH8_num":
            owner, total = "CASE WHEN cell IN (2, 3) THEN 2 ELSE 3 END", f"CASE WHEN cell = 2 THEN {2.0 * variance} ELSE {float(variance)} END::DOUBLE"
            parts.append(base.format(owner, total) + " WHERE cell IN (2, 4)")
        else:
            parts.append(base.format(cell, f"{float(variance)}::DOUBLE"))
    return " UNION ALL ".join(parts)


@query("tab_all_noisy", _all_noisy_oracle())
def all_noisy(spark, folder):
    """All tables under a concentrated budget, the two derived ones included; told by all that chance leaves alone.

    A count below minus twelve deviations is no noise.
    """
    persons, units, geo = files(spark, folder)
    with tab.shared_units(units, geo) as unit_geo:
        answers = materialise(
            tab.private_tabulations(
                persons, units, geo, TAUS, budgets("0.5"), "concentrated", DIGEST, unit_geo=unit_geo
            )
        )
    both = answers.unionByName(tab.derive_tables(answers))
    return both.withColumn("plausible", F.col("COUNT") >= -12 * F.sqrt("VARIANCE")).drop("COUNT")


def _all_cut_oracle() -> str:
    """Truncated leaf counts of every counted table on its key set, stacked in long form."""
    parts = []
    for n in COUNTED:
        t = TABLES[n]
        sql = unit_oracle(n, False) if t.of_units else person_oracle(n, False, "cell")
        cell = f'"{t.cell}"' if t.of_units else "cell"
        it = '"ITERATION_CODE"' if t.race else "'*'"
        parts.append(
            f"""SELECT '{n}' AS "TABLE", "REGION_ID", "REGION_TYPE", {it} AS "ITERATION_CODE", {cell} AS "DATA_CELL", "COUNT" FROM ({sql})"""
        )
    return " UNION ALL ".join(parts)


def reported_oracle() -> str:
    """Truncated counts of all eleven tables on their key sets: the counted ones and the two that follow from them."""
    cut = _all_cut_oracle()
    return f"""WITH cut AS ({cut}) SELECT * FROM cut UNION ALL
    SELECT 'PH5_num', "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", "COUNT" FROM cut WHERE "TABLE" = 'PH4' UNION ALL
    SELECT 'PH8_num', "REGION_ID", "REGION_TYPE", "ITERATION_CODE", CAST(CASE WHEN "DATA_CELL" IN (2, 3) THEN 2 ELSE 3 END AS INTEGER), CAST(sum("COUNT") AS BIGINT)
    FROM cut WHERE "TABLE" = 'PH7' GROUP BY ALL"""


@query("tab_all_cut", _all_cut_oracle())
def all_cut(spark, folder):
    """All counted tables at infinite budget, from one pass over persons."""
    persons, units, geo = files(spark, folder)
    return _counts_only(tab.private_tabulations(persons, units, geo, TAUS, budgets(INFINITE), "pure", DIGEST))


def all_exact_oracle() -> str:
    """True counts of every table, stacked in long form."""
    parts = []
    for n, t in TABLES.items():
        if n == "PH8_num":
            sql, cell = ph8_num_exact_oracle(), f'"{t.cell}"'
        elif t.of_units:
            sql, cell = unit_oracle(n, True), f'"{t.cell}"'
        else:
            sql, cell = person_oracle("PH4" if n == "PH5_num" else n, True, "cell"), "cell"
        it = '"ITERATION_CODE"' if t.race else "'*'"
        parts.append(
            f"""SELECT '{n}' AS "TABLE", "REGION_ID", "REGION_TYPE", {it} AS "ITERATION_CODE", {cell} AS "DATA_CELL", "COUNT" FROM ({sql})"""
        )
    return " UNION ALL ".join(parts)


@query("tab_all_exact", all_exact_oracle())
def all_exact(spark, folder):
    """True counts of all tables in one pass."""
    persons, units, geo = files(spark, folder)
    with tab.shared_units(units, geo) as unit_geo:
        return materialise(tab.exact_tabulations(persons, units, geo, unit_geo=unit_geo))


def _all_stored_oracle() -> str:
    return f"""SELECT 'exact' AS kind, * FROM ({all_exact_oracle()}) UNION ALL SELECT 'cut', * FROM ({_all_cut_oracle()})"""


@query("tab_all_stored", _all_stored_oracle())
def all_stored(spark, folder):
    """Households stored together once; true counts and truncated counts of all tables are both taken from them."""
    persons, units, geo = files(spark, folder)
    households = stored.store_households(persons, units, geo)
    cut = stored.private_stored(households, geo, TAUS, budgets(INFINITE), "pure", DIGEST)
    exact = stored.exact_stored(households).withColumn("kind", F.lit("exact"))
    return materialise(exact.unionByName(_counts_only(cut).withColumn("kind", F.lit("cut"))))


@query(
    "stack_answers",
    """SELECT CAST(count(*) AS BIGINT) AS "COUNT", '1' AS "REGION_ID", 'USA' AS "REGION_TYPE" FROM customer
UNION ALL SELECT count(*), lpad(CAST(c_nationkey AS STRING), 2, '0'), 'STATE' FROM customer GROUP BY 2""",
)
def stack_answers(spark, folder):
    people = table(spark, folder, "customer")
    usa = people.select(F.lit("1").alias("USA")).groupBy("USA").agg(F.count(F.lit(1)).alias("COUNT"))
    state = F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATE")
    states = people.select(state).groupBy("STATE").agg(F.count(F.lit(1)).alias("COUNT"))
    return tab.stack_answers({"USA": usa, "STATE": states})


@query(
    "skip_zero_budget",
    f"""SELECT * FROM (SELECT 'PH7' AS "TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", cell AS "DATA_CELL", "COUNT"
FROM ({person_oracle('PH7', True, 'cell')})) WHERE ("REGION_TYPE" = 'USA' AND "ITERATION_CODE" NOT IN ('H', 'I'))
OR ("REGION_TYPE" = 'STATE' AND "ITERATION_CODE" = '*')""",
)
def skip_zero_budget(spark, folder):
    plan = {"PH7": {"usa_A-G": 1, "usa_H,I": 0, "usa_*": 1, "state_A-G": 0, "state_H,I": 0, "state_*": 2}}
    answers = tab.exact_tabulations(*files(spark, folder), ["PH7"])
    return tab.skip_zero_budget(answers, tab.budget_rows(spark, plan, TAUS, "pure"))


assert set(TAUS) == set(WITH_TAU)
