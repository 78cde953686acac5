"""Region x iteration x cell tabulations, all tables in one pass.

Persons are read once. Running counts along the digest order of a household tell in which person filters
a record is within the cut; the records left are joined to their unit on the same partitioning and counted
per *profile*: state, iteration letters and leaf cells of the tables of a filter. Profiles are few, whatever
the number of persons, and map tasks pre-aggregate them. Only profiles are expanded to regions, iterations
and cells, so the expansion costs nothing at scale.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.functions.rowhash import row_digest
from tabguard.functions.samplers import add_noise, secret_key
from tabguard.operators.expand import (
    EVERYBODY,
    ITERATIONS,
    ethnicity_letter,
    race_letter,
    with_ancestors,
)
from tabguard.operators.limits import keep_first, keep_unique
from tabguard.operators.noise import LABELS, noise_variance
from tabguard.plans.budget import exact
from tabguard.plans.tables import COUNTED, PERSON_UNIVERSES, TABLES, UNIT_UNIVERSES, Table
from tabguard.runtime import small_table

LONG = ["TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", "COUNT"]
"""Columns of the long form that holds all tables."""

_PERSON = ["CENHISP", "CENRACE", "RELSHIP", "QAGE", "RTYPE_PERSON"]
_UNIT = ["HHSPAN", "HHRACE", "TEN", "HHT", "HHT2", "CPLT", "FINAL_POP", "RTYPE_UNIT"]


def first_match(rules: Sequence[tuple[str, int]]) -> Column:
    """Cell of the first rule whose condition holds, or null."""
    out = None
    for condition, cell in rules:
        test = F.expr(condition)
        out = F.when(test, F.lit(cell)) if out is None else out.when(test, F.lit(cell))
    return out


def unit_records(units: DataFrame, geo: DataFrame) -> DataFrame:
    """Units with their state; ``geo`` is the prepared geography (MAFID, USA, STATE)."""
    return units.withColumnRenamed("RTYPE", "RTYPE_UNIT").join(geo.select("MAFID", "STATE"), "MAFID")


@contextmanager
def shared_units(units: DataFrame, geo: DataFrame) -> Iterator[DataFrame]:
    """Unit records kept in memory or on disk while several tables are answered from them.

    Each table prunes other columns, so without this every one would join units and geography again.
    Materialise the answers before leaving the context.
    """
    kept = unit_records(units, geo).persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def person_records(persons: DataFrame, unit_geo: DataFrame, universe: str) -> DataFrame:
    """All persons of a universe with their unit."""
    people = persons.withColumnRenamed("RTYPE", "RTYPE_PERSON").filter(PERSON_UNIVERSES[universe])
    return people.join(unit_geo, "MAFID")


def _marks(conditions: Sequence[str]) -> Column:
    """Bit i for condition i; an unknown condition does not hold."""
    bits = [F.when(F.expr(c), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return reduce(lambda x, y: x + y, bits)


def _has(i: int) -> Column:
    return F.col("__marks").bitwiseAND(1 << i) != 0


def cut_persons(
    persons: DataFrame, cuts: Sequence[tuple[str, int]], digest_columns: Sequence[str] | None = None
) -> DataFrame:
    """Persons within at least one of the cuts (universe, tau), all in one pass.

    Column ``__cut<i>`` tells whether the record is among the first tau records of its household in the
    universe of cut i. Households are bounded before they meet in one task: of records that hold the same
    filters no more than the largest tau can be wanted, and map tasks cut to that.
    """
    people = persons.withColumnRenamed("RTYPE", "RTYPE_PERSON")
    columns = list(digest_columns or people.columns)
    universes = list(dict.fromkeys(u for u, _ in cuts))
    marked = (
        people.withColumn("__marks", _marks([PERSON_UNIVERSES[u] for u in universes]))
        .filter("__marks > 0")
        .withColumn("__digest", row_digest(columns))
    )
    order = [F.col("__digest"), *[F.col(c).asc_nulls_first() for c in columns]]
    alike = ["MAFID"] if len(universes) == 1 else ["MAFID", "__marks"]
    bounded = keep_first(marked, alike, max(tau for _, tau in cuts), order)
    so_far = Window.partitionBy("MAFID").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    places = {f"__place{i}": F.count_if(_has(i)).over(so_far) for i in range(len(universes))}
    within = {}
    for i, (universe, tau) in enumerate(cuts):
        at = universes.index(universe)
        within[f"__cut{i}"] = _has(at) & (F.col(f"__place{at}") <= tau)
    kept = bounded.withColumns(places).withColumns(within)
    return kept.filter(reduce(lambda x, y: x | y, [F.col(c) for c in within])).drop("__marks", "__digest", *places)


def unique_units(unit_geo: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Units that are the only ones of their key under at least one filter, which ``__unique<i>`` tells."""
    if len(filters) == 1:
        return keep_unique(unit_geo.filter(filters[0]), ["MAFID"]).withColumn("__unique0", F.lit(True))
    marked = unit_geo.withColumn("__marks", _marks(filters)).filter("__marks > 0")
    # Two units that hold the same filters prove that the key repeats under each of these.
    proof = keep_first(marked, ["MAFID", "__marks"], 2, [F.col("MAFID")])
    by_key = Window.partitionBy("MAFID")
    counts = {f"__n{i}": F.count_if(_has(i)).over(by_key) for i in range(len(filters))}
    only = {f"__unique{i}": _has(i) & (F.col(f"__n{i}") == 1) for i in range(len(filters))}
    kept = proof.withColumns(counts).withColumns(only)
    return kept.filter(reduce(lambda x, y: x | y, [F.col(c) for c in only])).drop("__marks", *counts)


def _profile_columns(tables: Sequence[Table], full: bool) -> dict[str, Column]:
    """Iteration letters and leaf cells a record counts in: short scalar keys, cheap to group by."""
    out: dict[str, Column] = {}
    for t in tables:
        if t.race is not None:
            race, ethnicity = F.col(t.race), F.col(t.ethnicity)
            out[f"race_{t.race}"] = race_letter(race, strict=not full)
            out[f"ethnicity_{t.race}"] = ethnicity_letter(race, ethnicity)
        out[f"leaf_{t.name}"] = _leaf(t, full)
    return out


def _letters(t: Table, race: str, ethnicity: str) -> list[Column]:
    """Iteration letters of a profile in one table: everybody, and its race and ethnicity where the table has them."""
    return [F.lit(EVERYBODY)] if t.race is None else [F.lit(EVERYBODY), F.col(race), F.col(ethnicity)]


def _leaf(t: Table, full: bool) -> Column:
    """Leaf cell of a record; in the exact tables also the cell of those that only reach a subtotal."""
    if full:
        return F.when(F.expr(t.exact_filter), first_match([*t.leaves, *t.fallbacks]))
    return first_match(t.leaves)


def _entries(t: Table, full: bool, leaf: Column, letters: Sequence[Column]) -> Column:
    """Array of (table, iterations, cell) a profile counts in; null without a leaf cell."""
    if not full:
        cells = F.array(leaf)
    elif t.leaf_cells == [1]:
        # A table without cells of its own repeats its count under the cells of its numerator.
        cells = F.array(F.lit(1), F.lit(2), F.lit(3))
    else:
        # A record that only reaches the total must not count there twice.
        cells = F.array_distinct(with_ancestors(leaf, t.parents, 1))
    iterations = F.array_compact(F.array(*letters))
    listed = F.transform(
        cells,
        lambda cell: F.struct(
            F.lit(t.name).alias("TABLE"), iterations.alias("its"), cell.alias("DATA_CELL")
        ),
    )
    return F.when(leaf.isNotNull(), listed)


def _count_profiles(
    records: DataFrame, tables: Sequence[Table], full: bool, amount: Column | None = None
) -> DataFrame:
    """Long-form counts of the tables that share these records."""
    profile = _profile_columns(tables, full)
    measured = [] if amount is None else [amount.alias("__amount")]
    total = F.count(F.lit(1)) if amount is None else F.sum("__amount")
    groups = (
        records.select("STATE", *[c.alias(n) for n, c in profile.items()], *measured)
        .groupBy("STATE", *profile)
        .agg(total.alias("__n"))
    )
    listed = [
        _entries(t, full, F.col(f"leaf_{t.name}"), _letters(t, f"race_{t.race}", f"ethnicity_{t.race}"))
        for t in tables
    ]
    entries = F.flatten(F.array_compact(F.array(*listed)))
    return _long(groups.select(_regions().alias("__regions"), F.explode(entries).alias("e"), "__n"))


def _regions() -> Column:
    return F.array(
        F.struct(F.lit("USA").alias("REGION_TYPE"), F.lit("1").alias("REGION_ID")),
        F.struct(F.lit("STATE").alias("REGION_TYPE"), F.col("STATE").alias("REGION_ID")),
    )


def _long(listed: DataFrame) -> DataFrame:
    """Profiles with their regions and entries (table, iterations, cell), spread out and summed."""
    spread = (
        listed.select("e.TABLE", "e.DATA_CELL", F.explode("e.its").alias("ITERATION_CODE"), "__regions", "__n")
        .select("TABLE", "DATA_CELL", "ITERATION_CODE", "__n", F.inline("__regions"))
    )
    return (
        spread.groupBy("TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL")
        .agg(F.sum("__n").alias("COUNT"))
        .select(*LONG)
    )


def _count_together(
    records: DataFrame, groups: Sequence[tuple[Column, Sequence[Table]]], full: bool = False
) -> DataFrame:
    """Long-form counts of several groups of tables over the same records, each group under its own condition.

    A record becomes one short row per group it belongs to: group, letters and leaf cells.
    """
    width = max(len(tables) for _, tables in groups)
    parts = []
    for i, (condition, tables) in enumerate(groups):
        race = next((t for t in tables if t.race is not None), None)
        letters = [F.lit(None).cast("string")] * 2
        if race is not None:
            letters = [
                race_letter(F.col(race.race), strict=not full),
                ethnicity_letter(F.col(race.race), F.col(race.ethnicity)),
            ]
        leaves = [_leaf(t, full) for t in tables] + [F.lit(None).cast("int")] * (width - len(tables))
        fields = [F.lit(i).alias("__group"), letters[0].alias("__race"), letters[1].alias("__ethnicity")]
        fields += [leaf.alias(f"__leaf{k}") for k, leaf in enumerate(leaves)]
        parts.append(F.when(condition, F.struct(*fields)))
    keys = ["STATE", "__group", "__race", "__ethnicity", *[f"__leaf{k}" for k in range(width)]]
    rows = records.select("STATE", F.explode(F.array_compact(F.array(*parts))).alias("g")).select("STATE", "g.*")
    profiles = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    listed = [
        F.when(F.col("__group") == i, _entries(t, full, F.col(f"__leaf{k}"), _letters(t, "__race", "__ethnicity")))
        for i, (_, tables) in enumerate(groups)
        for k, t in enumerate(tables)
    ]
    entries = F.flatten(F.array_compact(F.array(*listed)))
    return _long(profiles.select(_regions().alias("__regions"), F.explode(entries).alias("e"), "__n"))


def sum_counts(frames: Sequence[DataFrame]) -> DataFrame:
    """Long-form counts of disjoint sets of households, added up."""
    if len(frames) == 1:
        return frames[0]
    return _stack(frames).groupBy(*LONG[:-1]).agg(F.sum("COUNT").alias("COUNT")).select(*LONG)


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def exact_tabulations(
    persons: DataFrame,
    units: DataFrame,
    geo: DataFrame,
    names: Sequence[str] | None = None,
    unit_geo: DataFrame | None = None,
) -> DataFrame:
    """True counts in long form, subtotals and totals included, empty groups absent; persons are read once.

    ``geo`` is the prepared geography, ``unit_geo`` the records of ``shared_units`` if kept.
    """
    wanted = [TABLES[n] for n in (names or TABLES)]
    unit_geo = unit_records(units, geo) if unit_geo is None else unit_geo
    frames = []
    of_persons = [_as_counted(t) for t in wanted if t.universe in PERSON_UNIVERSES]
    universes = list(dict.fromkeys(t.universe for t in of_persons))
    if len(universes) == 1:
        frames.append(_count_profiles(person_records(persons, unit_geo, universes[0]), of_persons, full=True))
    elif universes:
        # Persons are read and joined once; the filters are tested before the join and kept as bits.
        people = persons.withColumnRenamed("RTYPE", "RTYPE_PERSON")
        marked = people.withColumn("__marks", _marks([PERSON_UNIVERSES[u] for u in universes])).filter("__marks > 0")
        shared: dict[tuple, list[Table]] = {}
        for t in of_persons:
            shared.setdefault((universes.index(t.universe), t.race or "HHRACE"), []).append(t)
        groups = [(_has(i), tables) for (i, _), tables in shared.items()]
        frames.append(_count_together(marked.join(unit_geo, "MAFID"), groups, full=True))
    for universe, condition in UNIT_UNIVERSES.items():
        tables = [t for t in wanted if t.universe == universe and t.name != "PH8_num"]
        records = unit_geo.filter(condition)
        if tables:
            frames.append(_count_profiles(records, tables, full=True))
        people = [t for t in wanted if t.universe == universe and t.name == "PH8_num"]
        if people:
            frames.append(_count_profiles(records, people, full=True, amount=F.col("FINAL_POP")))
    return _stack(frames)


def _as_counted(t: Table) -> Table:
    from dataclasses import replace

    source = TABLES[t.derived_from] if t.derived_from else t
    return replace(source, name=t.name, cell=t.cell)


def leaf_counts(
    persons: DataFrame,
    units: DataFrame,
    geo: DataFrame,
    taus: Mapping[str, int],
    names: Sequence[str] | None = None,
    digest_columns: Sequence[str] | None = None,
    unit_geo: DataFrame | None = None,
) -> DataFrame:
    """Truncated leaf counts in long form for the counted tables, before keys and noise."""
    wanted = [TABLES[n] for n in (names or COUNTED)]
    unit_geo = unit_records(units, geo) if unit_geo is None else unit_geo
    frames = []
    of_persons = [t for t in wanted if not t.of_units]
    if of_persons:
        cuts = list(dict.fromkeys((t.universe, taus[t.name]) for t in of_persons))
        filters = list(dict.fromkeys(t.unit_filter for t in of_persons))
        shared: dict[tuple, list[Table]] = {}
        for t in of_persons:
            place = (cuts.index((t.universe, taus[t.name])), filters.index(t.unit_filter))
            shared.setdefault((*place, t.race or "HHRACE"), []).append(t)
        people = cut_persons(persons, cuts, digest_columns)
        records = people.join(unique_units(unit_geo, filters), "MAFID")
        groups = [
            (F.col(f"__cut{cut}") & F.col(f"__unique{unit}"), tables)
            for (cut, unit, _), tables in shared.items()
        ]
        frames.append(_count_together(records, groups))
    for universe, condition in UNIT_UNIVERSES.items():
        tables = [t for t in wanted if t.universe == universe]
        if tables:
            frames.append(_count_profiles(unit_geo.filter(condition), tables, full=False))
    return _stack(frames)


def budget_rows(
    spark, budgets: Mapping[str, Mapping[str, object]], taus: Mapping[str, int], definition: str
) -> DataFrame:
    """One row per table, region type and iteration with a budget above zero and its noise parameter.

    ``budgets`` maps table -> ``<region>_<iterations>`` -> amount. The table has at most 3 x 2 rows per
    counted table.
    """
    if definition not in ("pure", "concentrated"):
        raise ValueError("the privacy definition is 'pure' or 'concentrated'")
    rows = []
    for name in COUNTED:
        for label, amount in budgets.get(name, {}).items():
            amount = exact(amount)
            if amount == 0:
                continue
            region, level = label.split("_", 1)
            reach = 2 if TABLES[name].of_units else 2 * taus[name] + 2
            if amount == float("inf"):
                parameter = exact(0)
            elif definition == "pure":
                parameter = reach / amount
            else:
                parameter = reach * reach / (2 * amount)
            for code in ITERATIONS[level]:
                rows.append(
                    (
                        name,
                        region.upper(),
                        code,
                        float(amount),
                        str(parameter.numerator),
                        str(parameter.denominator),
                        float(parameter),
                    )
                )
    text, number = pa.string(), pa.float64()
    columns = {"TABLE": text, "REGION_TYPE": text, "ITERATION_CODE": text, "BUDGET": number}
    return small_table(spark, rows, {**columns, "NUM": text, "DEN": text, "PARAMETER": number})


def budgeted_tables(budgets: Mapping[str, Mapping[str, object]]) -> list[str]:
    """Counted tables with a budget above zero anywhere."""
    return [n for n in COUNTED if any(exact(v) != 0 for v in budgets.get(n, {}).values())]


def key_rows(regions: DataFrame, budgets: DataFrame) -> DataFrame:
    """Full key set: regions of ``keys_region_domain`` x budgeted iterations x leaf cells."""
    cells = F.lit(None)
    for name in COUNTED:
        array = F.array(*[F.lit(c) for c in TABLES[name].leaf_cells])
        cells = F.when(F.col("TABLE") == name, array).otherwise(cells)
    listed = budgets.withColumn("DATA_CELL", F.explode(cells))
    return regions.join(listed, "REGION_TYPE")


def private_tabulations(
    persons: DataFrame,
    units: DataFrame,
    geo: DataFrame,
    taus: Mapping[str, int],
    budgets: Mapping[str, Mapping[str, object]],
    definition: str,
    digest_columns: Sequence[str] | None = None,
    seed: int | None = None,
    unit_geo: DataFrame | None = None,
    trials: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Noisy leaf counts of all tables in long form, with NOISE_DISTRIBUTION and VARIANCE.

    ``counts`` are the truncated leaf counts if they are at hand (of stored households).

    Every evaluation of the result gives the same draws; a new call gives new ones. The two derived tables come from
    ``derive_tables``, which must read this result.
    """
    spark = geo.sparkSession
    names = budgeted_tables(budgets)
    if not names:
        raise ValueError("no table has a budget")
    from tabguard.operators.keys import keys_region_domain

    regions = keys_region_domain(geo, "MAFID", ["USA", "STATE"])
    keys = key_rows(regions, budget_rows(spark, budgets, taus, definition))
    if counts is None:
        counts = leaf_counts(persons, units, geo, taus, names, digest_columns, unit_geo)
    on = ["TABLE", "REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL"]
    filled = keys.join(counts, on, "left").withColumn("COUNT", F.coalesce("COUNT", F.lit(0)))
    if trials is not None:
        filled = filled.withColumn("TRIAL", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    numbered = [] if trials is None else ["TRIAL"]
    mechanism = "geometric" if definition == "pure" else "discrete_gaussian"
    noisy = filled
    if any(exact(v) not in (0, float("inf")) for n in names for v in budgets[n].values()):
        drawn = add_noise(F.col("COUNT"), mechanism, F.col("NUM"), F.col("DEN"), on + numbered, "cells", secret_key(seed))
        noisy = filled.withColumn("COUNT", drawn)
    return noisy.select(
        *LONG,
        *numbered,
        F.lit(LABELS[mechanism]).alias("NOISE_DISTRIBUTION"),
        noise_variance(mechanism, F.col("PARAMETER")).alias("VARIANCE"),
    )


def derive_tables(answers: DataFrame) -> DataFrame:
    """PH5_num (a copy of PH4) and PH8_num (PH7 cells 2 and 3 as owner, 4 as renter) from answers."""
    ph5 = answers.filter("TABLE = 'PH4'").withColumn("TABLE", F.lit("PH5_num"))
    owner = F.when(F.col("DATA_CELL").isin(2, 3), F.lit(2)).when(F.col("DATA_CELL") == 4, F.lit(3))
    ph8 = (
        answers.filter("TABLE = 'PH7'")
        .withColumn("DATA_CELL", owner)
        .groupBy("REGION_ID", "REGION_TYPE", "ITERATION_CODE", "DATA_CELL", "NOISE_DISTRIBUTION")
        .agg(F.sum("COUNT").alias("COUNT"), F.sum("VARIANCE").alias("VARIANCE"))
        .withColumn("TABLE", F.lit("PH8_num"))
    )
    return ph5.unionByName(ph8.select(*answers.columns))


def one_table(answers: DataFrame, name: str) -> DataFrame:
    """A single table of the long form under its published column names."""
    t = TABLES[name]
    rows = answers.filter(F.col("TABLE") == name).withColumnRenamed("DATA_CELL", t.cell)
    dropped = ["TABLE"] if t.race is not None else ["TABLE", "ITERATION_CODE"]
    return rows.drop(*dropped)


def stack_answers(answers: Mapping[str, DataFrame]) -> DataFrame:
    """Union of per-level answers; the region column of each becomes REGION_ID, its name REGION_TYPE."""
    return _stack(
        [
            df.withColumnRenamed(level, "REGION_ID").withColumn("REGION_TYPE", F.lit(level))
            for level, df in answers.items()
        ]
    )


def skip_zero_budget(answers: DataFrame, budgets: DataFrame) -> DataFrame:
    """Answers of the tables, region types and iterations with a budget above zero."""
    kept = budgets.filter("BUDGET > 0").select("TABLE", "REGION_TYPE", "ITERATION_CODE")
    return answers.join(kept, ["TABLE", "REGION_TYPE", "ITERATION_CODE"], "left_semi")
