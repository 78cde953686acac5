"""Protected tables: a DataFrame plus the bound on what one individual can change in it.

Every method returns a new table with the bound carried along in plain Python. Nothing here plans or
optimises; the DataFrame calls do the work and Catalyst plans them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabguard.functions.binning import Bins
from tabguard.operators import aggregates as agg
from tabguard.operators import cleaning, expand, joins, limits, rowwise
from tabguard.operators.keys import Keys
from tabguard.operators.noise import Bound, noise_plan, release, release_by, select_groups_private
from tabguard.plans.budget import Approximate, Budget, Concentrated, Ledger, Pure, is_infinite, share
from tabguard.runtime import materialise


@dataclass(frozen=True)
class MaxRows:
    """One individual adds or removes at most ``rows`` rows."""

    rows: int = 1


@dataclass(frozen=True)
class MaxRowsInMaxGroups:
    """At most ``rows`` rows in each of at most ``groups`` values of ``column``."""

    column: str
    groups: int
    rows: int


@dataclass(frozen=True)
class RowsWithId:
    """Any number of rows, all with one identifier of the named id space."""

    column: str
    space: str = "default"


@dataclass(frozen=True)
class Limit:
    """Bound on the rows of an identifier: in all, per value of a column, or on the values themselves."""

    kind: str
    n: int
    column: str | None = None

    def __post_init__(self):
        if self.n < 1:
            raise ValueError("a limit must be at least 1")


def max_rows_per_id(n: int) -> Limit:
    return Limit("rows", n)


def max_groups_per_id(column: str, n: int) -> Limit:
    return Limit("groups", n, column)


def max_rows_per_group_per_id(column: str, n: int) -> Limit:
    return Limit("rows_in_group", n, column)


def _tightest(limits_: Sequence[Limit]) -> tuple[Limit, ...]:
    best: dict[tuple, Limit] = {}
    for item in limits_:
        key = (item.kind, item.column)
        if key not in best or item.n < best[key].n:
            best[key] = item
    return tuple(best.values())


@dataclass(frozen=True)
class Protected:
    """A private table. ``limits`` are promises that hold for tables with an identifier."""

    df: DataFrame
    change: MaxRows | MaxRowsInMaxGroups | RowsWithId
    limits: tuple[Limit, ...] = ()

    @staticmethod
    def load(df: DataFrame, change) -> Protected:
        """Coerce the column types and check the protected column."""
        if isinstance(change, (RowsWithId, MaxRowsInMaxGroups)) and change.column not in df.columns:
            raise ValueError(f"no column {change.column}")
        return Protected(cleaning.coerce_types(df), change)

    @property
    def fixed_column(self) -> str | None:
        """Identifier or grouping column, which no operator may drop or overwrite."""
        return None if isinstance(self.change, MaxRows) else self.change.column

    def _on(self, df: DataFrame, limits_: Sequence[Limit] | None = None, change=None) -> Protected:
        return replace(
            self,
            df=df,
            limits=self.limits if limits_ is None else tuple(limits_),
            change=change or self.change,
        )

    def _guard(self, columns: Sequence[str]) -> None:
        if self.fixed_column in columns:
            raise ValueError(f"{self.fixed_column} protects the table and cannot be changed")

    # Operators that leave every limit in place.

    def filter(self, condition: str) -> Protected:
        return self._on(cleaning.filter_rows(self.df, condition))

    def drop_null_nan(self, columns: Sequence[str] | None = None) -> Protected:
        chosen = columns or [c for c in self.df.columns if c != self.fixed_column]
        self._guard(chosen)
        return self._on(cleaning.drop_null_nan(self.df, chosen))

    def drop_infinity(self, columns: Sequence[str] | None = None) -> Protected:
        return self._on(cleaning.drop_infinity(self.df, columns))

    def with_columns(self, new: Mapping[str, Column]) -> Protected:
        return self._on(cleaning.map_augment(self.df, new))

    def bin_column(self, column: str, bins: Bins, name: str | None = None) -> Protected:
        return self._on(cleaning.bin_column(self.df, column, bins, name))

    def map_replace(self, new: Mapping[str, Column]) -> Protected:
        if self.fixed_column is not None:
            raise ValueError("all columns cannot be replaced in a table with a protected column")
        return self._on(cleaning.map_replace(self.df, new))

    # Operators that change or drop limits.

    def select(self, columns: Sequence[str]) -> Protected:
        if self.fixed_column is not None and self.fixed_column not in columns:
            raise ValueError(f"{self.fixed_column} protects the table and must be kept")
        kept = [x for x in self.limits if x.column is None or x.column in columns]
        return self._on(cleaning.select_columns(self.df, columns), kept)

    def rename(self, names: Mapping[str, str]) -> Protected:
        moved = [replace(x, column=names.get(x.column, x.column)) for x in self.limits]
        change = self.change
        if self.fixed_column in names:
            change = replace(change, column=names[self.fixed_column])
        return self._on(cleaning.rename_columns(self.df, names), moved, change)

    def _after_replacing(self, columns: Sequence[str]) -> list[Limit]:
        return [x for x in self.limits if not (x.kind == "rows_in_group" and x.column in columns)]

    def replace_null_nan(self, values: Mapping[str, Any] | None = None) -> Protected:
        if not values:
            values = {
                f.name: cleaning.default_value(f.dataType)
                for f in self.df.schema.fields
                if f.name != self.fixed_column
            }
        self._guard(list(values))
        return self._on(
            cleaning.replace_null_nan(self.df, values), self._after_replacing(list(values))
        )

    def replace_infinity(self, values: Mapping[str, tuple] | None = None) -> Protected:
        kept = self._after_replacing(list(values or self.df.columns))
        return self._on(cleaning.replace_infinity(self.df, values), kept)

    def flat_map(
        self,
        items: Column,
        max_rows: int,
        name: str | None = None,
        augment: bool = True,
        grouping: bool = False,
    ) -> Protected:
        """Several rows per row. ``grouping`` makes the one new column the grouping column."""
        self._replaceable(augment)
        df = expand.flat_map_rows(self.df, items, max_rows, name, augment)
        return self._expanded(df, max_rows, name if grouping else None, grouping)

    def map_function(self, function, new, augment: bool = True, inputs: Sequence[str] | None = None) -> Protected:
        """Columns from a Python function of a row."""
        self._replaceable(augment)
        df = rowwise.map_function(self.df, function, new, augment, inputs)
        return self._on(df, None if augment else [])

    def flat_map_function(
        self,
        function,
        new,
        max_rows: int | None = None,
        augment: bool = True,
        grouping: bool = False,
        inputs: Sequence[str] | None = None,
    ) -> Protected:
        """Several rows per row from a Python function; only a table with an identifier needs no ``max_rows``."""
        self._replaceable(augment)
        if max_rows is None and not isinstance(self.change, RowsWithId):
            raise ValueError("max_rows bounds what one row can become and is needed here")
        df = rowwise.flat_map_function(self.df, function, new, max_rows, augment, inputs)
        added = df.columns[len(self.df.columns) if augment else 0 :]
        return self._expanded(df, max_rows, added[0] if len(added) == 1 else None, grouping)

    def _replaceable(self, augment: bool) -> None:
        if not augment and self.fixed_column is not None:
            raise ValueError("all columns cannot be replaced in a table with a protected column")

    def _expanded(self, df: DataFrame, max_rows: int | None, name: str | None, grouping: bool) -> Protected:
        change = self.change
        if grouping:
            if name is None or not isinstance(change, MaxRows):
                raise ValueError("a grouping flat map adds one named column to a table without one")
            change = MaxRowsInMaxGroups(name, max_rows * change.rows, 1)
        elif isinstance(change, MaxRows):
            change = MaxRows(change.rows * max_rows)
        elif isinstance(change, MaxRowsInMaxGroups):
            change = replace(change, rows=change.rows * max_rows)
        return self._on(df, [x for x in self.limits if x.kind == "groups"], change)

    def enforce(self, limit: Limit) -> Protected:
        """Cut the rows of each identifier to a limit, chosen by digest."""
        if not isinstance(self.change, RowsWithId):
            raise ValueError("limits per identifier need a table with one")
        return self._on(_cut(self.df, self.change.column, limit), _tightest([*self.limits, limit]))

    def join_public(self, public: DataFrame, on: Sequence[str] | None = None) -> Protected:
        """Natural join with a public table; its largest fan-out multiplies the bound.

        The fan-out is one number computed by an aggregate over the public table.
        """
        public = cleaning.coerce_types(public)
        keys = list(on) if on else joins.shared_columns(self.df, public)
        fanout = joins.join_fanout_bound(public, keys).first()[0]
        clash = set(self.df.columns) & set(public.columns) - set(keys)
        change = self.change
        if isinstance(change, (MaxRows, MaxRowsInMaxGroups)):
            change = replace(change, rows=change.rows * fanout)
        return self._on(
            joins.join_public(self.df, public, keys),
            _through_join(self.limits, max(fanout, 1), clash, "_left"),
            change,
        )

    def join_private(
        self,
        other: Protected,
        left_cut: joins.DropExcess | joins.DropNonUnique | None = None,
        right_cut: joins.DropExcess | joins.DropNonUnique | None = None,
        on: Sequence[str] | None = None,
    ) -> Protected:
        """Join with another private table: cut per key, or by the shared identifier."""
        if isinstance(self.change, RowsWithId) or isinstance(other.change, RowsWithId):
            return self._join_ids(other, on)
        if left_cut is None or right_cut is None:
            raise ValueError("both sides need a truncation")
        if not isinstance(self.change, MaxRows) or not isinstance(other.change, MaxRows):
            raise ValueError("tables with a grouping column cannot be joined")
        rows = join_bound(self.change.rows, other.change.rows, left_cut, right_cut)
        joined = joins.join_private(self.df, other.df, left_cut, right_cut, on)
        return Protected(joined, MaxRows(rows))

    def _join_ids(self, other: Protected, on: Sequence[str] | None) -> Protected:
        if not isinstance(other.change, RowsWithId) or self.change != other.change:
            raise ValueError("both tables must share identifier column and id space")
        keys = list(on) if on else joins.shared_columns(self.df, other.df)
        if self.change.column not in keys:
            raise ValueError("the identifier must be among the join columns")
        clash = set(self.df.columns) & set(other.df.columns) - set(keys)
        ours, theirs = _join_stability(self.limits, keys), _join_stability(other.limits, keys)
        carried = [
            *_through_join(self.limits, theirs, clash, "_left"),
            *_through_join(other.limits, ours, clash, "_right"),
        ]
        joined = joins.join_private_ids(self.df, other.df, keys)
        return self._on(joined, _tightest(carried))

    def groupby(self, keys: Keys) -> Grouped:
        return Grouped(self, keys)


def _cut(df: DataFrame, id_column: str, limit: Limit) -> DataFrame:
    if limit.kind == "rows":
        return limits.limit_rows_per_id(df, id_column, limit.n)
    if limit.kind == "groups":
        return limits.limit_groups_per_id(df, id_column, limit.column, limit.n)
    return limits.limit_rows_per_group_per_id(df, id_column, limit.column, limit.n)


def _through_join(limits_, stability: int | None, clash: set[str], suffix: str) -> list[Limit]:
    out = []
    for x in limits_:
        column = f"{x.column}{suffix}" if x.column in clash else x.column
        if x.kind == "groups":
            out.append(replace(x, column=column))
        elif stability:
            out.append(replace(x, column=column, n=x.n * stability))
    return out


def _join_stability(limits_: Sequence[Limit], keys: Sequence[str]) -> int | None:
    bounds = [
        x.n for x in limits_ if x.kind == "rows" or (x.kind == "groups" and x.column in keys)
    ]
    return min(bounds, default=None)


def join_bound(left_rows: int, right_rows: int, left_cut, right_cut) -> int:
    """Rows of a truncated join that one individual can change.

    A changed left row alters up to ``stability`` surviving rows, each meeting up to ``n`` right ones.
    """
    return (
        right_cut.n * left_cut.stability * left_rows + left_cut.n * right_cut.stability * right_rows
    )


@dataclass(frozen=True)
class Query:
    """An aggregate with the table it reads and what one individual can change of it.

    ``rooted`` is the bound where groups add up as a root-sum-square, which only concentrated budgets allow; the
    budget of the evaluation decides between the two.
    """

    measure: agg.Measure | None
    bound: Bound
    mechanism: str = "default"
    answer: Any = None
    rooted: Bound | None = None

    def bound_for(self, budget: Budget) -> Bound:
        """The bound that noise under this budget is made for."""
        return self.rooted if self.rooted is not None and isinstance(budget, Concentrated) else self.bound

    def noise(self, budget: Budget):
        """Mechanism and parameter of every noisy component."""
        return noise_plan(self.measure, _without_delta(budget), self.bound_for(budget), self.mechanism)


def _without_delta(budget: Budget) -> Budget:
    return Approximate(budget.epsilon, 0) if isinstance(budget, Approximate) else budget


@dataclass(frozen=True)
class Grouped:
    """A protected table with the key set its answers are given for."""

    table: Protected
    keys: Keys

    def _bound(self, rooted: bool = False) -> Bound:
        """The smallest bound that follows from the table's protection and the limits already enforced on it."""
        change, limits_ = self.table.change, self.table.limits
        if isinstance(change, MaxRows):
            return Bound.of_rows(change.rows)
        if isinstance(change, MaxRowsInMaxGroups):
            if change.column not in self.keys.columns:
                raise ValueError(f"answers must be grouped by {change.column}")
            return Bound.of_groups(change.groups, change.rows, rooted)
        options = [Bound.of_rows(x.n) for x in limits_ if x.kind == "rows"]
        for x in limits_:
            for y in limits_:
                if (x.kind, y.kind) == ("groups", "rows_in_group") and x.column == y.column:
                    options.append(Bound.of_groups(x.n, y.n, rooted and x.column in self.keys.columns))
        if not options:
            raise ValueError("the rows per identifier must be limited before an aggregate")
        return min(options, key=lambda o: o.squared)

    def _query(self, build, mechanism: str) -> Query:
        # Laplace noise goes by the sum over groups under any budget.
        rooted = None if mechanism == "laplace" else self._bound(rooted=True)
        return Query(build(self.table.df), self._bound(), mechanism, rooted=rooted)

    def count(self, name: str = "count", mechanism: str = "default"):
        return self._query(lambda d: agg.agg_count(d, self.keys, name), mechanism)

    def count_distinct(
        self,
        columns: Sequence[str] | None = None,
        name: str | None = None,
        mechanism: str = "default",
    ):
        """Distinct tuples. Identifiers alone are counted from one row each (per group)."""
        change = self.table.change
        if isinstance(change, RowsWithId) and list(columns or []) == [change.column]:
            name = name or f"count_distinct({change.column})"
            groups = self.keys.columns
            limited = {x.column for x in self.table.limits if x.kind == "groups"}
            single = None
            if not groups:
                single = max_rows_per_id(1)
            elif len(groups) == 1 and groups[0] in limited:
                single = max_rows_per_group_per_id(groups[0], 1)
            if single is not None:
                return Grouped(self.table.enforce(single), self.keys).count(name, mechanism)
        return self._query(lambda d: agg.agg_count_distinct(d, self.keys, columns, name), mechanism)

    def sum(self, column, low, high, name=None, mechanism="default"):
        build = lambda d: agg.agg_sum(d, self.keys, column, low, high, name)
        return self._query(build, mechanism)

    def average(self, column, low, high, name=None, mechanism="default"):
        build = lambda d: agg.agg_average(d, self.keys, column, low, high, name)
        return self._query(build, mechanism)

    def variance(self, column, low, high, name=None, mechanism="default"):
        build = lambda d: agg.agg_variance(d, self.keys, column, low, high, name)
        return self._query(build, mechanism)

    def stdev(self, column, low, high, name=None, mechanism="default"):
        build = lambda d: agg.agg_stdev(d, self.keys, column, low, high, name)
        return self._query(build, mechanism)

    def histogram(self, column, bins, name=None, mechanism="default"):
        build = lambda d: agg.agg_histogram(d, self.keys, column, bins, name)
        return self._query(build, mechanism)

    def quantile(self, column, q, low, high, name=None, seed=None) -> Query:
        df, bound = self.table.df, self._bound()

        def answer(budget: Budget) -> DataFrame:
            epsilon = None
            if not is_infinite(budget):
                spent = float(budget.amounts[0])
                # The exponential mechanism with epsilon costs epsilon^2 / 8 of concentrated budget.
                epsilon = math.sqrt(8 * spent) if isinstance(budget, Concentrated) else spent
            rows = int(bound.rows)
            return agg.agg_quantile(df, self.keys, column, q, low, high, epsilon, rows, name, seed)

        return Query(None, bound, answer=answer)

    def min(self, column, low, high, name=None) -> Query:
        return self.quantile(column, 0.0, low, high, name or f"{column}_min")

    def max(self, column, low, high, name=None) -> Query:
        return self.quantile(column, 1.0, low, high, name or f"{column}_max")

    def median(self, column, low, high, name=None) -> Query:
        return self.quantile(column, 0.5, low, high, name or f"{column}_median")


def group_values(table: Protected, columns: Sequence[str] | None = None, seed=None) -> Query:
    """The values of ``columns`` themselves, released under an approximate budget."""
    spark = table.df.sparkSession
    names = list(columns or [c for c in table.df.columns if c != table.fixed_column])
    if isinstance(table.change, RowsWithId) and table.change.column in names:
        raise ValueError("identifiers cannot be released")
    if isinstance(table.change, MaxRowsInMaxGroups):
        bound = Bound.of_groups(table.change.groups, table.change.rows, False)
    else:
        bound = Grouped(table, Keys.of_values(spark, {}))._bound()
    answer = lambda budget: select_groups_private(table.df, names, budget, int(bound.rows), seed)
    return Query(None, bound, answer=answer)


class Account:
    """Private and public tables, named views, and one budget that every answer debits."""

    def __init__(self, budget: Budget):
        self.ledger = Ledger(budget)
        self.private: dict[str, Protected] = {}
        self.public: dict[str, DataFrame] = {}
        self._cached: set[str] = set()

    @property
    def remaining(self) -> Budget:
        return self.ledger.left

    def add_private(self, name: str, df: DataFrame, change) -> Protected:
        self._free(name)
        self.private[name] = Protected.load(df, change)
        return self.private[name]

    def add_public(self, name: str, df: DataFrame) -> DataFrame:
        self._free(name)
        self.public[name] = cleaning.coerce_types(df)
        return self.public[name]

    def _free(self, name: str) -> None:
        if name in self.private or name in self.public:
            raise ValueError(f"the name {name} is taken")

    def create_view(self, name: str, table: Protected, cache: bool = False) -> Protected:
        """Name a derived table; ``cache`` keeps its rows for the queries that follow."""
        self._free(name)
        if cache:
            table = replace(table, df=table.df.persist())
            self._cached.add(name)
        self.private[name] = table
        return table

    def delete_view(self, name: str) -> None:
        table = self.private.pop(name)
        if name in self._cached:
            self._cached.discard(name)
            table.df.unpersist()

    def evaluate(self, query: Query, budget: Budget) -> DataFrame:
        """Debit ``budget`` and return the answer, drawn once and held in shared storage."""
        granted = self.ledger.spend(budget)
        if query.answer is not None:
            return materialise(query.answer(granted))
        charged = _without_delta(granted)
        return materialise(release(query.measure, charged, query.bound_for(charged), query.mechanism))

    def _granted_to_parts(self, table: Protected, column: str, budget: Budget) -> Budget:
        n = 1
        if isinstance(table.change, RowsWithId):
            bounds = [x.n for x in table.limits if x.kind == "groups" and x.column == column]
            if not bounds:
                raise ValueError(f"enforce max_groups_per_id({column!r}, n) before splitting by {column}")
            n = min(bounds)
        return share(self.ledger.spend(budget), n)

    def split(self, table: Protected, column: str, splits: Mapping[str, Any], budget: Budget) -> Parts:
        """The parts of ``partition`` side by side in one table, to be answered together."""
        if PART in table.df.columns:
            raise ValueError(f"the table has a column {PART}")
        granted = self._granted_to_parts(table, column, budget)
        return Parts(replace(table, df=label_parts(table.df, column, splits)), {name: Ledger(granted) for name in splits})

    def partition(
        self, table: Protected, column: str, splits: Mapping[str, Any], budget: Budget
    ) -> dict[str, Account]:
        """One account per listed value of ``column``; together they cost ``budget`` once.

        Rows of one identifier may lie in several parts, whose losses add up. A table with an identifier
        therefore needs an enforced ``max_groups_per_id(column, n)``, and each part gets an n-th of the budget.
        """
        granted = self._granted_to_parts(table, column, budget)
        parts = {}
        for name, part in partition_by_value(table.df, column, splits).items():
            child = Account(granted)
            child.private[name] = replace(table, df=part)
            parts[name] = child
        return parts


PART = "part"


@dataclass(frozen=True)
class Parts:
    """Disjoint parts of a protected table, labelled in one frame, with a budget each.

    An answer is one aggregation with the label as leading group key, so the table is read once however many parts
    there are; every part's noise follows from what is spent on it.
    """

    table: Protected
    ledgers: dict[str, Ledger]

    def apply(self, change) -> Parts:
        """The same change of every part: ``change`` maps a protected table to another that keeps the label.

        Limits go through ``enforce``, which counts the rows of an identifier in each part.
        """
        table = change(self.table)
        if PART not in table.df.columns:
            raise ValueError(f"the column {PART} must be kept")
        return Parts(table, self.ledgers)

    def enforce(self, limit: Limit) -> Parts:
        """Cut the rows of each identifier to a limit in every part by itself; the same rows stay as in parts cut alone."""
        table = self.table
        if not isinstance(table.change, RowsWithId):
            raise ValueError("limits per identifier need a table with one")
        digest = [c for c in table.df.columns if c != PART]
        owned = table.df.withColumn("__owner", F.struct(PART, table.change.column))
        if limit.kind == "rows":
            cut = limits.limit_rows_per_id(owned, "__owner", limit.n, digest)
        elif limit.kind == "groups":
            cut = limits.limit_groups_per_id(owned, "__owner", limit.column, limit.n)
        else:
            cut = limits.limit_rows_per_group_per_id(owned, "__owner", limit.column, limit.n, digest)
        return Parts(table._on(cut.drop("__owner"), _tightest([*table.limits, limit])), self.ledgers)

    def evaluate(self, keys: Keys, build, budgets: Budget | Mapping[str, Budget]) -> DataFrame:
        """Answers of the named parts (all at one budget): the label, the keys, and what ``build`` asks of a ``Grouped``."""
        asked = {name: budgets for name in self.ledgers} if not isinstance(budgets, Mapping) else dict(budgets)
        unknown = set(asked) - set(self.ledgers)
        if unknown or not asked:
            raise ValueError(f"no such parts: {sorted(unknown)}" if unknown else "no part is asked")
        for name, budget in asked.items():
            Ledger(self.ledgers[name].left).spend(budget)  # all can pay or none does
        granted = {name: self.ledgers[name].spend(budget) for name, budget in asked.items()}
        spark = self.table.df.sparkSession
        wanted = Keys.of_values(spark, {PART: list(asked)}).times(keys)
        table = self.table if len(asked) == len(self.ledgers) else self.table.filter(_one_of(list(asked)))
        query = build(Grouped(table, wanted))
        if query.answer is None:
            charged = {name: _without_delta(b) for name, b in granted.items()}
            plans = {name: noise_plan(query.measure, b, query.bound_for(b), query.mechanism) for name, b in charged.items()}
            return materialise(release_by(query.measure, PART, plans))
        # Mechanisms that take a whole budget are asked once per different budget.
        answers = None
        for budget in dict.fromkeys(granted.values()):
            mine = query.answer(budget).filter(_one_of([n for n, b in granted.items() if b == budget]))
            answers = mine if answers is None else answers.unionByName(mine)
        return materialise(answers)


def _one_of(names: Sequence[str]) -> str:
    quoted = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    return f"{PART} IN ({quoted})"


def label_parts(df: DataFrame, column: str, splits: Mapping[str, Any]) -> DataFrame:
    """Rows of the listed values with their part's name as ``part``, in one reading; other rows are in no part.

    A value listed under several names belongs to the first.
    """
    first = {}
    for name, value in splits.items():
        first.setdefault(value, name)
    names = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    # A lookup by a null key is an error; such rows are in no part.
    return df.filter(df[column].isin(list(first))).select(F.element_at(names, df[column]).alias(PART), "*")


def partition_by_value(df: DataFrame, column: str, splits: Mapping[str, Any]) -> dict[str, DataFrame]:
    """Rows of each listed value; rows of other values are in no part."""
    return {name: df.filter(df[column] == value) for name, value in splits.items()}


__all__ = ["Account", "Approximate", "Concentrated", "Protected", "Pure"]
