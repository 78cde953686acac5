import datetime
import itertools

import pytest

from tabguard.operators import rowwise
from tabguard.operators.keys import Keys
from tabguard.plans.protected import MaxRows, MaxRowsInMaxGroups, Protected, RowsWithId, max_groups_per_id, max_rows_per_id


def frame(spark):
    return spark.createDataFrame([(1, "a b", None), (2, "", 1.5), (3, None, -1.0), (3, None, -1.0)], "k long, t string, x double")


def test_rows_are_cut_also_from_endless_generators(spark):
    def words(row):
        return ({"w": w, "n": i} for i, w in enumerate(itertools.chain((row["t"] or "").split(), itertools.repeat("-"))))

    rows = rowwise.flat_map_function(frame(spark), words, "w string, n int", 3).collect()
    assert [(r.k, r.w, r.n) for r in rows if r.k == 1] == [(1, "a", 0), (1, "b", 1), (1, "-", 2)]
    assert len(rows) == 12 and rows[0].asDict() == {"k": 1, "t": "a b", "x": None, "w": "a", "n": 0}
    assert rowwise.flat_map_function(frame(spark), words, "w string, n int", 0).count() == 0
    only = rowwise.flat_map_function(frame(spark), lambda r: [{"y": r["k"]}] * r["k"], "y long", None, augment=False, inputs=["k"])
    assert only.columns == ["y"] and only.count() == 9
    assert rowwise.map_function(frame(spark).limit(0), lambda r: {"y": 1}, "y long").collect() == []


def test_inputs_are_all_a_function_sees(spark):
    seen = rowwise.map_function(frame(spark), lambda r: {"names": sorted(r)}, "names array<string>", inputs=["x", "k"])
    assert {tuple(r.names) for r in seen.collect()} == {("k", "x")} and seen.columns == ["k", "t", "x", "names"]


@pytest.mark.parametrize(
    "declared, value",
    [
        ("y long", 1.0), ("y long", True), ("y int", 2**31), ("y int", "1"), ("y string", 1), ("y double", 1), ("y long not null", None),
        ("y date", datetime.datetime(2020, 1, 1)), ("y boolean", 1), ("y array<int>", [1, "x"]), ("y array<int>", 1), ("y tinyint", 128),
    ],
)
def test_values_of_other_types_fail(spark, declared, value):
    with pytest.raises(Exception, match="the function gave"):
        rowwise.map_function(frame(spark), lambda r: {"y": value}, declared).collect()


def test_values_of_the_declared_types_pass(spark):
    values = {"a": 2**62, "b": "ü", "c": 0.5, "d": True, "e": datetime.date(2020, 1, 2), "f": [1, None], "g": None, "h": b"\x00"}
    declared = "a long, b string, c double, d boolean, e date, f array<int>, g timestamp, h binary"
    row = rowwise.map_function(frame(spark), lambda r: values, declared, augment=False).first()
    assert {**row.asDict(), "h": bytes(row.h)} == values


def test_names_must_be_as_declared(spark):
    for out in ({"z": 1}, {"y": 1, "z": 1}, {}, [("y", 1)]):
        with pytest.raises(Exception, match="the function gave"):
            rowwise.map_function(frame(spark), lambda r, out=out: out, "y long").collect()
    for wrong in (
        lambda: rowwise.map_function(frame(spark), dict, "k long"), lambda: rowwise.map_function(frame(spark), dict, "y map<string,int>"),
        lambda: rowwise.map_function(frame(spark), dict, "y long", inputs=["nope"]), lambda: rowwise.flat_map_function(frame(spark), list, "y long", -1),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_protection_follows_the_number_of_rows(spark):
    many = lambda row: ({"g": i} for i in range(9))
    rows = Protected.load(frame(spark), MaxRows(2))
    assert rows.flat_map_function(many, "g int", 3).change == MaxRows(6)
    assert rows.flat_map_function(many, "g long", 3, grouping=True).change == MaxRowsInMaxGroups("g", 6, 1)
    assert rows.map_function(lambda r: {"y": 1}, "y int").change == MaxRows(2)
    ids = Protected.load(frame(spark), RowsWithId("k")).enforce(max_rows_per_id(2)).enforce(max_groups_per_id("t", 1))
    free = ids.flat_map_function(many, "g long")
    assert [x.kind for x in free.limits] == ["groups"] and free.df.count() == 36
    counted = rows.flat_map_function(many, "g long", 3, grouping=True).groupby(Keys.of_values(spark, {"g": [0, 2, 3]})).count()
    assert {r.g: r["count"] for r in counted.measure.exact().collect()} == {0: 4, 2: 4, 3: 0}
    for wrong in (
        lambda: rows.flat_map_function(many, "g int"), lambda: ids.flat_map_function(many, "g int", augment=False), lambda: ids.map_function(many, "k long"),
        lambda: ids.map_function(many, "g int", augment=False), lambda: rows.flat_map_function(many, "g int, h int", 3, grouping=True),
    ):
        with pytest.raises(ValueError):
            wrong()
