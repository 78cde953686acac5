import pytest
from pyspark.sql import functions as F

from tabguard.demos.source_queries import BLOCKS, PERSON_RECORD, UNIT_RECORD  # noqa: F401
from tabguard.plans import tabulate as tab
from tabguard.sources import households, sinks, synth, text
from tabguard.sources.layouts import PERSON_FIELDS, UNIT_FIELDS

UNIT = dict(
    RTYPE="2", MAFID="100000001", BCUSTATEFP="44", VERSION="00001", FINAL_POP="    3", HHLDRAGE=" 45", HHSPAN="1",
    HHLDRACE="1", HHRACE="01", TEN="1", TEN_A="1", TEN_R="1", VACS="0", QGQTYP="   ", GQSEX=" ",
    OIDTB="0000000000000000001234", HHT="1", HHT2="01", CPLT="1", UPART="0", MULTG="0", PAOC="1", P18=" 2", P60=" 0",
    P65=" 0", P75="00", PAC="1", HHSEX="2",
)
PERSON = dict(
    RTYPE="3", MAFID="100000001", CUF_PNC="    1", BCUSTATEFP="44", VERSION="00001", QSEX="1", QAGE=" 45",
    QDB="19750101", QDOB_MONTH="01", QDOB_DAY="01", QDOB_YEAR="1975", QSPAN="9000", QSPANX="1", CENHISP="1",
    QRACE1="1000", **{f"QRACE{i}": "    " for i in range(2, 9)}, QRACEX="1", CENRACE="01", RACE2010="01",
    RELSHIP="20", QGQTYP="   ", LIVE_ALONE="0",
)


def lines(spark, records, fields, sep=""):
    assert all(list(r) == [f.name for f in fields] for r in records)
    return spark.createDataFrame([(sep.join(r.values()),) for r in records], "value string")


@pytest.mark.parametrize("sep", ["", "|"])
def test_clean_records_pass(spark, sep):
    for record, fields in ((UNIT, UNIT_FIELDS), (PERSON, PERSON_FIELDS)):
        raw = text.cut_records(lines(spark, [record], fields, sep), fields)
        assert raw.first().asDict() == {**record, "BROKEN_LINE": None, "REASONS": None}
        assert text.record_failures(raw, fields).count() == 0
        typed = text.typed_fields(raw, fields).first()
        assert typed.MAFID == 100000001 and isinstance(typed.RTYPE, str)
    assert typed.QAGE == 45


@pytest.mark.parametrize(
    "fields,base,name,good,bad",
    [
        (UNIT_FIELDS, UNIT, "RTYPE", ["4"], ["3", " "]),
        (UNIT_FIELDS, UNIT, "MAFID", ["899999999"], ["900000000", "10000000x", "100000000"]),
        (UNIT_FIELDS, UNIT, "BCUSTATEFP", ["01", "06", "56", "72", " 1"], ["03", "07", "14", "43", "52", "57", "  "]),
        (UNIT_FIELDS, UNIT, "FINAL_POP", ["99999", "    0", "00012"], ["abcde"]),
        (UNIT_FIELDS, UNIT, "HHLDRAGE", ["   ", "115", "015", " 15"], ["116"]),
        (UNIT_FIELDS, UNIT, "HHRACE", ["63", "  ", "10"], ["00", "64"]),
        (UNIT_FIELDS, UNIT, "QGQTYP", ["301", "904"], ["302", "0  "]),
        (UNIT_FIELDS, UNIT, "OIDTB", ["9999999999999999999999"], ["000000000000000000000x"]),
        (UNIT_FIELDS, UNIT, "P18", ["99", "0 "], ["  ", "-1"]),
        (UNIT_FIELDS, UNIT, "HHT2", ["12", "00"], ["13"]),
        (PERSON_FIELDS, PERSON, "QDB", ["20200401", "19040402"], ["20200402", "1904040x"]),
        (PERSON_FIELDS, PERSON, "QSPAN", ["9950", "8999", "1000"], ["9951", "    ", "0999"]),
        (PERSON_FIELDS, PERSON, "QRACE1", ["9500"], ["    ", "9501"]),
        (PERSON_FIELDS, PERSON, "QRACE4", ["    ", "9900"], ["   1", "9901"]),
        (PERSON_FIELDS, PERSON, "RELSHIP", ["38", "20"], ["19", "39"]),
        (PERSON_FIELDS, PERSON, "RACE2010", ["31"], ["32"]),
        (PERSON_FIELDS, PERSON, "QAGE", ["115", "  0"], ["116", "   "]),
    ],
)
def test_field_rules(spark, fields, base, name, good, bad):
    records = [{**base, name: v} for v in good + bad]
    raw = text.cut_records(lines(spark, records, fields), fields)
    failed = {r[name]: r.REASONS for r in text.record_failures(raw, fields).collect()}
    assert set(failed) == set(bad)
    assert all(reason.startswith(f"{name} ({v}) out of range (") for v, reason in failed.items())


def test_lines_that_cannot_be_cut_are_kept_with_why(spark):
    width, n = sum(f.width for f in UNIT_FIELDS), len(UNIT_FIELDS)
    good = ["|".join("1" for _ in UNIT_FIELDS), "1" * width, "1" * width + "more"]
    df = spark.createDataFrame([(v,) for v in [*good, "a|b", "2100", "", None]], "value string")
    rows = text.cut_records(df, UNIT_FIELDS).collect()
    assert sorted(r.REASONS for r in rows if r.REASONS) == sorted([f"2 fields instead of {n}", f"4 characters instead of {width}", f"0 characters instead of {width}", "no line"])
    assert sum(r.RTYPE == "1" for r in rows) == 3
    piped = {r.BROKEN_LINE: r.REASONS for r in text.cut_records(df.where("value IS NOT NULL"), UNIT_FIELDS, text.PIPED).collect() if r.REASONS}
    assert piped["2100"] == f"1 fields instead of {n}" and len(piped) == 5
    fixed = text.cut_records(df.where("value IS NOT NULL"), UNIT_FIELDS, text.FIXED)
    assert sorted(r.BROKEN_LINE for r in fixed.collect() if r.REASONS) == ["", good[0], "2100", "a|b"]
    with pytest.raises(ValueError):
        text.cut_records(df, UNIT_FIELDS, "csv")
    failures = text.record_failures(text.cut_records(df, UNIT_FIELDS), UNIT_FIELDS).collect()
    assert sum(r.BROKEN_LINE is not None for r in failures) == 4 and len(failures) == 7


def test_quarantine_splits_one_reading(spark, tmp_path):
    whole = ["".join(UNIT.values())] * 3
    for name, content in (("a.txt", [*whole, "short", *whole, ""]), ("b.txt", ["short", "shorter"])):
        (tmp_path / name).write_text("".join(x + "\n" for x in content))
    scanned = text.scan_fixed_width_unit(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    both = text.quarantine(scanned, str(tmp_path / "out"))
    assert both.records.count() == 6 and both.records.select("MAFID").distinct().collect()[0][0] == 100000001
    rejects = both.rejects.orderBy("file", "block", "line").collect()
    assert [(r.file[-5:], r.BROKEN_LINE) for r in rejects] == [("a.txt", "short"), ("a.txt", ""), ("b.txt", "short"), ("b.txt", "shorter")]
    width = sum(f.width for f in UNIT_FIELDS)
    counts = {(r.file[-5:], r.REASONS): (r.n_lines, r.example) for r in text.reject_counts(both.rejects).collect()}
    assert counts[("b.txt", f"7 characters instead of {width}")] == (1, "shorter") and len(counts) == 4
    clean = text.quarantine(scanned.where("REASONS IS NULL"), str(tmp_path / "clean"))
    assert clean.rejects.isEmpty() and clean.records.columns == both.records.columns


def test_integers_as_wide_as_a_long(spark):
    from tabguard.functions.parse import long_or_null

    texts = ["9223372036854775807", " -9223372036854775808", "+000000000000000000000012", "9223372036854775808", "12345678901234567890", "1x", "", None, "-999999999999999999", "000000000000000000", "0" * 60 + "7"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(long_or_null(F.col("t")).alias("v")).collect()
    assert [r.v for r in rows] == [2**63 - 1, -(2**63), 12, None, None, None, None, None, -(10**18 - 1), 0, 7]


def test_state_files():
    assert text.state_files("d/", "u%s.txt", ["01", "72"], "p/") == ["d/u01.txt", "p/u72.txt"]
    assert text.state_files("d/", "u%s.txt", [], "p/") == ["d/", "p/u72.txt"]


def test_annotated_order(spark, tmp_path):
    for name in ("a", "b"):
        body = [f"# {name} first", "h1|h2", *[f"{name}|{i}" for i in range(300)], f"# {name} last"]
        (tmp_path / f"{name}.txt").write_text("\n".join(body) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        a, b = (text.text_split_annotations(text.numbered_lines(spark, str(tmp_path / f"{n}.txt"))) for n in "ab")
        both = text.text_concat_annotated(a, b, ("A", "B"), ["made for a test"])
        assert text.header_mismatch(a, b).count() == 0
        out = str(tmp_path / "out")
        text.write_annotated(both, out)
        place = ["part", "file", "block", "line"]
        got = [r.value for r in both.orderBy(*place).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = ["# made for a test", "# records: 600 (combined)", "#", "# A a first", "# A a last", "#", "# B b first", "# B b last", "h1|h2"]
    expected += [f"a|{i}" for i in range(300)] + [f"b|{i}" for i in range(300)]
    assert got == expected
    assert spark.read.text(out).count() == len(expected)
    other = a.withColumn("value", F.regexp_replace("value", "^h1", "x"))
    assert text.header_mismatch(other, b).count() == 2


def test_described_lines(spark):
    df = spark.createDataFrame([("17.a",), ("x.b",)], "value string")
    V = text.Variable
    got = text.scan_schema_described(df, [V("n", "long", 0), V("s", "string", 1)], ".").collect()
    assert [tuple(r) for r in got] == [(17, "a"), (None, "b")]
    with pytest.raises(ValueError):
        text.scan_schema_described(df, [V("n")], None)


def test_family_size_edges(spark):
    persons = spark.createDataFrame(
        [(1, "20"), (1, "25"), (2, "20"), (3, "20"), (3, "34"), (4, "20"), (4, "21")], "MAFID long, RELSHIP string"
    )
    units = spark.createDataFrame([("2", 1, "2"), ("2", 2, "1"), ("2", 3, "2"), ("4", 4, "2"), ("2", 5, "0")], "RTYPE string, MAFID long, FINAL_POP string")
    got = {r.MAFID: r.NPF for r in households.derive_family_size(persons, units).collect()}
    assert got == {1: 2, 2: 0, 3: 0, 4: 0, 5: 0}


def test_synthesized_ranges(spark):
    V = synth.Declared
    out = synth.synthesize_from_schema(
        spark.range(500),
        [V("a", "integer", ranges=((0, 3), (10, 12))), V("b", choices=("x", "y")), V("c", width=4),
         V("d", "decimal", ranges=((1, 2),)), V("e", "integer", width=2, prefix="P")],
        seed=5,
    ).collect()
    assert {r.a for r in out} == {0, 1, 2, 3, 10, 11, 12}
    assert {r.b for r in out} == {"x", "y"}
    assert all(len(r.c) == 4 and r.c.isalpha() for r in out)
    assert all(1 <= r.d <= 2 for r in out)
    assert all(r.e[0] == "P" and 0 <= int(r.e[1:]) < 100 for r in out)


def test_sinks(spark, tmp_path):
    rows = [("PH2", "1", "USA", "*", 3, 5, "Discrete Gaussian", 2.0), ("PH7", "1", "USA", "A", 2, 4, "Discrete Gaussian", 2.0)]
    answers = spark.createDataFrame(rows, "TABLE string, REGION_ID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT long, NOISE_DISTRIBUTION string, VARIANCE double")
    sinks.sink_tabulations(answers, str(tmp_path / "t"))
    back = sinks.read_release(spark, str(tmp_path / "t"), "PH2")
    assert back.columns == ["REGION_ID", "REGION_TYPE", "PH2_DATA_CELL", "COUNT", "NOISE_DISTRIBUTION", "VARIANCE"]
    assert [tuple(r) for r in back.collect()] == [("1", "USA", "3", "5", "Discrete Gaussian", "2.0")]
    assert sinks.read_release(spark, str(tmp_path / "t"), "PH7").columns[2:4] == ["ITERATION_CODE", "PH7_DATA_CELL"]
    sinks.sink_tabulations_partitioned(answers, str(tmp_path / "p"))
    assert spark.read.csv(str(tmp_path / "p"), header=True, sep="|").filter("TABLE = 'PH7'").count() == 1
    assert tab.one_table(answers, "PH7").columns[3] == "PH7_DATA_CELL"


def test_readers_see_a_release_whole_or_not(spark, tmp_path):
    folder = str(tmp_path / "out")
    assert sinks.latest_release(spark, folder) is None
    with pytest.raises(ValueError):
        sinks.read_release(spark, folder, "PH7")

    def answers(count, fails=False):
        rows = [(t, str(r), "STATE", "*", 2, count) for t in ("PH7", "PH1_num", "PH2") for r in range(10, 40)]
        df = spark.createDataFrame(rows, "TABLE string, REGION_ID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT long")
        broken = F.when((F.col("TABLE") == "PH2") & (F.col("REGION_ID") == "39"), F.raise_error(F.lit("lost"))).cast("long")
        return df.withColumn("COUNT", F.coalesce(broken, "COUNT")) if fails else df

    def seen():
        return {(n, r.COUNT) for n in ("PH7", "PH1_num", "PH2") for r in sinks.read_release(spark, folder, n).collect()}

    first = sinks.sink_tabulations(answers(1), folder)
    assert seen() == {("PH7", "1"), ("PH1_num", "1"), ("PH2", "1")}
    with pytest.raises(Exception, match="lost"):  # after some tables are written
        sinks.sink_tabulations(answers(2, fails=True), folder)
    assert seen() == {("PH7", "1"), ("PH1_num", "1"), ("PH2", "1")} and sinks.latest_release(spark, folder) == (1, first)
    second = sinks.sink_tabulations(answers(3), folder)
    assert seen() == {("PH7", "3"), ("PH1_num", "3"), ("PH2", "3")} and sinks.latest_release(spark, folder) == (2, second)
    assert spark.read.csv(f"{first}/TABLE=PH7", header=True, sep="|").count() == 30  # the former one stays
    listed = sinks.manifest(spark, folder)
    assert {(r.number, r.TABLE, r.n_rows) for r in listed.collect()} == {(n, t, 30) for n in (1, 2) for t in ("PH7", "PH1_num", "PH2")}
