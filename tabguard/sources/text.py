"""Readers for text formats: typed CSV, pipe files, fixed-width records, annotated tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabguard.functions.parse import long_or_null, number_or_null
from tabguard.plans.quality import rule_failures
from tabguard.sources.layouts import PERSON_FIELDS, UNIT_FIELDS, Field


def scan_csv_typed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    region_column: str | None = None,
    regions: Sequence[str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with header and explicit schema, optionally only the rows of some regions."""
    df = spark.read.schema(schema).csv(path, header=True, sep=sep)
    if region_column is not None and regions is not None:
        df = df.filter(F.col(region_column).isin(list(regions)))
    return df


def scan_restrict_by_region(df: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the already filtered geography."""
    return df.join(geo.select(key), key, "left_semi")


def scan_csv_directory(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ","
) -> DataFrame:
    """All CSV parts of a directory as one table; empty parts add nothing."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep)


def scan_geo_reference(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Pipe file with header, all text, block identifier as long.

    The header names the columns; without a schema only its first line is read to find them.
    """
    df = spark.read.csv(path, header=True, sep="|")
    return df.withColumn("OIDTABBLK", long_or_null(F.col("OIDTABBLK")))


def state_files(
    folder: str, name_format: str, states: Sequence[str], folder_72: str | None = None
) -> list[str]:
    """One file per state; state 72 lies in a folder of its own. No states means all files."""
    other = folder_72 or folder
    if not states:
        return [folder, other + name_format % "72"]
    files = [folder + name_format % s for s in states if s != "72"]
    return files + ([other + name_format % "72"] if "72" in states else [])


def scan_state_files(
    spark: SparkSession,
    folder: str,
    name_format: str,
    states: Sequence[str],
    folder_72: str | None = None,
) -> DataFrame:
    """Lines (``value``) of the chosen states' files."""
    return spark.read.text(state_files(folder, name_format, states, folder_72))


FIXED, PIPED, EITHER = "fixed", "piped", "either"
BROKEN = ["BROKEN_LINE", "REASONS"]
PLACE = ["file", "block", "line"]


def cut_records(lines: DataFrame, fields: Sequence[Field], layout: str = EITHER) -> DataFrame:
    """Lines (``value``) cut into raw text fields, permissively: every line gives a row.

    A line that cannot be cut has null fields, itself as ``BROKEN_LINE`` and why in ``REASONS``; both are null for
    others. ``layout`` says whether lines are cut by position or at pipes; ``EITHER`` tells them apart per line. Cut by
    position, a line must hold all fields; what follows them is ignored. Columns besides ``value`` (the place of a line,
    see ``numbered_lines``) are kept.
    """
    if layout not in (FIXED, PIPED, EITHER):
        raise ValueError(f"unknown layout {layout!r}")
    width, cut, start = sum(f.width for f in fields), [], 1
    for f in fields:
        cut.append(F.substring("value", start, f.width))
        start += f.width
    piped = {FIXED: F.lit(False), PIPED: F.lit(True), EITHER: F.contains("value", F.lit("|"))}[layout]
    parts = F.split("value", r"\|", -1)
    long_enough = F.length("value") >= width
    cells = F.when(piped, parts).when(long_enough, F.array(*cut))
    # A generator keeps the optimizer from repeating the split inside every later use of a field.
    once = lines.select("*", piped.alias("__piped"), F.explode(F.array(cells)).alias("__cells"))
    whole = F.coalesce(F.size("__cells") == len(fields), F.lit(False))
    reason = (
        F.when(F.col("value").isNull(), F.lit("no line"))
        .when(F.col("__piped"), F.format_string(f"%d fields instead of {len(fields)}", F.size("__cells")))
        .otherwise(F.format_string(f"%d characters instead of {width}", F.length("value")))
    )
    named = [F.when(whole, F.get("__cells", F.lit(i))).alias(f.name) for i, f in enumerate(fields)]
    places = [c for c in lines.columns if c != "value"]
    broken = [F.when(~whole, F.coalesce("value", F.lit(""))).alias("BROKEN_LINE"), F.when(~whole, reason).alias("REASONS")]
    return once.select(*places, *named, *broken)


@dataclass(frozen=True)
class Quarantine:
    """Both outputs of one reading: whole records, and the lines that could not be cut with their REASONS."""

    records: DataFrame
    rejects: DataFrame


def quarantine(scanned: DataFrame, path: str) -> Quarantine:
    """Write scanned lines to ``path`` in one job, whole and broken ones, and read both back.

    Broken lines are found by the file statistics of ``REASONS``, so reading either output skips most of the other.
    """
    scanned.write.parquet(path)
    stored = scanned.sparkSession.read.schema(scanned.schema).parquet(path)
    place = [c for c in PLACE if c in stored.columns]
    return Quarantine(stored.where("REASONS IS NULL").drop(*BROKEN), stored.where("REASONS IS NOT NULL").select(*place, *BROKEN))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Broken lines per file and reason, with the first of each as an example."""
    place = F.struct("block", "line")
    example = F.min_by("BROKEN_LINE", place).alias("example")
    return rejects.groupBy("file", "REASONS").agg(F.count(F.lit(1)).alias("n_lines"), example)


def typed_fields(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Raw text fields as typed columns; text that is no integer becomes null. Other columns are kept."""
    names = {f.name: f for f in fields}
    return raw.select(
        *[
            long_or_null(F.col(c)).alias(c) if c in names and names[c].kind == "long" else F.col(c)
            for c in raw.columns
        ]
    )


def scan_fixed_width_unit(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Fixed-width unit file as typed columns, broken lines with null fields; see ``cut_records``."""
    return typed_fields(cut_records(numbered_lines(spark, paths), UNIT_FIELDS, FIXED), UNIT_FIELDS)


def scan_fixed_width_person(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Fixed-width person file as typed columns, broken lines with null fields; see ``cut_records``."""
    return typed_fields(cut_records(numbered_lines(spark, paths), PERSON_FIELDS, FIXED), PERSON_FIELDS)


def scan_pipe_record(
    spark: SparkSession, paths: str | Sequence[str], fields: Sequence[Field]
) -> DataFrame:
    """Pipe-delimited record file as typed columns, broken lines with null fields; see ``cut_records``."""
    return typed_fields(cut_records(numbered_lines(spark, paths), fields, PIPED), fields)


def record_failures(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Raw records that break a field rule, with all REASONS; clean records are not listed.

    Of ``cut_records``, broken lines are failures too, with why they could not be cut.
    """
    reasons = rule_failures({f.name: (f.valid(), f.allowed()) for f in fields})
    if "REASONS" in raw.columns:
        reasons = F.coalesce("REASONS", reasons)
    # Generated from an array of at most one text, so that the rules run once per record.
    found = F.filter(F.array(reasons), lambda text: text != "")
    return raw.select(*[c for c in raw.columns if c != "REASONS"], F.explode(found).alias("REASONS"))


def dq_record_rules_unit(raw: DataFrame) -> DataFrame:
    """Unit records that break a rule, and broken lines."""
    return record_failures(raw, UNIT_FIELDS)


def dq_record_rules_person(raw: DataFrame) -> DataFrame:
    """Person records that break a rule, and broken lines."""
    return record_failures(raw, PERSON_FIELDS)


@dataclass(frozen=True)
class Variable:
    """A declared variable: its place in a line (field number, or 1-based columns) and its type."""

    name: str
    type: str = "string"
    position: int | None = None
    start: int | None = None
    width: int | None = None


def scan_schema_described(
    lines: DataFrame, variables: Sequence[Variable], delimiter: str | None = None
) -> DataFrame:
    """Lines (``value``) parsed by a variable list, by delimiter or by column positions."""
    if not variables:
        raise ValueError("no variables declared")

    def raw(v: Variable) -> Column:
        if delimiter is not None:
            if v.position is None:
                raise ValueError(f"{v.name} has no field position")
            pattern = "\\Q" + delimiter + "\\E"
            return F.get(F.split("value", pattern, -1), F.lit(v.position))
        if v.start is None or v.width is None:
            raise ValueError(f"{v.name} has no column position")
        return F.substring("value", v.start, v.width)

    return lines.select(
        *[
            (raw(v) if v.type == "string" else number_or_null(raw(v), v.type)).alias(v.name)
            for v in variables
        ]
    )


COMMENT, HEADER, DATA = "comment", "header", "data"


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their place in the file: ``file``, ``block`` and ``line`` sort them as written.

    ``line`` ascends within a split and ``block`` is the split's offset, so no global sort is needed to
    know the order.
    """
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def text_split_annotations(lines: DataFrame) -> DataFrame:
    """Label lines of one table as comment, header or data.

    The header is the first line that is no comment; as in the files read here, every later copy of it
    (one per concatenated part) is a header too, not data.
    """
    note = F.substring("value", 1, 1) == "#"
    place = F.struct("file", "block", "line")
    header = lines.filter(~note).agg(F.min_by("value", place).alias("h")).scalar()
    kind = F.when(note, F.lit(COMMENT)).when(F.col("value") == header, F.lit(HEADER))
    return lines.withColumn("kind", kind.otherwise(F.lit(DATA)))


def text_concat_annotated(
    first: DataFrame, second: DataFrame, prefixes: tuple[str, str], stamp: Sequence[str] = ()
) -> DataFrame:
    """Two labelled tables as one: notes, prefixed comments of both, one header, the data of both.

    Returns ``part``, ``file``, ``block``, ``line`` (the order) and ``value``. Both must have the same
    header; ``header_mismatch`` lists the headers if not.
    """
    spark = first.sparkSession
    place = ["file", "block", "line"]

    def section(df: DataFrame, kind: str, part: int, value: Column) -> DataFrame:
        return df.filter(F.col("kind") == kind).select(F.lit(part).alias("part"), *place, value.alias("value"))

    def fixed(part: int, value: Column, df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(part).alias("part"),
            F.lit("").alias("file"),
            F.lit(0).cast("long").alias("block"),
            F.lit(0).cast("long").alias("line"),
            value.alias("value"),
        )

    one = spark.range(1)
    both = first.unionByName(second)
    records = both.agg(F.count_if(F.col("kind") == DATA).alias("n"))
    header = first.filter(F.col("kind") == HEADER).agg(F.first("value").alias("h"))
    out = fixed(1, F.concat(F.lit("# records: "), F.col("n"), F.lit(" (combined)")), records)
    for i, text in enumerate(stamp):
        note = fixed(0, F.lit(f"# {text}"), one).withColumn("line", F.lit(i).cast("long"))
        out = out.unionByName(note)
    prefixed = [
        F.concat(F.lit(f"# {p}"), F.expr("substring(value, 2)")) for p in prefixes
    ]
    out = out.unionByName(fixed(2, F.lit("#"), one))
    out = out.unionByName(section(first, COMMENT, 3, prefixed[0]))
    out = out.unionByName(fixed(4, F.lit("#"), one))
    out = out.unionByName(section(second, COMMENT, 5, prefixed[1]))
    out = out.unionByName(fixed(6, F.col("h"), header))
    out = out.unionByName(section(first, DATA, 7, F.col("value")))
    return out.unionByName(section(second, DATA, 8, F.col("value")))


def header_mismatch(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct headers of two labelled tables when they differ; empty when they agree."""
    headers = first.unionByName(second).filter(F.col("kind") == HEADER).select("value").distinct()
    count = headers.agg(F.count(F.lit(1)).alias("n")).scalar()
    return headers.filter(count > 1)


def write_annotated(combined: DataFrame, path: str) -> None:
    """Write concatenated lines in order; the parts of the output sort as one file."""
    order = ["part", "file", "block", "line"]
    combined.orderBy(*order).select("value").write.mode("errorifexists").text(path)


def count_rows_per_file(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines per input file."""
    names = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"))
    return names.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
