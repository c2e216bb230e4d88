"""Strict readers for sensor logs and truth files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.schema import READING_COLUMNS
from wearline.session import checkpointed

COMPRESSED = (".gz", ".bz2", ".zst", ".xz")

# Java would read a number with a type suffix; such a token is not a number here.
_SUFFIXED = r"[0-9.][dDfF](?: |$)"
_SUFFIXED_FIELD = r"^(?:[^ ]* ){0,%d}[^ ]*[0-9.][dDfF](?: |$)" % (len(READING_COLUMNS) - 1)


def _integer_of(number: Column) -> Column:
    """Integer value of a number; fractions round half away from zero."""
    return F.round(number).try_cast("int")


def _problem(token: Column, value: Column, kind: str) -> Column:
    """What is wrong with a token that has no value."""
    number = token.try_cast("double").isNotNull()
    reason = F.when(number, F.lit("[CAST_OVERFLOW]")).otherwise(F.lit("[CAST_INVALID_INPUT]"))
    return F.when(token.isNotNull() & value.isNull(), F.concat(reason, F.lit(f" not a value of type {kind}: "), token))


def _integer(token: Column) -> Column:
    """Integer value of a token; one that has none stops the job, whatever the session's ANSI setting."""
    value = _integer_of(token.try_cast("double"))
    problem = _problem(token, value, "int")
    return F.when(problem.isNotNull(), F.raise_error(problem).cast("int")).otherwise(value)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of ``path``; those of a compressed file are spread before any work on them."""
    lines = spark.read.text(path)
    if path.lower().endswith(COMPRESSED):
        # Such a file is one task to read, so it must not also be one task to parse.
        return lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return lines


def parse_sensor_lines(lines: DataFrame) -> DataFrame:
    """Typed readings out of lines ``value`` of space-separated fields.

    Each single space separates two fields and an empty field is NULL. Fields
    missing at the end are NULL, fields past the last sensor are ignored, empty
    lines are skipped, and a field that is no number stops the job.
    """
    suffixed = F.col("value").rlike(_SUFFIXED) & F.col("value").rlike(_SUFFIXED_FIELD)
    n = len(READING_COLUMNS)
    fields = lines.where(F.col("value") != "").select(
        "value", suffixed.alias("_suffixed"), F.split("value", " ", n + 1).alias("_f")
    )

    def field(i: int) -> Column:
        return F.nullif(F.get("_f", F.lit(i)), F.lit(""))

    # Each token is read once; how many tokens and values a line has tells whether one of them is wrong.
    numbers = {name: field(i).try_cast("double") for i, name in enumerate(READING_COLUMNS)}
    numbers |= {name: _integer_of(numbers[name]) for name in READING_COLUMNS[:2]}
    rows = fields.withColumns(numbers)
    tokens = F.size(F.array_remove(F.slice("_f", 1, n), ""))
    values = sum((F.col(c).isNotNull().cast("int") for c in READING_COLUMNS[1:]), F.col(READING_COLUMNS[0]).isNotNull().cast("int"))
    kinds = ["int"] * 2 + ["double"] * (n - 2)
    problems = [_problem(field(i), F.col(c), k) for i, (c, k) in enumerate(zip(READING_COLUMNS, kinds, strict=True))]
    message = F.when(F.col("_suffixed"), F.concat(F.lit("not a sensor line: "), F.col("value"))).otherwise(F.coalesce(*problems))
    good = F.when(F.col("_suffixed") | (tokens != values), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    # A condition on the line, so that columns nobody asks for are checked as well.
    return rows.where(good).select(*READING_COLUMNS)


def read_sensor_text(spark: SparkSession, path: str) -> DataFrame:
    """Readings of a headerless sensor log; any Hadoop path, compressed by extension."""
    return parse_sensor_lines(_lines(spark, path))


def read_truth_text(spark: SparkSession, path: str) -> DataFrame:
    """``id, rul_at_maxcycle`` of a truth file: one integer per line, the id is the line number.

    Several files count on in the order of their paths. A line's number is its
    place in its file split plus the lines of all earlier splits, so no task
    sees more than one split and only one row per split is put in order.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        _integer(F.nullif(F.trim("value"), F.lit(""))).alias("rul_at_maxcycle"),
    )
    # Both uses below must see the same splits, also when executors come and go.
    lines = checkpointed(lines)
    in_order = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("file", "start")
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        .select("file", "start", "first", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("before"))
    )
    number = F.col("before") + F.col("at") - F.col("first") + 1
    return lines.join(splits, ["file", "start"]).select(number.cast("int").alias("id"), "rul_at_maxcycle")
