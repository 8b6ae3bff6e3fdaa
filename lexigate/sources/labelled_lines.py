"""Reader for ``<sentence><tab><0 or 1>`` files, with the skipped lines counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.config import LABEL_NAMES
from lexigate.functions.text import strip_whitespace

# fixed values: what ends a line for a Python str beyond \n, \r and \r\n, which the text source
# already splits at
EXTRA_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


class DatasetIntegrityError(RuntimeError):
    """The files do not hold what they should."""


def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(value, source)``; the source is the file stem without ``_labelled`` and ``_cells``."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    source = F.replace(
        F.replace(stem, F.lit("_labelled"), F.lit("")), F.lit("_cells"), F.lit("")
    )
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    return lines.select("value", source.alias("source"))


def classify_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``review_text``, ``sentiment`` and ``status`` (ok, blank, bad) per line.

    The label is what follows the last tab. A line that does not carry a valid one is never
    guessed at.
    """
    split = lines.withColumn("__line", F.explode(F.split(value, EXTRA_LINE_ENDS))).withColumn(
        "__line", strip_whitespace(F.col("__line"))
    )
    line = F.col("__line")
    tail = F.substring_index(line, "\t", -1)
    label = strip_whitespace(tail)
    name = F.coalesce(*[F.when(label == code, text) for code, text in LABEL_NAMES.items()])
    body = strip_whitespace(F.substr(line, F.lit(1), F.length(line) - F.length(tail) - 1))
    status = (
        F.when(line == "", "blank")
        .when(line.contains("\t") & name.isNotNull(), "ok")
        .otherwise("bad")
    )
    good = F.col("status") == "ok"
    return (
        split.withColumn("status", status)
        .withColumn("review_text", F.when(good, body))
        .withColumn("sentiment", F.when(good, name))
        .drop("__line", value)
    )


def parse_labelled_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    return classify_lines(lines, value).filter(F.col("status") == "ok").drop("status")


def quarantine_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(source, parsed, skipped)``; blank lines are neither."""
    return classify_lines(lines, value).groupBy("source").agg(
        F.count_if(F.col("status") == "ok").alias("parsed"),
        F.count_if(F.col("status") == "bad").alias("skipped"),
    )


def read_labelled_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Parsed rows with a row id; no labelled row at all is an error."""
    rows = parse_labelled_lines(read_lines(spark, path, pattern))
    if rows.isEmpty():
        raise DatasetIntegrityError(f"No labelled rows parsed from {path}")
    return rows.select(
        F.monotonically_increasing_id().alias("row_id"), "review_text", "sentiment", "source"
    )
