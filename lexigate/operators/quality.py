"""Data-quality checks and the failure policy.

All checks are answered from one table of distinct row digests: rows are combined map-side into
``(digest, label) -> count``, so one scan and one shuffle of 32-byte digests cover null rates,
duplicates and class balance, and a heavily repeated row never travels more than once per task.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.config import DataRules
from lexigate.functions.hashing import row_digest

logger = logging.getLogger(__name__)


class DataValidationError(RuntimeError):
    """Input data failed a blocking quality check."""


def _share(part, whole):
    # 0/0 is NaN, as the mean of an empty column is
    return F.when(whole == 0, F.lit(float("nan"))).otherwise(
        part.cast("double") / whole.cast("double")
    )


def _row(check: str, column: str | None, value, threshold: float, passed):
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        value.alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
    )


def _null_rows(columns: Sequence[str], threshold: float) -> list:
    """From ``__n`` rows and, under each column's name, its nulls."""
    rows = []
    for name in columns:
        value = _share(F.col(name), F.col("__n"))
        rows.append(
            _row("null_check", name, value, threshold, F.isnan(value) | (value <= threshold))
        )
    return rows


def _duplicate_row(threshold: float):
    value = _share(F.col("__n") - F.col("__distinct"), F.col("__n"))
    return _row("duplicate_check", None, value, threshold, ~F.isnan(value) & (value <= threshold))


def _balance_row(threshold: float):
    value = _share(F.col("__smallest"), F.col("__labelled"))
    return _row("class_balance", None, value, threshold, ~F.isnan(value) & (value >= threshold))


def _report(summary: DataFrame, rows: list) -> DataFrame:
    """The check rows of a one-row summary."""
    return summary.select(F.inline(F.array(*rows)))


def check_nulls(df: DataFrame, max_null_pct: float = 0.05) -> DataFrame:
    """Null share per column; a column violates if its share is above the threshold.

    An empty table has NaN shares, and NaN exceeds nothing, so it passes.
    """
    counts = df.agg(
        F.count("*").alias("__n"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns],
    )
    return _report(counts, _null_rows(df.columns, max_null_pct))


def check_duplicates(
    df: DataFrame, max_dup_pct: float = 0.10, exclude: Sequence[str] = ()
) -> DataFrame:
    """Share of rows that repeat an earlier row in every column; nulls are equal.

    An empty table has a NaN share, which is not within the threshold, so it fails.
    """
    columns = [name for name in df.columns if name not in exclude]
    groups = df.groupBy(row_digest(columns).alias("digest")).agg(F.count("*").alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("__n"), F.count("*").alias("__distinct")
    )
    return _report(counts, [_duplicate_row(max_dup_pct)])


def class_distribution(df: DataFrame, label_column: str) -> DataFrame:
    """Rows and share per class over rows that have a label."""
    counts = (
        df.filter(F.col(label_column).isNotNull())
        .groupBy(F.col(label_column).alias("label"))
        .agg(F.count("*").alias("n"))
    )
    return counts.withColumn(
        "share", _share(F.col("n"), counts.agg(F.sum("n")).scalar())
    )


def check_class_balance(df: DataFrame, label_column: str, min_ratio: float = 0.10) -> DataFrame:
    """Smallest class share against the threshold.

    Without any labelled row there is no smallest share; that fails.
    """
    counts = (
        df.filter(F.col(label_column).isNotNull()).groupBy(label_column).agg(F.count("*").alias("n"))
    )
    smallest = counts.agg(
        F.min("n").alias("__smallest"), F.coalesce(F.sum("n"), F.lit(0)).alias("__labelled")
    )
    return _report(smallest, [_balance_row(min_ratio)])


def run_all_checks(
    df: DataFrame,
    label_column: str,
    rules: DataRules = DataRules(),
    exclude: Sequence[str] = ("row_id",),
    computed: Sequence[str] = (),
) -> DataFrame:
    """Every check as tidy rows, plus an ``overall`` row; without a label no balance check.

    ``exclude`` names carried columns that are not data, such as the row id. ``computed`` names
    columns that follow from the others: they cannot tell two rows apart, so they are left out
    of the digest.
    """
    columns = [name for name in df.columns if name not in exclude]
    has_label = label_column in columns
    keys = [row_digest([c for c in columns if c not in computed]).alias("__digest")]
    if has_label:
        keys.append(F.col(label_column).alias("__label"))
    rows = df.groupBy(*keys).agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    per_label = rows.groupBy(*(["__label"] if has_label else [])).agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("__rows"),
        F.count("*").alias("__distinct"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in columns],
    )
    labelled = F.when(F.col("__label").isNotNull(), F.col("__rows")) if has_label else F.lit(None)
    summary = per_label.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("__n"),
        F.coalesce(F.sum("__distinct"), F.lit(0)).alias("__distinct"),
        F.min(labelled).alias("__smallest"),
        F.coalesce(F.sum(labelled), F.lit(0)).alias("__labelled"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in columns],
    )
    checks = [*_null_rows(columns, rules.max_null_pct), _duplicate_row(rules.max_duplicate_pct)]
    if has_label:
        checks.append(_balance_row(rules.min_class_ratio))
    overall = F.forall("checks", lambda check: check["passed"])
    last = F.struct(
        F.lit("overall").alias("check"),
        F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("double").alias("threshold"),
        overall.alias("passed"),
    )
    return summary.select(F.array(*checks).alias("checks")).select(
        F.inline(F.concat("checks", F.array(last)))
    )


def enforce_validation(report: DataFrame, on_failure: str = "warn") -> None:
    """``error`` raises and names the failed checks; anything else warns and goes on."""
    # one row per column and check
    failed = sorted(
        {
            row["check"]
            for row in report.filter(~F.col("passed")).select("check").distinct().collect()
        }
        - {"overall"}
    )
    if not failed:
        return
    message = f"Data validation failed: {', '.join(failed)}"
    if on_failure == "error":
        raise DataValidationError(f"{message}. Set on_failure to 'warn' to go on anyway.")
    logger.warning("%s (going on because on_failure='%s')", message, on_failure)
