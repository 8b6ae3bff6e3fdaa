"""The promotion gate and the check of results against documented ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.config import GateRules

# fixed values: check -> (section of the report, metric in it, direction)
REQUIRED_CHECKS = {
    "accuracy": ("metrics", "accuracy", "minimum"),
    "f1_weighted": ("metrics", "f1_weighted", "minimum"),
    "accuracy_over_baseline": ("metrics", "accuracy_over_baseline", "minimum"),
    "latency_p95": ("latency", "p95_latency_ms", "maximum"),
}


def gate_thresholds(spark: SparkSession, rules: GateRules = GateRules()) -> DataFrame:
    limits = {
        "accuracy": rules.min_accuracy,
        "f1_weighted": rules.min_f1,
        "accuracy_over_baseline": rules.min_accuracy_over_baseline,
        "latency_p95": rules.max_latency_ms,
    }
    return spark.createDataFrame(
        [
            (name, metric, direction, float(limits[name]))
            for name, (_, metric, direction) in REQUIRED_CHECKS.items()
        ],
        "check string, metric string, direction string, threshold double",
    )


def promotion_gate(values: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """``(check, value, threshold, passed, overall_passed)`` from ``(metric, value)`` rows.

    Metrics are compared unrounded; the latency percentile arrives rounded to 3 decimals. A
    metric that is missing fails its check.
    """
    thresholds = gate_thresholds(values.sparkSession, rules)
    # four thresholds
    checks = F.broadcast(thresholds).join(values, "metric", "left")
    passed = F.when(F.col("direction") == "minimum", F.col("value") >= F.col("threshold")).otherwise(
        F.col("value") <= F.col("threshold")
    )
    result = checks.select(
        "check", "value", "threshold", F.coalesce(passed, F.lit(False)).alias("passed")
    )
    overall = result.agg(F.bool_and("passed")).scalar()
    return result.withColumn("overall_passed", overall)


def evaluation_report(
    metrics: DataFrame, latency: DataFrame, gate: DataFrame, data_hash: str
) -> DataFrame:
    """One row: the nested report that goes with a candidate."""
    checks = gate.agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(F.struct("check", F.struct("value", "threshold", "passed")))
            )
        ).alias("checks"),
        F.bool_and("passed").alias("overall_passed"),
    )
    return checks.select(
        F.lit(data_hash).alias("data_hash"),
        F.when(F.col("overall_passed"), "passed").otherwise("failed").alias("evaluation_status"),
        metrics.select(F.struct(*metrics.columns)).scalar().alias("metrics"),
        latency.select(F.struct(*latency.columns)).scalar().alias("latency"),
        F.struct("overall_passed", "checks").alias("performance_gate"),
    )


def golden_check(
    actual: DataFrame, expected: Mapping[str, float], tolerance: float = 0.02
) -> DataFrame:
    """Compare ``(metric, value)`` rows with documented values; a missing one fails."""
    documented = actual.sparkSession.createDataFrame(
        [(name, float(value)) for name, value in expected.items()],
        "metric string, expected double",
    )
    return documented.join(actual, "metric", "left").select(
        "metric",
        "expected",
        F.col("value").alias("actual"),
        F.coalesce(F.abs(F.col("value") - F.col("expected")) <= tolerance, F.lit(False)).alias(
            "passed"
        ),
    )
