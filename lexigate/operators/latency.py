"""Latency summaries and the recent window of the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.operators.scale import ROWS_PER_RANGE, exact_percentiles

LOG_CAPACITY = 500
RECENT_ROWS = 100


def latency_summary(
    df: DataFrame, latency: str = "latency_ms", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One row: mean, p95, p99 (linear interpolation) rounded to 3 decimals, and the count."""
    summary = exact_percentiles(
        df, latency, {"p95": 0.95, "p99": 0.99}, rows_per_range=rows_per_range
    )
    return summary.select(
        F.round("mean", 3).alias("mean_latency_ms"),
        F.round("p95", 3).alias("p95_latency_ms"),
        F.round("p99", 3).alias("p99_latency_ms"),
        F.col("n").alias("n_runs"),
    )


def recent_log(log: DataFrame, ts: str = "ts", id_column: str = "event_id", n: int = RECENT_ROWS):
    """The last ``n`` log entries; a top-n that each task answers for itself first."""
    return log.orderBy(F.col(ts).desc(), F.col(id_column).desc()).limit(n)


def recent_log_metrics(log: DataFrame, n: int = RECENT_ROWS, **columns) -> DataFrame:
    """One row over the last ``n`` entries: size, mean and p95 latency; 0 for an empty log."""
    recent = recent_log(log, n=n, **columns)
    # at most n values
    return recent.agg(
        F.count("*").alias("window_size"),
        F.coalesce(F.round(F.avg("latency_ms"), 3), F.lit(0.0)).alias("recent_avg_latency_ms"),
        F.coalesce(F.round(F.percentile("latency_ms", 0.95), 3), F.lit(0.0)).alias(
            "recent_p95_latency_ms"
        ),
    ).withColumn("total_predictions", log.agg(F.count("*")).scalar())


def recent_label_distribution(log: DataFrame, n: int = RECENT_ROWS, **columns) -> DataFrame:
    return recent_log(log, n=n, **columns).groupBy("prediction").agg(F.count("*").alias("n"))
