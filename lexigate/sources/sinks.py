"""Sinks. Each writes only where it is told to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.operators.fingerprint import data_fingerprint


def data_manifest(df: DataFrame, source: str) -> DataFrame:
    """One row: ``data_hash, source_path, n_rows, n_cols``."""
    return data_fingerprint(df).select(
        "data_hash",
        F.lit(source).alias("source_path"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
    )


def write_manifest(df: DataFrame, source: str, folder: str) -> None:
    data_manifest(df, source).withColumn("timestamp", F.current_timestamp()).write.mode(
        "append"
    ).json(folder)


def write_curves(roc: DataFrame, precision_recall: DataFrame, folder: str) -> None:
    roc.write.mode("overwrite").parquet(f"{folder}/roc")
    precision_recall.write.mode("overwrite").parquet(f"{folder}/precision_recall")


def write_summary(summary: DataFrame, folder: str) -> None:
    """A one-row summary as a JSON line."""
    summary.select(F.to_json(F.struct(*summary.columns)).alias("value")).write.mode(
        "overwrite"
    ).text(folder)
