"""Content fingerprints that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigate.functions import hashing as hx


def data_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: 12-character hash and row count.

    The sum of row digests is order-free, so it needs no sort and combines map-side. Where a
    row sits matters only through the row id, which is therefore part of the content. An instant
    counts by its microseconds, so that the session's time zone does not matter.
    """
    columns = list(columns or df.columns)
    instants = [c for c in columns if isinstance(df.schema[c].dataType, T.TimestampType)]
    df = df.withColumns({c: F.unix_micros(c) for c in instants})
    digest = F.md5(hx.encode_row(columns))
    totals = df.select(hx.hash_int(digest).alias("h")).agg(
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(
            "total"
        ),
        F.count("*").alias("n_rows"),
    )
    content = F.concat(F.col("total").cast("string"), F.lit("|"), F.col("n_rows").cast("string"))
    return totals.select(F.substring(F.sha2(content, 256), 1, 12).alias("data_hash"), "n_rows")


def lineage_match(
    current: DataFrame, recorded_hash: str, recorded_rows: int | None = None
) -> DataFrame:
    """Compare a frame with what a lineage record says about it; one row."""
    same_rows = F.lit(True) if recorded_rows is None else F.col("n_rows") == recorded_rows
    return data_fingerprint(current).select(
        "data_hash",
        F.lit(recorded_hash).alias("recorded_hash"),
        "n_rows",
        (F.col("data_hash") == recorded_hash).alias("hash_matches"),
        ((F.col("data_hash") == recorded_hash) & same_rows).alias("accepted"),
    )


def compare_frames(left: DataFrame, right: DataFrame) -> DataFrame:
    """Equality of two frames of the same columns, by fingerprint; one row."""
    a = data_fingerprint(left, sorted(left.columns))
    b = data_fingerprint(right, sorted(right.columns))
    other = b.select(F.struct("data_hash", "n_rows")).scalar()
    return a.withColumn("other", other).select(
        F.col("data_hash").alias("left_hash"),
        F.col("other.data_hash").alias("right_hash"),
        F.col("n_rows").alias("left_rows"),
        F.col("other.n_rows").alias("right_rows"),
        (
            (F.col("data_hash") == F.col("other.data_hash"))
            & (F.col("n_rows") == F.col("other.n_rows"))
        ).alias("matches"),
    )
