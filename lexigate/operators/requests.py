"""Requests before and after scoring: acceptance, feature override, log projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.functions import text as tx
from lexigate.operators.scale import bounded_side

MAX_BATCH = 100


def validate_requests(
    df: DataFrame,
    text: str = "text",
    batch_id: str | None = None,
    max_batch: int = MAX_BATCH,
) -> DataFrame:
    """Add ``accepted`` and ``reason``.

    A row with a null batch id (or no batch column) is a single request and needs a text of at
    least one character. A batch takes 1 to ``max_batch`` texts; a text in it may be empty but
    not null, and a null text refuses the whole batch.
    """
    single = F.when(F.col(text).isNull(), "missing_text").when(F.length(text) == 0, "empty_text")
    if batch_id is None:
        checked = df.withColumn("reason", single)
    else:
        # only the batches at fault are joined back, and a batch of any size counts map-side
        faults = (
            df.filter(F.col(batch_id).isNotNull())
            .groupBy(F.col(batch_id).alias("__batch"))
            .agg(F.count("*").alias("__size"), F.count_if(F.col(text).isNull()).alias("__nulls"))
            .filter((F.col("__size") > max_batch) | (F.col("__nulls") > 0))
        )
        fault = F.when(F.col("__nulls") > 0, "missing_text").when(
            F.col("__size") > max_batch, "batch_too_large"
        )
        checked = (
            df.join(bounded_side(faults), F.col(batch_id) == F.col("__batch"), "left")
            .withColumn("reason", F.when(F.col(batch_id).isNull(), single).otherwise(fault))
            .drop("__batch", "__size", "__nulls")
        )
    return checked.withColumn("accepted", F.col("reason").isNull())


def override_features(
    df: DataFrame,
    text: str = "text",
    numeric: tuple[str, ...] = ("review_length", "word_count"),
) -> DataFrame:
    """Fill numeric features: the supplied value, else the computed one, else 0."""
    computed = {
        "review_length": tx.text_length(F.col(text)),
        "word_count": tx.word_count(F.col(text)),
    }
    filled = {}
    for name in numeric:
        sources = [F.col(name)] if name in df.columns else []
        if name in computed:
            sources.append(computed[name])
        filled[name] = F.coalesce(*sources, F.lit(0))
    return df.withColumns(filled)


def prediction_log(
    scored: DataFrame, ts: str = "ts", text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """What is kept of a scored request: the length of the text, never the text."""
    return scored.select(
        *keep,
        ts,
        tx.text_length(F.col(text)).alias("text_length"),
        "prediction",
        "confidence",
        "latency_ms",
    )
