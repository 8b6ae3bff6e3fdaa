"""Scoring a stream of requests: the batch transform on a stream, without state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.operators.features import TextFeaturesModel
from lexigate.operators.models import Classifier
from lexigate.operators.requests import override_features, validate_requests
from lexigate.streaming.prediction_log import await_end


def score_requests(
    requests: DataFrame,
    features: TextFeaturesModel,
    classifier: Classifier,
    text: str = "text",
    batch_id: str | None = None,
) -> DataFrame:
    """Accepted requests with ``prediction``, ``confidence`` and ``score``. Batch or stream.

    Requests of one ``batch_id`` are counted together, which only a batch frame allows; on a stream,
    call this per micro-batch.
    """
    if batch_id is not None and requests.isStreaming:
        raise ValueError("batch_id needs a batch frame: score a stream's micro-batches one by one")
    accepted = validate_requests(requests, text, batch_id).filter("accepted")
    ready = override_features(accepted.drop("accepted", "reason"), text, tuple(features.numeric))
    if text != features.text_column:
        ready = ready.withColumn(features.text_column, F.col(text))
    scored = classifier.score(features.transform(ready))
    extra = [features.text_column] if text != features.text_column else []
    return scored.drop("features", *extra)


def run_scoring(
    requests: DataFrame,
    features: TextFeaturesModel,
    classifier: Classifier,
    output: str,
    checkpoint: str,
    text: str = "text",
) -> DataFrame:
    """Drain a request stream into a parquet table and return the table."""
    scored = score_requests(requests, features, classifier, text)
    await_end(
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return requests.sparkSession.read.parquet(output)
