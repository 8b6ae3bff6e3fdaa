"""Running statistics of a prediction-log stream.

Each query writes the rows an epoch changed, one folder per epoch, so that a retried epoch
replaces its own output. Readers take the latest epoch per key. State is what Spark checkpoints,
so totals survive a restart.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lexigate.functions.clock import as_instant, utc_day
from lexigate.operators.latency import LOG_CAPACITY, recent_log
from lexigate.operators.scale import ROWS_PER_RANGE, exact_percentiles

logger = logging.getLogger(__name__)


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream a folder of files.

    Without ``files_per_batch`` a backlog is one micro-batch. With it, rows that come behind the
    watermark of an earlier batch are dropped by windowed statistics, and reported.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_table(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream the table ``name`` of a folder of tables, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if any(file.rstrip("/").endswith(f"/{name}.parquet") for file in files):
        return read_stream(spark, folder, schema, f"{name}.parquet", files_per_batch)
    return read_stream(spark, path, schema, files_per_batch=files_per_batch)


def event_time(stream: DataFrame, ts: str = "ts", lateness: str = "1 day") -> DataFrame:
    """Give the stream an event time and a watermark; a zone-less ``ts`` is read as UTC."""
    return stream.withColumn(ts, as_instant(F.col(ts))).withWatermark(ts, lateness)


def latency_counts(log: DataFrame, ts: str = "ts", window: str = "1 day") -> DataFrame:
    """Rows per (window, prediction, latency).

    Exact percentiles need every value of a group; as keys of the state the values are spread
    over all tasks, however hot one prediction is.
    """
    return log.groupBy(
        F.window(ts, window).alias("window"), "prediction", "latency_ms"
    ).agg(F.count("*").alias("n"))


def totals(log: DataFrame) -> DataFrame:
    return log.groupBy("prediction").agg(F.count("*").alias("total"))


def write_changes(changes: DataFrame, output: str, checkpoint: str, mode: str = "update"):
    """Start a query that writes every epoch's changed rows under ``output``."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/epoch={epoch}")

    return (
        changes.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_changes(
    spark: SparkSession, output: str, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Per key, the values of the latest epoch that wrote it."""
    return (
        spark.read.option("basePath", output)
        .parquet(output)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "epoch").alias("__v"))
        .select(*keys, "__v.*")
    )


def log_metrics(
    counts: DataFrame, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Count, mean and exact p95 per key from latency counts."""
    return exact_percentiles(
        counts, "latency_ms", {"p95": 0.95}, keys=keys, weight="n", rows_per_range=rows_per_range
    )


def run_log_metrics(log: DataFrame, output: str, checkpoint: str) -> DataFrame:
    """Drain a log stream and report per (UTC day, prediction).

    Update mode reports open windows too, and drops a window's state once the watermark has
    passed it.
    """
    await_end(write_changes(latency_counts(event_time(log)), output, checkpoint))
    spark = log.sparkSession
    counts = latest_changes(spark, output, ["window", "prediction", "latency_ms"], ["n"])
    daily = counts.withColumn("day", utc_day(F.col("window.start"))).drop("window")
    return log_metrics(daily, ["day", "prediction"])


def run_totals(log: DataFrame, output: str, checkpoint: str) -> DataFrame:
    await_end(write_changes(totals(log), output, checkpoint))
    return latest_changes(log.sparkSession, output, ["prediction"], ["total"])


def keep_recent(
    log: DataFrame, output: str, checkpoint: str, n: int = LOG_CAPACITY, **columns
) -> Callable[[], DataFrame]:
    """Drain a log stream into a table of its last ``n`` entries.

    Each epoch merges its own top ``n`` with the table before it; ``n`` rows is all that is kept.
    The returned function reads the current table.
    """
    spark = log.sparkSession

    def before(epoch: int) -> DataFrame | None:
        done = [e for e in _epochs(spark, output) if e < epoch]
        return spark.read.parquet(f"{output}/epoch={max(done)}") if done else None

    def merge(batch: DataFrame, epoch: int) -> None:
        earlier = before(epoch)
        merged = batch if earlier is None else batch.unionByName(earlier)
        recent_log(merged, n=n, **columns).write.mode("overwrite").parquet(
            f"{output}/epoch={epoch}"
        )

    await_end(
        log.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return lambda: spark.read.parquet(f"{output}/epoch={max(_epochs(spark, output))}")


def _epochs(spark: SparkSession, output: str) -> list[int]:
    """Numbers of the epochs written so far."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(output)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    number = F.regexp_extract("path", r"/epoch=(\d+)/", 1).cast("int")
    return [row[0] for row in files.select(number).distinct().collect()]


def await_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    if late := late_rows(query):
        logger.warning("%d rows came behind the watermark and were dropped", late)


def late_rows(query: StreamingQuery) -> int:
    """State updates dropped behind the watermark, in the progress reports that the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(
        state.numRowsDroppedByWatermark
        for report in query.recentProgress
        for state in report.stateOperators
    )
