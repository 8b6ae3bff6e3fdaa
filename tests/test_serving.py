"""Requests, the prediction log and its streams."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigate.operators import requests as rq
from lexigate.streaming import prediction_log as streams


def test_single_requests(spark):
    frame = spark.createDataFrame([(1, "ok"), (2, ""), (3, None), (4, " ")], "id int, text string")
    rows = rq.validate_requests(frame).collect()
    assert {r["id"]: r["reason"] for r in rows} == {
        1: None, 2: "empty_text", 3: "missing_text", 4: None,
    }


def test_batches(spark):
    rows = [("full", "x")] * 100 + [("over", "x")] * 101 + [("gap", "x"), ("gap", None), ("blank", "")]
    rows += [(None, "single"), (None, "")]
    checked = rq.validate_requests(
        spark.createDataFrame(rows, "batch string, text string"), batch_id="batch"
    )
    reasons = {(r["batch"], r["reason"]): r["n"] for r in checked.groupBy("batch", "reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {
        ("full", None): 100,
        ("over", "batch_too_large"): 101,
        ("gap", "missing_text"): 2,
        ("blank", None): 1,
        (None, None): 1,
        (None, "empty_text"): 1,
    }


def test_supplied_features_win(spark):
    frame = spark.createDataFrame(
        [("two words", 99, None), ("two words", None, 7)], "text string, review_length int, word_count int"
    )
    rows = rq.override_features(frame, numeric=("review_length", "word_count", "stars")).collect()
    assert [(r["review_length"], r["word_count"], r["stars"]) for r in rows] == [(99, 2, 0), (9, 7, 0)]


def test_the_log_has_no_text(spark):
    scored = spark.createDataFrame(
        [("secret", "positive", 0.9, 1.5)], "text string, prediction string, confidence double, latency_ms double"
    ).withColumn("ts", F.current_timestamp())
    log = rq.prediction_log(scored)
    assert log.columns == ["ts", "text_length", "prediction", "confidence", "latency_ms"]
    assert log.first()["text_length"] == 6


SCHEMA = "event_id int, ts timestamp_ntz, prediction string, latency_ms double"


def entries(start, n, first_id=0):
    return [
        (first_id + i, start + timedelta(minutes=7 * i), "ab"[i % 3 == 0], float(i % 17))
        for i in range(n)
    ]


def add_file(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def read(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/*")


def test_daily_metrics_equal_the_batch_ones(spark, tmp_path):
    rows = entries(datetime(2024, 3, 1, 20), 500)
    add_file(spark, tmp_path / "in", rows, "one")
    got = streams.run_log_metrics(
        read(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    ).collect()
    groups = {}
    for _, ts, prediction, value in rows:
        groups.setdefault((ts.date(), prediction), []).append(value)
    assert {(r["day"], r["prediction"]): r["n"] for r in got} == {k: len(v) for k, v in groups.items()}
    for r in got:
        values = groups[r["day"], r["prediction"]]
        assert r["mean"] == pytest.approx(np.mean(values))
        assert r["p95"] == pytest.approx(np.percentile(values, 95))


def test_days_are_utc_in_any_session_time_zone(spark, tmp_path):
    add_file(spark, tmp_path / "in", [(1, datetime(2024, 3, 31, 2, 30), "a", 1.0)], "one")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        got = streams.run_log_metrics(
            read(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert str(got["day"]) == "2024-03-31"


def test_totals_survive_a_restart(spark, tmp_path):
    folders = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    add_file(spark, tmp_path / "in", entries(datetime(2024, 1, 1), 30), "one")
    first = streams.run_totals(read(spark, tmp_path / "in"), *folders)
    assert {r["prediction"]: r["total"] for r in first.collect()} == {"a": 20, "b": 10}
    add_file(spark, tmp_path / "in", entries(datetime(2024, 1, 1), 3), "two")
    second = streams.run_totals(read(spark, tmp_path / "in"), *folders)
    assert {r["prediction"]: r["total"] for r in second.collect()} == {"a": 22, "b": 11}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    folders = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    add_file(spark, tmp_path / "in", [(1, datetime(2024, 1, 10), "a", 1.0)], "one")
    streams.run_log_metrics(read(spark, tmp_path / "in"), *folders)
    late = [(2, datetime(2024, 1, 2), "a", 1.0), (3, datetime(2024, 1, 9, 12), "a", 3.0)]
    add_file(spark, tmp_path / "in", late, "two")
    rows = streams.run_log_metrics(read(spark, tmp_path / "in"), *folders).collect()
    assert {str(r["day"]) for r in rows} == {"2024-01-10", "2024-01-09"}


def test_recent_entries_across_restarts(spark, tmp_path):
    folders = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    add_file(spark, tmp_path / "in", entries(datetime(2024, 1, 1), 40), "one")
    table = streams.keep_recent(read(spark, tmp_path / "in"), *folders, n=25)
    assert {r["event_id"] for r in table().collect()} == set(range(15, 40))
    # older entries that arrive later do not push newer ones out
    add_file(spark, tmp_path / "in", entries(datetime(2023, 1, 1), 40, 100), "two")
    add_file(spark, tmp_path / "in", entries(datetime(2024, 2, 1), 5, 200), "three")
    table = streams.keep_recent(read(spark, tmp_path / "in"), *folders, n=25)
    assert {r["event_id"] for r in table().collect()} == set(range(20, 40)) | set(range(200, 205))
