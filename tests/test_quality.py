import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigate.config import DataRules
from lexigate.operators import drift, fingerprint, quality


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_null_share_above_the_threshold_fails(spark):
    frame = spark.range(100).select(F.when(F.col("id") < 50, 1).alias("a"), F.lit(1).alias("b"))
    rows = {r["column"]: r for r in quality.check_nulls(frame, 0.05).collect()}
    assert (rows["a"]["value"], rows["a"]["passed"]) == (0.5, False)
    assert rows["b"]["passed"]
    assert quality.check_nulls(frame, 0.5).filter("not passed").isEmpty()


def test_duplicates_count_every_repeat_and_treat_nulls_as_equal(spark):
    frame = spark.createDataFrame(
        [("a", None), ("a", None), ("a", "x"), ("a", None), (None, "a")], "p string, q string"
    )
    row = only(quality.check_duplicates(frame, 0.4))
    assert row["value"] == pytest.approx(0.4)
    assert row["passed"]
    assert not only(quality.check_duplicates(frame, 0.39))["passed"]


def test_field_borders_matter(spark):
    frame = spark.createDataFrame([("a", "bc"), ("ab", "c")], "p string, q string")
    assert only(quality.check_duplicates(frame))["value"] == 0


def test_balance_ignores_rows_without_a_label(spark):
    frame = spark.createDataFrame([("a",)] * 9 + [("b",)] + [(None,)] * 10, "sentiment string")
    assert only(quality.check_class_balance(frame, "sentiment", 0.1))["passed"]
    assert not only(quality.check_class_balance(frame, "sentiment", 0.11))["passed"]


def test_all_checks_agree_with_the_single_ones(spark):
    rows = [(i, "t" if i % 4 else None, "ab"[i % 5 == 0], i % 7) for i in range(60)]
    frame = spark.createDataFrame(rows, "row_id int, review_text string, sentiment string, w int")
    report = {(r["check"], r["column"]): r for r in quality.run_all_checks(frame, "sentiment").collect()}
    plain = frame.drop("row_id")
    for single in (
        quality.check_nulls(plain),
        quality.check_duplicates(plain),
        quality.check_class_balance(plain, "sentiment"),
    ):
        for row in single.collect():
            assert report[row["check"], row["column"]] == row
    assert report["overall", None]["passed"] is False


def test_without_a_label_there_is_no_balance_check(spark):
    report = quality.run_all_checks(spark.range(3), "sentiment", exclude=())
    assert {r["check"] for r in report.collect()} == {"null_check", "duplicate_check", "overall"}


def test_an_empty_table_passes_nulls_and_fails_duplicates(spark):
    empty = spark.createDataFrame([], "review_text string, sentiment string")
    rows = {r["check"]: r for r in quality.run_all_checks(empty, "sentiment").collect()}
    assert rows["null_check"]["passed"] and math.isnan(rows["null_check"]["value"])
    assert not rows["duplicate_check"]["passed"]
    assert not rows["class_balance"]["passed"]


def test_failure_policy(spark):
    frame = spark.createDataFrame([(None, "positive")] * 10, "review_text string, sentiment string")
    report = quality.run_all_checks(frame, "sentiment")
    with pytest.raises(quality.DataValidationError, match="duplicate_check, null_check"):
        quality.enforce_validation(report, "error")
    quality.enforce_validation(report, "warn")
    good = spark.range(10).selectExpr("string(id) as t", "string(id % 2) as sentiment")
    quality.enforce_validation(quality.run_all_checks(good, "sentiment", DataRules()), "error")


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def numpy_psi(reference, current, buckets=10):
    edges = np.linspace(
        min(reference.min(), current.min()), max(reference.max(), current.max()), buckets + 1
    )
    r = np.histogram(reference, edges)[0] + 1
    c = np.histogram(current, edges)[0] + 1
    r, c = r / r.sum(), c / c.sum()
    return float(((c - r) * np.log(c / r)).sum())


def test_psi_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 800), rng.normal(0.7, 1.4, 500)
    row = only(drift.compute_psi(numbers(spark, a), numbers(spark, b), ["x"]))
    assert row["psi"] == pytest.approx(numpy_psi(a, b))
    same = only(drift.compute_psi(numbers(spark, a), numbers(spark, a), ["x"]))
    assert abs(same["psi"]) < 1e-12


def test_psi_stays_finite_on_disjoint_and_constant_columns(spark):
    apart = only(drift.compute_psi(numbers(spark, [0] * 100), numbers(spark, [50] * 100), ["x"]))
    assert math.isfinite(apart["psi"]) and apart["psi"] > 1
    constant = only(drift.compute_psi(numbers(spark, [3] * 10), numbers(spark, [3] * 40), ["x"]))
    assert constant["psi"] == pytest.approx(numpy_psi(np.full(10, 3.0), np.full(40, 3.0)))


@pytest.mark.parametrize("rows_per_range", [100_000, 100])
def test_ks_against_numpy(spark, rows_per_range):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 60, 700) / 2, rng.integers(10, 70, 400) / 2
    row = only(drift.ks_two_sample(numbers(spark, a), numbers(spark, b), ["x"], rows_per_range))
    every = np.union1d(a, b)
    gaps = [abs((a <= v).mean() - (b <= v).mean()) for v in every]
    assert row["ks_statistic"] == pytest.approx(max(gaps))
    assert 0 <= row["ks_pvalue"] < 1e-6
    same = only(drift.ks_two_sample(numbers(spark, a), numbers(spark, a), ["x"]))
    assert (same["ks_statistic"], same["ks_pvalue"]) == (0, 1)


def test_drift_passes_on_psi_alone_and_skips_absent_columns(spark):
    rng = np.random.default_rng(5)
    a = numbers(spark, rng.normal(0, 1, 5000)).withColumn("y", F.col("x")).withColumn("z", F.col("x"))
    b = numbers(spark, rng.normal(0.12, 1, 5000)).withColumn("y", F.col("x") + 9)
    rows = {r["column"]: r for r in drift.check_drift(a, b).collect()}
    assert set(rows) == {"x", "y"}
    assert rows["x"]["passed"] and rows["x"]["ks_pvalue"] < 0.05
    assert not rows["y"]["passed"]


def test_histogram_has_its_empty_buckets(spark):
    rows = drift.histogram(numbers(spark, [0, 0, 1, 9, 10, 10]), "x", 5).orderBy("bucket").collect()
    assert [r["n"] for r in rows] == [3, 0, 0, 0, 3]
    assert (rows[0]["low"], rows[4]["high"]) == (0, 10)


def test_fingerprint_follows_content_not_partitions(spark):
    frame = spark.range(500).selectExpr("id as row_id", "string(id * 7) as t", "nullif(id, 3) as n")
    first = only(fingerprint.data_fingerprint(frame))["data_hash"]
    assert len(first) == 12
    for parts in (1, 7, 64):
        assert only(fingerprint.data_fingerprint(frame.repartition(parts)))["data_hash"] == first
    edited = frame.withColumn("t", F.when(F.col("row_id") == 77, "x").otherwise(F.col("t")))
    assert only(fingerprint.data_fingerprint(edited))["data_hash"] != first
    # swapping two rows' places is a change: the row id is content
    moved = frame.withColumn(
        "row_id", F.when(F.col("row_id") == 1, 2).when(F.col("row_id") == 2, 1).otherwise(F.col("row_id"))
    )
    assert only(fingerprint.data_fingerprint(moved))["data_hash"] != first
    assert only(fingerprint.lineage_match(frame, first, 500))["accepted"]
    assert not only(fingerprint.lineage_match(frame, first, 499))["accepted"]
    assert not only(fingerprint.lineage_match(edited, first, 500))["accepted"]
