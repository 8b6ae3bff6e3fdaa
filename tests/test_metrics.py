import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigate.config import GateRules
from lexigate.operators import curves, gate, latency, metrics


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label string, prediction string")


def test_confusion_matrix_has_every_pair_of_seen_classes(spark):
    rows = metrics.confusion_matrix(pairs(spark, [("a", "a"), ("a", "c"), ("b", "a")])).collect()
    cells = {(r["label"], r["prediction"]): r["n"] for r in rows}
    assert len(cells) == 9
    assert cells["a", "c"] == cells["b", "a"] == cells["a", "a"] == 1
    assert cells["c", "b"] == 0


def test_scores_by_hand_with_a_class_never_predicted(spark):
    data = pairs(spark, [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] + [("c", "b")])
    rows = {r["label"]: r for r in metrics.class_scores(metrics.pair_counts(data)).collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"]) == (1.0, 0.75)
    assert rows["b"]["precision"] == pytest.approx(1 / 3)
    assert (rows["c"]["precision"], rows["c"]["recall"], rows["c"]["f1"]) == (0.0, 0.0, 0.0)
    total = metrics.classification_metrics(data).first()
    assert total["accuracy"] == pytest.approx(4 / 6)
    assert total["recall_weighted"] == pytest.approx(4 / 6)
    assert total["f1_weighted"] == pytest.approx((4 * rows["a"]["f1"] + rows["b"]["f1"]) / 6)
    report = {r["kind"]: r for r in metrics.classification_report(data).collect() if r["kind"] != "class"}
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)


def test_majority_ties_go_to_the_smallest_label(spark):
    data = pairs(spark, [("b", "b"), ("a", "b"), ("b", "a"), ("a", "a")])
    assert metrics.majority_class(data).first()["label"] == "a"


def test_margin_and_explicit_baseline(spark):
    data = pairs(spark, [("a", "a")] * 6 + [("b", "b")] * 3 + [("b", "a")])
    row = metrics.evaluation_metrics(data).first()
    assert (row["baseline_prediction"], row["baseline_accuracy"]) == ("a", 0.6)
    assert row["accuracy_over_baseline"] == pytest.approx(0.3)
    other = metrics.evaluation_metrics(data, baseline="b").first()
    assert (other["baseline_prediction"], other["baseline_accuracy"]) == ("b", 0.4)


def test_training_majority_may_be_absent_from_the_rows_scored(spark):
    train = pairs(spark, [("z", "z")] * 3)
    row = metrics.baseline_metrics(
        pairs(spark, [("a", "a")]), "label", metrics.majority_class(train)
    ).first()
    assert (row["baseline"], row["accuracy"], row["f1_weighted"]) == ("z", 0.0, 0.0)


def test_fold_summary_uses_the_population_deviation(spark):
    folds = spark.createDataFrame([(0.5,), (0.7,)], "f1_weighted double")
    row = metrics.cv_summary(folds).first()
    assert (row["cv_mean"], row["cv_std"]) == (pytest.approx(0.6), pytest.approx(0.1))


def scored(spark, y, s):
    return spark.createDataFrame(
        [("pos" if a else "neg", float(b)) for a, b in zip(y, s)], "label string, score double"
    )


def brute_areas(y, s):
    """Straight from the definitions, one threshold at a time."""
    y, s = np.asarray(y), np.asarray(s)
    cuts = np.unique(s)[::-1]
    tps = np.array([(y[s >= c] == 1).sum() for c in cuts])
    fps = np.array([(y[s >= c] == 0).sum() for c in cuts])
    tpr, fpr = np.r_[0, tps / tps[-1]], np.r_[0, fps / fps[-1]]
    precision = np.r_[1, tps / (tps + fps)]
    roc = np.sum(np.diff(fpr) * (tpr[1:] + tpr[:-1]) / 2)
    pr = np.sum(np.diff(tpr) * (precision[1:] + precision[:-1]) / 2)
    return roc, pr, cuts, tps, fps


@pytest.mark.parametrize("rows_per_range", [100_000, 40])
def test_curves_against_brute_force(spark, rows_per_range):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.7 + 0.3 * y, 2)
    table = curves.score_table(scored(spark, y, s), rows_per_range=rows_per_range).cache()
    roc, pr, cuts, tps, fps = brute_areas(y, s)
    assert curves.roc_auc(table).first()[0] == pytest.approx(roc)
    assert curves.pr_auc(table).first()[0] == pytest.approx(pr)
    points = curves.roc_curve(table).orderBy(F.col("threshold").desc()).collect()
    # a point stays if the run bends there
    keep = [0, *[
        i for i in range(1, len(cuts) - 1)
        if tps[i + 1] - tps[i] != tps[i] - tps[i - 1] or fps[i + 1] - fps[i] != fps[i] - fps[i - 1]
    ], len(cuts) - 1]
    assert [p["threshold"] for p in points] == [1e9, *[round(float(cuts[i]), 6) for i in keep]]
    assert [p["tpr"] for p in points[1:]] == [round(float(tps[i] / tps[-1]), 6) for i in keep]
    pr_points = curves.pr_curve(table).collect()
    assert len(pr_points) == len(cuts) + 1
    assert [(p["precision"], p["recall"]) for p in pr_points if p["threshold"] is None] == [(1, 0)]


def test_a_mixed_top_score(spark):
    # the first point is (1/2, 1/2): the anchor at precision 1 counts
    table = curves.score_table(scored(spark, [1, 0, 1, 0], [0.9, 0.9, 0.5, 0.1]))
    assert curves.pr_auc(table).first()[0] == pytest.approx(0.5 * 0.75 + 0.5 * (0.5 + 2 / 3) / 2)


def test_curves_need_two_classes(spark):
    with pytest.raises(ValueError, match="two classes"):
        curves.score_table(scored(spark, [1, 1], [0.1, 0.2]))


def gate_rows(spark, accuracy, f1, margin, p95):
    return spark.createDataFrame(
        [
            ("accuracy", accuracy),
            ("f1_weighted", f1),
            ("accuracy_over_baseline", margin),
            ("p95_latency_ms", p95),
        ],
        "metric string, value double",
    )


@pytest.mark.parametrize(
    "values,failed",
    [
        ((0.90, 0.88, 0.40, 5.0), set()),
        ((0.40, 0.35, -0.10, 5.0), {"accuracy", "f1_weighted", "accuracy_over_baseline"}),
        # high accuracy without a margin is not enough
        ((0.95, 0.93, 0.01, 5.0), {"accuracy_over_baseline"}),
        ((0.90, 0.88, 0.40, 100.1), {"latency_p95"}),
        ((0.85, 0.83, 0.20, 100.0), set()),
    ],
)
def test_gate(spark, values, failed):
    rows = gate.promotion_gate(gate_rows(spark, *values), GateRules()).collect()
    assert {r["check"] for r in rows if not r["passed"]} == failed
    assert {r["overall_passed"] for r in rows} == {not failed}


def test_a_missing_metric_fails_its_check(spark):
    rows = gate.promotion_gate(gate_rows(spark, 0.9, 0.9, 0.4, 5.0).filter("metric <> 'accuracy'"))
    assert {r["check"] for r in rows.collect() if not r["passed"]} == {"accuracy"}


def test_documented_values_within_tolerance(spark):
    actual = spark.createDataFrame([("a", 0.5), ("b", 0.53)], "metric string, value double")
    rows = gate.golden_check(actual, {"a": 0.519, "b": 0.5, "c": 0.1}).collect()
    assert {r["metric"]: r["passed"] for r in rows} == {"a": True, "b": False, "c": False}


def test_latency_summary_and_recent_window(spark):
    log = spark.range(250).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.floor(F.col("id") / 10)).alias("ts"),
        F.when(F.col("id") % 4 == 0, "negative").otherwise("positive").alias("prediction"),
        (F.col("id") / 7).alias("latency_ms"),
    )
    values = np.arange(250) / 7
    row = latency.latency_summary(log).first()
    assert row["p95_latency_ms"] == round(float(np.percentile(values, 95)), 3)
    assert row["p99_latency_ms"] == round(float(np.percentile(values, 99)), 3)
    assert row["n_runs"] == 250
    recent = latency.recent_log_metrics(log).first()
    assert recent["window_size"] == 100
    assert recent["recent_p95_latency_ms"] == round(float(np.percentile(values[150:], 95)), 3)
    assert recent["total_predictions"] == 250
    labels = {r["prediction"]: r["n"] for r in latency.recent_label_distribution(log).collect()}
    assert sum(labels.values()) == 100 and labels["negative"] == 25
    empty = latency.recent_log_metrics(log.limit(0)).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0)
