import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexigate.config import Config, DataConfig, DataRules, GateRules, ModelConfig, TrainingConfig
from lexigate.operators.audits import audit_gate_reports, audit_lineage
from lexigate.operators.features import TextFeaturesModel
from lexigate.operators.quality import DataValidationError
from lexigate.plans import lifecycle
from lexigate.sources.provenance import synthetic_provenance
from lexigate.sources.synthetic import synthetic_reviews

CONFIG = Config(
    data=DataConfig(allow_synthetic_fallback=True, prefer_synthetic=True, synthetic_rows=200),
    model=ModelConfig(max_iter=100),
    training=TrainingConfig(cv_folds=3),
    data_rules=DataRules(on_failure="error"),
    gate=GateRules(min_accuracy=0.5, min_f1=0.5, max_latency_ms=500),
)


@pytest.fixture(scope="module")
def latencies(spark):
    return spark.range(200).select((F.col("id") / 100).alias("latency_ms"))


def test_a_run_on_the_fixture_passes(spark, latencies, tmp_path):
    output = str(tmp_path / "run")
    candidate, evaluation, summary = lifecycle.run(spark, CONFIG, latencies, output)
    assert evaluation.passed
    split = json.loads(summary.first()["split"])
    assert (split["train_rows"], split["validation_rows"], split["test_rows"]) == (120, 40, 40)
    assert {r["check"] for r in evaluation.gate.collect()} == {
        "accuracy", "f1_weighted", "accuracy_over_baseline", "latency_p95",
    }
    metrics = evaluation.metrics.first()
    assert metrics["n_rows"] == 40 and 0.5 < metrics["roc_auc"] <= 1
    written = json.loads(spark.read.text(f"{output}/summary").first()[0])
    assert json.loads(written["registry"])["eligible"] is True
    assert spark.read.parquet(f"{output}/curves/roc").count() >= 2
    loaded = TextFeaturesModel.load(f"{output}/features", spark)
    assert loaded.dimension == candidate.classifier.dimension
    report = evaluation.report.first()
    assert report["evaluation_status"] == "passed"
    assert report["data_hash"] == candidate.lineage["data_hash"]
    # what a run records stands up to the audits
    records = evaluation.report.select(
        F.to_json(F.struct("*")).alias("report"), F.col("data_hash").alias("lineage_hash")
    )
    assert audit_gate_reports(records).first()["violation"] is None
    lineage = spark.createDataFrame([(json.dumps(candidate.lineage),)], "lineage string")
    assert audit_lineage(lineage).first()["violation"] is None


def test_a_model_of_another_dimension_is_refused(spark, latencies):
    prepared = lifecycle.prepare(synthetic_reviews(spark, 100), CONFIG)
    candidate = lifecycle.train_candidate(prepared, CONFIG, synthetic_provenance(100, 42))
    candidate.features.terms = candidate.features.terms[:-1]
    with pytest.raises(lifecycle.LineageMismatch, match="transformer_dimension"):
        lifecycle.evaluate_candidate(prepared, candidate, CONFIG, latencies)


def test_an_unreachable_threshold_blocks_and_is_reported(spark, latencies):
    config = replace(CONFIG, gate=replace(CONFIG.gate, min_accuracy=1.01))
    _, evaluation, summary = lifecycle.run(spark, config, latencies)
    assert not evaluation.passed
    registry = json.loads(summary.first()["registry"])
    assert registry["registered"] is False and "accuracy" in registry["reason"]


def test_unfit_data_stops_the_run(spark, latencies):
    rows = synthetic_reviews(spark, 100).withColumn("review_text", F.lit("same text"))
    with pytest.raises(DataValidationError, match="duplicate_check"):
        lifecycle.run_on(rows, CONFIG, synthetic_provenance(100, 42), latencies)


def test_other_data_than_recorded_is_refused(spark, latencies):
    rows = synthetic_reviews(spark, 100)
    prepared = lifecycle.prepare(rows, CONFIG)
    candidate = lifecycle.train_candidate(prepared, CONFIG, synthetic_provenance(100, 42))
    edited = rows.withColumn(
        "review_text",
        F.when(F.col("row_id") == 3, "tampered").otherwise(F.col("review_text")),
    )
    with pytest.raises(lifecycle.LineageMismatch):
        lifecycle.evaluate_candidate(
            lifecycle.prepare(edited, CONFIG), candidate, CONFIG, latencies
        )
    # the split comes from the lineage, so another seed in the config changes nothing
    other = replace(CONFIG, data=replace(CONFIG.data, random_state=7, test_size=0.4))
    a = lifecycle.evaluate_candidate(prepared, candidate, CONFIG, latencies).metrics.first()
    b = lifecycle.evaluate_candidate(prepared, candidate, other, latencies).metrics.first()
    assert a == b
