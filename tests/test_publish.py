import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexigate.operators import registry
from lexigate.plans import lifecycle, publish
from lexigate.sources.provenance import synthetic_provenance
from lexigate.sources.synthetic import synthetic_reviews
from lexigate.streaming import scoring
from test_lifecycle import CONFIG


@pytest.fixture(scope="module")
def run(spark):
    prepared = lifecycle.prepare(synthetic_reviews(spark, 100), CONFIG)
    candidate = lifecycle.train_candidate(prepared, CONFIG, synthetic_provenance(100, 42))
    latencies = spark.range(200).select((F.col("id") / 100).alias("latency_ms"))

    def evaluate(config=CONFIG, held=candidate):
        return lifecycle.evaluate_candidate(prepared, held, config, latencies)

    return candidate, evaluate


def test_a_candidate_survives_saving(spark, run, tmp_path):
    candidate, evaluate = run
    evaluation = evaluate()
    publish.save_candidate(spark, candidate, str(tmp_path / "c"), evaluation)
    saved = publish.load_candidate(spark, str(tmp_path / "c"))
    assert saved.candidate.lineage == candidate.lineage
    assert publish.gate_passed(spark, saved)
    # evaluated from disk it measures the same
    assert evaluate(held=saved.candidate).metrics.first() == evaluation.metrics.first()
    with pytest.raises(Exception, match="already exists"):
        publish.save_candidate(spark, candidate, str(tmp_path / "c"), evaluation)


def test_publishing_promotes_and_the_production_model_scores(spark, run, tmp_path):
    candidate, evaluate = run
    root = str(tmp_path / "registry")
    with pytest.raises(publish.RefusedTransition, match="no production"):
        publish.load_production(spark, root, "reviews")
    for version in ("a", "b"):
        said = publish.publish(spark, root, "reviews", version, candidate, evaluate())
        assert (said["registered"], said["stage"]) == (True, "production")
    state = registry.registry_state(publish.events(spark, root)).collect()
    assert {r["version"]: r["stage"] for r in state} == {"a": "archived", "b": "production"}
    served = publish.load_production(spark, root, "reviews")
    requests = spark.createDataFrame(
        [(1, "rain came through the tent"), (2, "a quiet room")], "request_id int, text string"
    )
    ours, theirs = (
        sorted(scoring.score_requests(requests, c.features, c.classifier).collect())
        for c in (candidate, served)
    )
    assert ours == theirs


def test_a_failed_gate_registers_but_does_not_promote(spark, run, tmp_path):
    candidate, evaluate = run
    root = str(tmp_path / "registry")
    failing = replace(CONFIG, gate=replace(CONFIG.gate, min_accuracy=1.01))
    said = publish.publish(spark, root, "reviews", "a", candidate, evaluate(failing))
    assert (said["registered"], said["stage"]) == (True, "none")
    assert "accuracy" in said["reason"]
    with pytest.raises(publish.RefusedTransition, match="not_in_staging"):
        publish.transition(spark, root, "reviews", "a", "production")
    with pytest.raises(publish.RefusedTransition, match="gate_not_passed"):
        publish.transition(spark, root, "reviews", "a", "staging")
    with pytest.raises(publish.RefusedTransition, match="unsafe_name"):
        publish.transition(spark, root, "../reviews", "a", "staging")
    # refused moves left no event
    assert publish.events(spark, root).count() == 1


def test_a_forged_report_is_refused(spark, run, tmp_path):
    candidate, evaluate = run
    failing = replace(CONFIG, gate=replace(CONFIG.gate, min_accuracy=1.01))
    path = str(tmp_path / "c")
    publish.save_candidate(spark, candidate, path, evaluate(failing))
    saved = publish.load_candidate(spark, path)
    report = json.loads(saved.report)
    report["evaluation_status"] = "passed"
    report["performance_gate"]["overall_passed"] = True
    assert not publish.gate_passed(spark, publish.Saved(candidate, json.dumps(report)))
    # thresholds are the report's own; the audit holds it to them
    report["performance_gate"]["checks"]["accuracy"].update(threshold=0.1, passed=True)
    assert publish.gate_passed(spark, publish.Saved(candidate, json.dumps(report)))
    other = {**candidate.lineage, "data_hash": "0" * 12}
    moved = publish.Saved(replace(candidate, lineage=other), json.dumps(report))
    assert not publish.gate_passed(spark, moved)
    assert not publish.gate_passed(spark, publish.Saved(candidate, None))


def test_a_run_states_what_the_registry_holds(spark, tmp_path):
    latencies = spark.range(200).select((F.col("id") / 100).alias("latency_ms"))
    root, output = str(tmp_path / "registry"), str(tmp_path / "run")
    _, evaluation, summary = publish.run_and_publish(
        synthetic_reviews(spark, 100), CONFIG, synthetic_provenance(100, 42), latencies,
        root, "reviews", "a", output,
    )
    assert evaluation.passed
    said = json.loads(summary.first()["registry"])
    assert (said["registered"], said["stage"], said["version"]) == (True, "production", "a")
    written = json.loads(spark.read.text(f"{output}/summary").first()[0])
    assert json.loads(written["registry"]) == said
