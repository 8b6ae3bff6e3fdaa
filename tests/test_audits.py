import copy
import json

import pytest

from lexigate.operators import audits

LINEAGE = {
    "data_hash": "abc",
    "dataset": {"kind": "synthetic-fixture", "key": "k", "license": "none", "notes": ["x", 'say "/hi']},
    "feature_schema": {"label_column": "sentiment", "numeric_columns": [], "text_column": "t"},
    "split": {"random_state": 42, "stratified": True, "test_size": 0.2, "validation_size": 0.2},
}
CHECKS = {
    "accuracy": {"value": 0.9, "threshold": 0.5, "passed": True},
    "f1_weighted": {"value": 0.8, "threshold": 0.5, "passed": True},
    "accuracy_over_baseline": {"value": 0.4, "threshold": 0.2, "passed": True},
    "latency_p95": {"value": 1.0, "threshold": 500, "passed": True},
}
REPORT = {
    "data_hash": "abc",
    "evaluation_status": "passed",
    "metrics": {"accuracy": 0.9, "f1_weighted": 0.8, "accuracy_over_baseline": 0.4},
    "latency": {"p95_latency_ms": 1.0},
    "performance_gate": {"overall_passed": True, "checks": CHECKS},
}


def edited(record, path, value):
    record = copy.deepcopy(record)
    node = record
    *parents, last = path.split(".")
    for name in parents:
        node = node[name]
    if value is ...:
        del node[last]
    else:
        node[last] = value
    return json.dumps(record)


LINEAGE_CASES = [
    (json.dumps(LINEAGE), None),
    ("not json", "not_an_object"),
    ("[1]", "not_an_object"),
    (edited(LINEAGE, "data_hash", ""), "data_hash"),
    (edited(LINEAGE, "data_hash", 7), "data_hash"),
    (edited(LINEAGE, "dataset.name", "/etc/data.csv"), "absolute_path"),
    (edited(LINEAGE, "dataset.notes", ["ok", "/tmp"]), "absolute_path"),
    (edited(LINEAGE, "dataset./key", "fine"), None),
    (edited(LINEAGE, "feature_schema", "x"), "feature_schema"),
    (edited(LINEAGE, "feature_schema.text_column", ...), "text_column"),
    (edited(LINEAGE, "feature_schema.numeric_columns", "x"), "numeric_columns"),
    (edited(LINEAGE, "dataset", ...), "dataset"),
    (edited(LINEAGE, "dataset.license", ""), "dataset_license"),
    (edited(LINEAGE, "split.random_state", 42.0), "random_state"),
    (edited(LINEAGE, "split.random_state", "42"), "random_state"),
    (edited(LINEAGE, "split.test_size", 1), "test_size"),
    (edited(LINEAGE, "split.test_size", "0.2"), "test_size"),
    (edited(LINEAGE, "split.stratified", 1), "stratified"),
    (edited(LINEAGE, "split.stratified", False), "stratified"),
]


def test_lineage(spark):
    frame = spark.createDataFrame(
        [(i, record) for i, (record, _) in enumerate(LINEAGE_CASES)], "i int, lineage string"
    )
    got = {r["i"]: r["violation"] for r in audits.audit_lineage(frame).collect()}
    assert [got[i] for i in range(len(LINEAGE_CASES))] == [want for _, want in LINEAGE_CASES]


GATE = "performance_gate"
REPORT_CASES = [
    (json.dumps(REPORT), "abc", None),
    (json.dumps(REPORT), "other", "hash_mismatch"),
    (edited(REPORT, "evaluation_status", "pending"), "abc", "not_evaluated"),
    (edited(REPORT, "metrics", ...), "abc", "metrics_or_latency"),
    (edited(REPORT, f"{GATE}.checks", []), "abc", "gate_checks"),
    (edited(REPORT, f"{GATE}.checks.latency_p95", ...), "abc", "gate_inventory"),
    (edited(REPORT, f"{GATE}.checks.extra", {}), "abc", "gate_inventory"),
    (edited(REPORT, f"{GATE}.checks.accuracy", 1), "abc", "accuracy_not_an_object"),
    # true is not a number, nor is a number in quotes
    (edited(REPORT, f"{GATE}.checks.accuracy.value", True), "abc", "accuracy_not_numeric"),
    (edited(REPORT, f"{GATE}.checks.accuracy.value", "0.9"), "abc", "accuracy_not_numeric"),
    (edited(REPORT, "metrics.f1_weighted", 0.81), "abc", "f1_weighted_not_source"),
    # a forged pass
    (edited(REPORT, f"{GATE}.checks.accuracy.threshold", 0.95), "abc", "accuracy_inconsistent"),
    (edited(REPORT, f"{GATE}.checks.latency_p95.passed", 1), "abc", "latency_p95_inconsistent"),
    (edited(REPORT, f"{GATE}.overall_passed", False), "abc", "overall_inconsistent"),
    (edited(REPORT, "evaluation_status", "failed"), "abc", "status_inconsistent"),
    ('{"evaluation_status": "passed", "x": NaN}', "abc", "not_an_object"),
]


def test_gate_reports(spark):
    frame = spark.createDataFrame(
        [(i, report, h) for i, (report, h, _) in enumerate(REPORT_CASES)],
        "i int, report string, lineage_hash string",
    )
    got = {r["i"]: r["violation"] for r in audits.audit_gate_reports(frame).collect()}
    assert [got[i] for i in range(len(REPORT_CASES))] == [want for *_, want in REPORT_CASES]


def test_an_honest_failure_is_not_a_violation(spark):
    report = copy.deepcopy(REPORT)
    report["metrics"]["accuracy"] = report[GATE]["checks"]["accuracy"]["value"] = 0.3
    report[GATE]["checks"]["accuracy"]["passed"] = report[GATE]["overall_passed"] = False
    report["evaluation_status"] = "failed"
    frame = spark.createDataFrame([(json.dumps(report), "abc")], "report string, lineage_hash string")
    assert audits.audit_gate_reports(frame).first()["violation"] is None


@pytest.mark.parametrize(
    "record,want",
    [
        ((10, 2, 2, 12, 12, 12), None),
        ((10, 0, None, 10, 10, None), None),
        ((10, 0, 3, 10, 10, 10), "scaler_dimension"),
        ((10, 2, None, 12, 12, 12), "scaler_dimension"),
        ((10, 2, 2, 13, 13, 13), "transformer_dimension"),
        ((10, 2, 2, 12, None, 12), "metadata_dimension"),
        ((10, 2, 2, 12, 12, 11), "model_dimension"),
        ((0, 0, None, 0, 0, 0), "expected_dimension"),
    ],
)
def test_dimensions(spark, record, want):
    frame = spark.createDataFrame(
        [record],
        "tfidf_dim int, n_numeric int, scaler_dim int, expected_dim int, metadata_total int, model_dim int",
    )
    assert audits.audit_dimensions(frame).first()["violation"] == want


def test_file_checksums(spark, tmp_path):
    import hashlib

    for name in ("a.json", "b.json", "c.json"):
        (tmp_path / name).write_bytes(name.encode())
    pinned = {
        "a.json": hashlib.sha256(b"a.json").hexdigest(),
        "b.json": hashlib.sha256(b"tampered").hexdigest(),
        "d.json": "0" * 64,
    }
    manifest = spark.createDataFrame(list(pinned.items()), "file string, sha256 string")
    status = audits.audit_checksums(audits.file_digests(spark, str(tmp_path)), manifest)
    assert {r["file"]: r["status"] for r in status.collect()} == {
        "a.json": "ok", "b.json": "mismatch", "c.json": "unexpected", "d.json": "missing",
    }
