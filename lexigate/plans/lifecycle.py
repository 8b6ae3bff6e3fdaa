"""The whole lifecycle: acquire, derive, validate, fingerprint, split, fit, train, evaluate, gate."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate import scratch
from lexigate.config import Config
from lexigate.operators import curves as cv
from lexigate.operators.audits import audit_dimensions
from lexigate.operators.derive import add_derived_columns
from lexigate.operators.features import TextFeatures, TextFeaturesModel
from lexigate.operators.fingerprint import data_fingerprint
from lexigate.operators.gate import evaluation_report, promotion_gate
from lexigate.operators.latency import latency_summary
from lexigate.operators.metrics import as_rows, evaluation_metrics
from lexigate.operators.models import Classifier, train_model
from lexigate.operators.quality import enforce_validation, run_all_checks
from lexigate.operators.split import three_way_split
from lexigate.sources.acquire import acquire
from lexigate.sources.sinks import write_curves, write_summary

GATED = ("accuracy", "f1_weighted", "accuracy_over_baseline")


class LineageMismatch(RuntimeError):
    """The data is not what the candidate was trained on."""


@dataclass
class Prepared:
    """Checked data with its fingerprint."""

    frame: DataFrame
    data_hash: str
    n_rows: int
    validation: DataFrame


@dataclass
class Candidate:
    features: TextFeaturesModel
    classifier: Classifier
    training_metrics: DataFrame
    lineage: dict


def computed_columns(text_column: str) -> tuple[str, ...]:
    return (f"{text_column}_clean", "review_length", "word_count")


def prepare(raw: DataFrame, config: Config) -> Prepared:
    """Derive, write to the shared folder, validate (and possibly refuse), fingerprint.

    The derived table is written once: later steps read it back instead of cleaning the text
    again, and a lost executor costs a re-read.
    """
    data = config.data
    spark = raw.sparkSession
    path = scratch.new_path(spark, "derived")
    add_derived_columns(raw, data.text_column, data.label_column, data.id_column).write.parquet(
        path
    )
    frame = spark.read.parquet(path)
    report = run_all_checks(
        frame,
        data.label_column,
        config.data_rules,
        (data.id_column,),
        computed_columns(data.text_column),
    )
    report_rows = report.collect()
    report = spark.createDataFrame(report_rows, report.schema)
    enforce_validation(report, config.data_rules.on_failure)
    fingerprint = data_fingerprint(frame).first()
    return Prepared(frame, fingerprint["data_hash"], fingerprint["n_rows"], report)


def train_candidate(prepared: Prepared, config: Config, provenance: dict[str, str]) -> Candidate:
    """Fit on the training split, score the validation split; the test split is not read."""
    data = config.data
    train, validation, test = _splits(prepared.frame, config)
    features = TextFeatures(
        data.text_column, data.label_column, data.id_column, data.max_features
    ).fit(train)
    wanted = [data.id_column, data.label_column, "features"]
    train_features = features.transform(train).select(*wanted)
    train_features = train_features.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classifier, metrics = train_model(
            train_features,
            features.transform(validation).select(*wanted),
            config,
            data.label_column,
            data.id_column,
        )
        metrics = prepared.frame.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
        training_rows = train_features.count()
    finally:
        train_features.unpersist()
    checks = {
        row["check"]: row
        for row in prepared.validation.filter(F.col("check") != "null_check").collect()
    }
    lineage = {
        "data_hash": prepared.data_hash,
        "data_rows": prepared.n_rows,
        "dataset": provenance,
        "data_validation": {
            "overall_passed": checks["overall"]["passed"],
            "duplicate_percentage": round(checks["duplicate_check"]["value"], 4),
            "min_class_percentage": round(checks["class_balance"]["value"], 4)
            if "class_balance" in checks
            else None,
        },
        "training_rows": training_rows,
        "validation_rows": validation.count(),
        "evaluation_rows": test.count(),
        "feature_schema": {
            "label_column": data.label_column,
            "numeric_columns": features.numeric,
            "text_column": data.text_column,
        },
        "feature_dimension": features.dimension,
        "model_type": config.model.type,
        "split": {
            "random_state": data.random_state,
            "stratified": True,
            "test_size": data.test_size,
            "validation_size": data.validation_size,
        },
    }
    return Candidate(features, classifier, metrics, lineage)


def dimension_record(spark: SparkSession, candidate: Candidate) -> DataFrame:
    """One row for ``audit_dimensions``, from the fitted parts themselves."""
    features = candidate.features
    return spark.createDataFrame(
        [
            (
                len(features.terms),
                len(candidate.lineage["feature_schema"]["numeric_columns"]),
                len(features.scaler) or None,
                candidate.lineage["feature_dimension"],
                features.metadata()["total_features"],
                candidate.classifier.dimension,
            )
        ],
        "tfidf_dim int, n_numeric int, scaler_dim int, expected_dim int, metadata_total int, "
        "model_dim int",
    )


def _splits(frame: DataFrame, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    data = config.data
    return three_way_split(
        frame,
        data.label_column,
        data.id_column,
        data.test_size,
        data.validation_size,
        data.random_state,
    )


@dataclass
class Evaluation:
    metrics: DataFrame
    latency: DataFrame
    gate: DataFrame
    report: DataFrame
    roc: DataFrame | None
    precision_recall: DataFrame | None

    @property
    def passed(self) -> bool:
        return all(row["passed"] for row in self.gate.collect())


def evaluate_candidate(
    prepared: Prepared, candidate: Candidate, config: Config, latency_log: DataFrame
) -> Evaluation:
    """Score the test split recorded in the lineage and apply the gate.

    Split settings come from the lineage, not from the caller, so a split cannot be re-rolled
    until a model passes; other data than the recorded is refused. ``latency_log`` has the
    ``latency_ms`` of served predictions.
    """
    lineage = candidate.lineage
    if lineage["data_hash"] != prepared.data_hash:
        raise LineageMismatch("Evaluation data does not match the candidate lineage")
    split = lineage["split"]
    recorded = replace(
        config,
        data=replace(
            config.data,
            text_column=lineage["feature_schema"]["text_column"],
            label_column=lineage["feature_schema"]["label_column"],
            random_state=split["random_state"],
            test_size=split["test_size"],
            validation_size=split["validation_size"],
        ),
    )
    label = recorded.data.label_column
    spark = prepared.frame.sparkSession
    broken = audit_dimensions(dimension_record(spark, candidate)).first()["violation"]
    if broken:
        raise LineageMismatch(f"Features and model of the candidate disagree: {broken}")
    _, _, test = _splits(prepared.frame, recorded)
    path = scratch.new_path(spark, "scored")
    candidate.classifier.score(candidate.features.transform(test)).select(
        recorded.data.id_column, label, "prediction", "confidence", "score"
    ).write.parquet(path)
    scored = spark.read.parquet(path)
    if scored.count() != lineage["evaluation_rows"]:
        raise LineageMismatch("Test row count does not match the candidate lineage")

    metrics = evaluation_metrics(scored, label, "prediction")
    roc = precision_recall = None
    if len(candidate.classifier.classes) == 2:
        points = cv.score_table(scored, label, "score", candidate.classifier.classes[1])
        roc, precision_recall = cv.roc_curve(points), cv.pr_curve(points)
        metrics = metrics.withColumns(
            {
                "roc_auc": cv.roc_auc(points).scalar(),
                "pr_auc": cv.pr_auc(points).scalar(),
            }
        )
    metrics = spark.createDataFrame(metrics.collect(), metrics.schema)
    latency = latency_summary(latency_log)
    latency = spark.createDataFrame(latency.collect(), latency.schema)
    values = as_rows(metrics, GATED).unionByName(as_rows(latency, ["p95_latency_ms"]))
    gate = promotion_gate(values, config.gate)
    report = evaluation_report(metrics, latency, gate, prepared.data_hash)
    return Evaluation(metrics, latency, gate, report, roc, precision_recall)


def summary_frame(
    prepared: Prepared, candidate: Candidate, evaluation: Evaluation, config: Config
) -> DataFrame:
    """One row of JSON sections, as they go into the run summary."""
    lineage = candidate.lineage
    training = {row["metric"]: row["value"] for row in candidate.training_metrics.collect()}
    failed = sorted(r["check"] for r in evaluation.gate.collect() if not r["passed"])
    sections = {
        "dataset": lineage["dataset"],
        "data_hash": prepared.data_hash,
        "data_validation": lineage["data_validation"],
        "split": {
            **lineage["split"],
            "train_rows": lineage["training_rows"],
            "validation_rows": lineage["validation_rows"],
            "test_rows": lineage["evaluation_rows"],
        },
        "model": {
            **asdict(config.model),
            "feature_dimension": candidate.features.dimension,
        },
        "training_metrics": training,
        "registry": {
            # a run writes no registry event; it says whether one would be accepted
            "registered": False,
            "stage": "none",
            "eligible": not failed,
            "reason": f"gate failed: {failed}" if failed else "no event was written",
        },
    }
    plain = evaluation.report.select(
        F.to_json("metrics").alias("test_metrics"),
        F.to_json("latency").alias("latency"),
        F.to_json("performance_gate").alias("performance_gate"),
    )
    return plain.select(
        *[
            F.lit(value if isinstance(value, str) else json.dumps(value, sort_keys=True)).alias(name)
            for name, value in sections.items()
        ],
        "*",
    )


def run_on(
    raw: DataFrame,
    config: Config,
    provenance: dict[str, str],
    latency_log: DataFrame,
    output: str | None = None,
) -> tuple[Candidate, Evaluation, DataFrame]:
    """Run over given rows. Returns candidate, evaluation and the one-row summary.

    The verdict is in the result either way; a caller that publishes must look at
    ``evaluation.passed``. With ``output`` the curves, summary and fitted features are written.
    """
    prepared = prepare(raw, config)
    candidate = train_candidate(prepared, config, provenance)
    evaluation = evaluate_candidate(prepared, candidate, config, latency_log)
    summary = summary_frame(prepared, candidate, evaluation, config)
    if output:
        spark = raw.sparkSession
        if evaluation.roc is not None:
            write_curves(evaluation.roc, evaluation.precision_recall, f"{output}/curves")
        write_summary(summary, f"{output}/summary")
        candidate.features.save(f"{output}/features", spark)
        candidate.classifier.model.write().overwrite().save(f"{output}/model")
    return candidate, evaluation, summary


def run(
    spark: SparkSession, config: Config, latency_log: DataFrame, output: str | None = None
) -> tuple[Candidate, Evaluation, DataFrame]:
    """Acquire by the configured policy, then ``run_on``."""
    raw, provenance = acquire(spark, config.data)
    return run_on(raw, config, provenance, latency_log, output)
