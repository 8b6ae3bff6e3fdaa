"""Candidates on disk, and the registry that says which of them serves.

A registry is a folder: ``events``, the append-only table that ``operators.registry`` replays, and
``bundles/<model>/<version>``, one folder per saved candidate. An event is written only if the
replay accepts it, and ``gate_passed`` is never taken from the caller: it comes from an audit of
the report that was saved with the candidate. Events of one registry must come from one writer at
a time.
"""

from __future__ import annotations

import datetime
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.config import Config
from lexigate.operators import registry
from lexigate.operators.audits import audit_dimensions, audit_gate_reports, audit_lineage
from lexigate.operators.features import TextFeaturesModel
from lexigate.operators.models import Classifier
from lexigate.plans.lifecycle import Candidate, Evaluation, dimension_record, run_on
from lexigate.sources.sinks import write_summary

EVENTS = (
    "model string, version string, new_stage string, ts timestamp, event_id bigint, "
    "gate_passed boolean"
)
READERS = {
    "logistic_regression": LogisticRegressionModel,
    "random_forest": RandomForestClassificationModel,
    "svm": PipelineModel,
}


class BrokenCandidate(RuntimeError):
    """A saved candidate breaks an audit rule."""


class RefusedTransition(RuntimeError):
    """The registry does not accept a requested stage."""


@dataclass
class Saved:
    """A candidate read back, with the JSON report of its evaluation (None: not evaluated)."""

    candidate: Candidate
    report: str | None


def save_candidate(
    spark: SparkSession, candidate: Candidate, path: str, evaluation: Evaluation | None = None
) -> None:
    """Write features, model, training metrics, lineage and report; never over an older one."""
    candidate.features.save(f"{path}/features", spark)
    candidate.classifier.model.save(f"{path}/model")
    candidate.training_metrics.write.parquet(f"{path}/training_metrics")
    report = None
    if evaluation is not None:
        report = evaluation.report.select(F.to_json(F.struct("*"))).first()[0]
    record = {
        "type": candidate.classifier.type,
        "classes": candidate.classifier.classes,
        "lineage": candidate.lineage,
        "report": report,
    }
    # last, so that a candidate without it is known to be incomplete
    spark.createDataFrame([(json.dumps(record),)], "value string").write.text(f"{path}/record")


def load_candidate(spark: SparkSession, path: str) -> Saved:
    """Read a candidate back; refused if its lineage or its dimensions break a rule."""
    record = json.loads(spark.read.text(f"{path}/record").first()[0])
    classifier = Classifier(
        READERS[record["type"]].load(f"{path}/model"), record["classes"], record["type"]
    )
    candidate = Candidate(
        TextFeaturesModel.load(f"{path}/features", spark),
        classifier,
        spark.read.parquet(f"{path}/training_metrics"),
        record["lineage"],
    )
    lineage = spark.createDataFrame([(json.dumps(record["lineage"]),)], "lineage string")
    for audit in (audit_lineage(lineage), audit_dimensions(dimension_record(spark, candidate))):
        broken = audit.first()["violation"]
        if broken:
            raise BrokenCandidate(f"{path}: {broken}")
    return Saved(candidate, record["report"])


def gate_passed(spark: SparkSession, saved: Saved) -> bool:
    """Did the candidate pass its gate: its report stands up to the audit and says so."""
    if saved.report is None:
        return False
    rows = [(saved.report, saved.candidate.lineage["data_hash"])]
    audited = audit_gate_reports(spark.createDataFrame(rows, "report string, lineage_hash string"))
    if audited.first()["violation"]:
        return False
    return json.loads(saved.report)["evaluation_status"] == "passed"


def events(spark: SparkSession, root: str) -> DataFrame:
    """All events of a registry; none if it is new."""
    try:
        return spark.read.schema(EVENTS).parquet(f"{root}/events")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENTS)


def bundle_path(root: str, model: str, version: str) -> str:
    if not all(name and not {"/", "\\"} & set(name) and ".." not in name for name in (model, version)):
        raise RefusedTransition(f"unsafe_name: {model!r}, {version!r}")
    return f"{root}/bundles/{model}/{version}"


def transition(spark: SparkSession, root: str, model: str, version: str, stage: str) -> None:
    """Append a move to ``stage``, or raise with the reason for which it is refused."""
    passed = gate_passed(spark, load_candidate(spark, bundle_path(root, model, version)))
    past = events(spark, root)
    last = past.agg(F.max("event_id").alias("id"), F.max(F.unix_micros("ts")).alias("ts")).first()
    now = datetime.datetime.now(datetime.timezone.utc)
    event_id = (last["id"] or 0) + 1
    wanted = (
        spark.createDataFrame([(model, version, stage, now, event_id, passed)], EVENTS)
        # a clock that went back must not put the event before earlier ones
        .withColumn("ts", F.greatest("ts", F.timestamp_micros(F.lit(last["ts"] or 0))))
    )
    judged = registry.judge_events(past.filter(F.col("model") == model).unionByName(wanted))
    reason = judged.filter(F.col("event_id") == event_id).first()["reason"]
    if reason:
        raise RefusedTransition(f"{model} {version} to {stage}: {reason}")
    wanted.write.mode("append").parquet(f"{root}/events")


def register(
    spark: SparkSession,
    root: str,
    model: str,
    version: str,
    candidate: Candidate,
    evaluation: Evaluation | None = None,
) -> None:
    """Save a candidate under the registry and enter it, in no stage yet."""
    save_candidate(spark, candidate, bundle_path(root, model, version), evaluation)
    transition(spark, root, model, version, "none")


def promote(spark: SparkSession, root: str, model: str, version: str) -> None:
    """Through staging to production; the version there before is archived by the replay."""
    for stage in ("staging", "production"):
        transition(spark, root, model, version, stage)


def load_production(spark: SparkSession, root: str, model: str) -> Candidate:
    """The candidate that serves; its report is audited again."""
    state = registry.registry_state(events(spark, root))
    row = registry.production_model(state).filter(F.col("model") == model).first()
    if row is None:
        raise RefusedTransition(f"{model} has no production version")
    saved = load_candidate(spark, bundle_path(root, model, row["version"]))
    if not gate_passed(spark, saved):
        raise BrokenCandidate(f"{model} {row['version']}: the report does not stand up to its audit")
    return saved.candidate


def publish(
    spark: SparkSession,
    root: str,
    model: str,
    version: str,
    candidate: Candidate,
    evaluation: Evaluation,
) -> dict:
    """Register, promote if the gate was passed, and say what the event table says."""
    register(spark, root, model, version, candidate, evaluation)
    failed = sorted(r["check"] for r in evaluation.gate.collect() if not r["passed"])
    if not failed:
        promote(spark, root, model, version)
    state = registry.registry_state(events(spark, root)).filter(
        (F.col("model") == model) & (F.col("version") == version)
    )
    row = state.first()
    return {
        "registered": row is not None,
        "stage": row["stage"] if row else "none",
        "version": version,
        "eligible": not failed,
        "reason": f"gate failed: {failed}" if failed else None,
    }


def run_and_publish(
    raw: DataFrame,
    config: Config,
    provenance: dict[str, str],
    latency_log: DataFrame,
    root: str,
    model: str,
    version: str,
    output: str | None = None,
) -> tuple[Candidate, Evaluation, DataFrame]:
    """``lifecycle.run_on``, then ``publish``; the summary states what the registry holds."""
    spark = raw.sparkSession
    candidate, evaluation, summary = run_on(raw, config, provenance, latency_log, output)
    said = publish(spark, root, model, version, candidate, evaluation)
    summary = summary.withColumn("registry", F.lit(json.dumps(said, sort_keys=True)))
    if output:
        write_summary(summary, f"{output}/summary")
    return candidate, evaluation, summary
