"""The registered queries: operators over the driver tables, whole tables and whole texts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate import scratch
from lexigate.config import Config, DataRules, ModelConfig, reference_config
from lexigate.functions import text as tx
from lexigate.operators import audits, curves, drift, features, fingerprint, gate, latency
from lexigate.operators import metrics, models, quality, registry, split
from lexigate.operators import requests as rq
from lexigate.operators.derive import add_derived_columns, add_tokens
from lexigate.plans import inputs, lifecycle
from lexigate.sources import csv_source, labelled_lines, provenance, sinks, synthetic
from lexigate.streaming import prediction_log as streams
from lexigate.streaming import scoring

RUN = reference_config()
COMPUTED = lifecycle.computed_columns("review_text")

# fixed values: the documented result, with the tolerance it is checked at
DOCUMENTED_METRICS = {
    "accuracy": 0.8067,
    "f1_weighted": 0.8067,
    "roc_auc": 0.8795,
    "pr_auc": 0.8895,
    "baseline_accuracy": 0.5000,
    "accuracy_over_baseline": 0.3067,
}

EVENTS_CUT = datetime.datetime(2024, 1, 16)
SHIP_CUT = datetime.datetime(1995, 6, 17)
LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals: sums of doubles depend on their order."""
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return add_derived_columns(inputs.reviews(spark, sf))


def before_after(df: DataFrame, column: str, cut: datetime.datetime) -> tuple[DataFrame, DataFrame]:
    # by way of text: a timestamp literal would shift with the session time zone
    moment = F.lit(str(cut)).cast("timestamp_ntz")
    return df.filter(F.col(column) < moment), df.filter(F.col(column) >= moment)


# ---- text ----------------------------------------------------------------------------------


def clean_text(spark, sf):
    return inputs.table(spark, sf, "documents").select(
        "doc_id", tx.clean_text(F.col("text")).alias("clean")
    )


def clean_pages(spark, sf):
    return inputs.table(spark, sf, "pages").select(
        "page_id", tx.clean_text(F.col("html")).alias("clean")
    )


def derived_columns(spark, sf):
    return derived(spark, sf)


def tokens(spark, sf):
    frame = add_tokens(derived(spark, sf)).select("row_id", "tokens")
    return frame.select(
        "row_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.concat_ws(" ", "tokens").alias("tokens"),
    )


def raw_tokens(spark, sf):
    frame = inputs.table(spark, sf, "documents")
    return frame.select("doc_id", tx.raw_tokens(F.col("text")).alias("tokens")).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(F.concat_ws(" ", "tokens")).alias("tokens_md5"),
    )


def ngrams(spark, sf):
    frame = inputs.table(spark, sf, "documents").select(
        "doc_id", tx.clean_text(F.col("text")).alias("text_clean")
    )
    return add_tokens(frame, "text", bigrams=True).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_terms"),
        F.md5(F.concat_ws("|", "tokens")).alias("terms_md5"),
    )


# ---- quality -------------------------------------------------------------------------------


def null_check(spark, sf):
    documents = inputs.table(spark, sf, "documents")
    labels = inputs.table(spark, sf, "labels")
    joined = documents.join(labels, "doc_id", "left")
    return rounded(quality.check_nulls(joined, 0.05), 9)


def duplicate_check(spark, sf):
    documents = inputs.table(spark, sf, "documents")
    return rounded(quality.check_duplicates(documents, 0.10, exclude=["doc_id"]), 9)


def class_balance(spark, sf):
    return rounded(quality.check_class_balance(inputs.reviews(spark, sf), "sentiment", 0.10), 9)


def class_distribution(spark, sf):
    return rounded(quality.class_distribution(inputs.table(spark, sf, "events"), "event_type"), 9)


def validation_report(spark, sf):
    report = quality.run_all_checks(
        derived(spark, sf), "sentiment", DataRules(), ("row_id",), COMPUTED
    )
    return rounded(report, 9)


# ---- fingerprints, sources, sinks ----------------------------------------------------------


def data_fingerprint(spark, sf):
    return fingerprint.data_fingerprint(derived(spark, sf))


def data_fingerprint_orders(spark, sf):
    return fingerprint.data_fingerprint(inputs.table(spark, sf, "orders"))


def lineage_match(spark, sf):
    joined = inputs.labelled_documents(spark, sf)
    left = joined.select("doc_id", "text", "quality")
    right = joined.select(
        "doc_id", "text", F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality")).alias("quality")
    )
    return fingerprint.compare_frames(left, right)


def parse_labelled_lines(spark, sf):
    return labelled_lines.parse_labelled_lines(inputs.labelled_lines(spark, sf)).select(
        "doc_id", "review_text", "sentiment", "source"
    )


def parse_quarantine_counts(spark, sf):
    return labelled_lines.quarantine_counts(inputs.labelled_lines(spark, sf))


def csv_roundtrip(spark, sf):
    path = scratch.new_path(spark, "csv")
    reviews = inputs.reviews(spark, sf)
    csv_source.write_csv(reviews, path)
    return csv_source.read_csv(spark, path, schema=reviews.schema, null_words=False)


def synthetic_reviews(spark, sf):
    rows = inputs.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"))
    return synthetic.label_by_position(rows, 42)


def provenance_record(spark, sf):
    return provenance.provenance_of(inputs.table(spark, sf, "documents"), f"{sf}/documents.parquet")


def data_manifest(spark, sf):
    return sinks.data_manifest(inputs.reviews(spark, sf), "user-supplied")


def checksum_audit(spark, sf):
    documents = inputs.table(spark, sf, "documents")
    file = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    actual = documents.select(file.alias("file"), F.sha2("text", 256).alias("sha256"))
    content = F.when(F.col("toxic") == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    pinned = inputs.labelled_documents(spark, sf).select(
        file.alias("file"), F.sha2(content, 256).alias("sha256")
    )
    page = F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html"))
    lost = inputs.table(spark, sf, "pages").select(
        page.alias("file"), F.sha2("html", 256).alias("sha256")
    )
    return audits.audit_checksums(actual, pinned.unionByName(lost))


# ---- splits --------------------------------------------------------------------------------


def stratified_split(spark, sf):
    return split.assign_splits(inputs.reviews(spark, sf)).select("row_id", "sentiment", "split")


def stratified_split_orders(spark, sf):
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return split.assign_splits(orders, "o_orderpriority", "o_orderkey", 0.15, 0.1, 7)


def split_sizes(spark, sf):
    return split.split_sizes(split.assign_splits(inputs.reviews(spark, sf)))


def split_overlap(spark, sf):
    reviews = inputs.reviews(spark, sf)
    path = scratch.new_path(spark, "split")
    split.assign_splits(reviews).select("row_id", "split").write.parquet(path)
    assigned = spark.read.parquet(path)
    parts = {
        name: assigned.filter(F.col("split") == name) for name in ("train", "validation", "test")
    }
    return split.split_overlap(parts, reviews)


def cv_folds(spark, sf):
    return split.assign_folds(inputs.reviews(spark, sf), folds=5).select(
        "row_id", "sentiment", "fold"
    )


def cv_fold_rows(spark, sf):
    """How many training rows of each class every fold holds out."""
    _, train, _, _ = _written(spark, sf)
    return (
        split.assign_folds(train, folds=RUN.training.cv_folds)
        .groupBy("fold", "sentiment")
        .agg(F.count("*").alias("n_rows"))
    )


# ---- features ------------------------------------------------------------------------------


def vocabulary(spark, sf):
    documents = inputs.table(spark, sf, "documents").select(
        "doc_id", tx.clean_text(F.col("text")).alias("text_clean")
    )
    return rounded(features.vocabulary(features.with_terms(documents, "text")), 9)


def tfidf_fit_transform(spark, sf):
    rows = derived(spark, sf)
    return rounded(features.TextFeatures().fit(rows).weights(rows))


def _written(spark, sf):
    """Derived rows, written once and read back: all, train, validation, test."""
    path = scratch.new_path(spark, "derived")
    derived(spark, sf).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows, *split.three_way_split(rows)


def tfidf_transform(spark, sf):
    _, train, validation, test = _written(spark, sf)
    model = features.TextFeatures().fit(train)
    return rounded(model.weights(validation.unionByName(test)))


def scaled_numeric(spark, sf):
    rows, train, _, _ = _written(spark, sf)
    numbers = drift.numeric_columns(train, exclude=["row_id"])
    scaling = features.scaler_statistics(train, numbers).first()["scaling"]
    return rounded(
        rows.select("row_id", *[features.scale_column(*c).alias(c["column"]) for c in scaling])
    )


def leakage_terms(spark, sf):
    _, train, validation, test = _written(spark, sf)
    model = features.TextFeatures().fit(train)
    return features.leakage_terms(
        features.with_terms(train, "review_text"),
        features.with_terms(validation.unionByName(test), "review_text"),
        model.vocabulary_table(spark),
    )


def feature_vectors(spark, sf):
    """The assembled vectors, unfolded to ``(row_id, idx, value)``."""
    _, train, validation, _ = _written(spark, sf)
    model = features.TextFeatures().fit(train)
    sparse = model.transform(validation).select("row_id", F.unwrap_udt("features").alias("v"))
    entries = F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("value"))
    return rounded(
        sparse.select("row_id", F.explode(entries).alias("e")).select("row_id", "e.idx", "e.value")
    )


# ---- metrics -------------------------------------------------------------------------------


def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(inputs.multiclass(spark, sf))


def classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(inputs.scored(spark, sf)))


def classification_report(spark, sf):
    return rounded(metrics.classification_report(inputs.multiclass(spark, sf)))


def majority_baseline(spark, sf):
    train, validation, _ = split.three_way_split(inputs.reviews(spark, sf))
    return rounded(
        metrics.baseline_metrics(
            validation, "sentiment", metrics.majority_class(train, "sentiment")
        )
    )


def baseline_margin(spark, sf):
    return rounded(metrics.evaluation_metrics(inputs.scored(spark, sf)))


def roc_curve(spark, sf):
    return curves.roc_curve(curves.score_table(inputs.scored(spark, sf)))


def roc_auc(spark, sf):
    return rounded(curves.roc_auc(curves.score_table(inputs.scored(spark, sf))), 9)


def pr_curve(spark, sf):
    return curves.pr_curve(curves.score_table(inputs.scored(spark, sf)))


def pr_auc(spark, sf):
    return rounded(curves.pr_auc(curves.score_table(inputs.scored(spark, sf))), 9)


def _lineitem_scores(spark, sf):
    rows = inputs.table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", "returned").otherwise("kept").alias("label"),
        F.col("l_extendedprice").alias("score"),
    )
    return curves.score_table(rows, positive="returned")


def curve_areas_lineitem(spark, sf):
    scores = _lineitem_scores(spark, sf)
    return rounded(
        curves.roc_auc(scores).withColumn("pr_auc", curves.pr_auc(scores).scalar()), 9
    )


def cv_summary(spark, sf):
    folded = split.assign_folds(inputs.scored(spark, sf), "label", "row_id", 5)
    scores = metrics.classification_metrics(folded, keys=["fold"])
    return rounded(metrics.cv_summary(scores))


def latency_summary(spark, sf):
    return latency.latency_summary(inputs.prediction_log(spark, sf))


def _gate_values(spark, sf):
    one_row = metrics.evaluation_metrics(inputs.scored(spark, sf))
    return metrics.as_rows(one_row, lifecycle.GATED).unionByName(
        metrics.as_rows(
            latency.latency_summary(inputs.prediction_log(spark, sf)), ["p95_latency_ms"]
        )
    )


def promotion_gate(spark, sf):
    return rounded(gate.promotion_gate(_gate_values(spark, sf), RUN.gate))


def golden_check(spark, sf):
    scored = inputs.scored(spark, sf)
    scores = curves.score_table(scored)
    names = ["accuracy", "f1_weighted", "baseline_accuracy", "accuracy_over_baseline"]
    actual = (
        metrics.as_rows(metrics.evaluation_metrics(scored), names)
        .unionByName(metrics.as_rows(curves.roc_auc(scores)))
        .unionByName(metrics.as_rows(curves.pr_auc(scores)))
    )
    return rounded(gate.golden_check(actual, DOCUMENTED_METRICS))


def word_count_histogram(spark, sf):
    return rounded(drift.histogram(derived(spark, sf), "word_count", 30))


# ---- drift ---------------------------------------------------------------------------------


def psi(spark, sf):
    before, after = before_after(inputs.table(spark, sf, "events"), "ts", EVENTS_CUT)
    return rounded(drift.compute_psi(before, after, ["value"]), 9)


def ks_statistic(spark, sf):
    before, after = before_after(inputs.table(spark, sf, "events"), "ts", EVENTS_CUT)
    return rounded(drift.ks_two_sample(before, after, ["value"]), 9)


def drift_report(spark, sf):
    before, after = before_after(inputs.table(spark, sf, "lineitem"), "l_shipdate", SHIP_CUT)
    return rounded(drift.check_drift(before, after, LINEITEM_NUMBERS), 9)


# ---- models --------------------------------------------------------------------------------


def _fitted(spark, sf):
    """Fitted features, and those of the three splits."""
    _, train, validation, test = _written(spark, sf)
    model = features.TextFeatures().fit(train)
    wanted = ("row_id", "sentiment", "features")
    return model, *[model.transform(part).select(*wanted) for part in (train, validation, test)]


def _weights(spark, sf, settings: ModelConfig):
    model, train, _, _ = _fitted(spark, sf)
    classifier = models.fit_classifier(train, settings, seed=RUN.data.random_state)
    return models.coefficients(classifier, [*model.terms, *model.numeric])


def train_lr(spark, sf):
    return _weights(spark, sf, RUN.model)


def train_rf(spark, sf):
    return _weights(spark, sf, ModelConfig(type="random_forest"))


def train_svm(spark, sf):
    # the hinge loss has no gradient at its edge, and its fit seldom meets a small tolerance
    return _weights(spark, sf, ModelConfig(type="svm", kernel="linear", max_iter=100))


def train_svm_rbf(spark, sf):
    """Validation metrics of the svm with the kernel of the documented run."""
    _, train, validation, _ = _fitted(spark, sf)
    settings = ModelConfig(type="svm", max_iter=100)
    classifier = models.fit_classifier(train, settings, seed=RUN.data.random_state)
    scored = classifier.score(validation)
    return metrics.as_rows(metrics.classification_metrics(scored, "sentiment", "prediction").drop("n_rows"))


def cv_scores(spark, sf):
    _, train, _, _ = _fitted(spark, sf)
    return models.cross_validate(train, RUN)


def training_metrics(spark, sf):
    _, train, validation, _ = _fitted(spark, sf)
    return models.train_model(train, validation, RUN)[1]


def _scorer(spark, sf):
    model, train, _, _ = _fitted(spark, sf)
    return model, models.fit_classifier(train, RUN.model)


def batch_scoring(spark, sf):
    """Every document, labelled or not, scored by a model fitted on the labelled ones."""
    model, classifier = _scorer(spark, sf)
    documents = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return scoring.score_requests(documents, model, classifier).select(
        "doc_id", "prediction", "confidence"
    )


def weighted_scoring(spark, sf):
    """Validation rows answered by a linear model that is given as a weight table."""
    _, train, validation, _ = _written(spark, sf)
    model = features.TextFeatures().fit(train)
    digits = F.conv(F.substring(F.md5(F.col("idx").cast("string")), 1, 6), 16, 10)
    weights = spark.range(model.dimension).select(F.col("id").cast("int").alias("idx")).select(
        "idx", (digits.cast("double") / (1 << 24) - 0.5).alias("weight")
    )
    scored = models.linear_scores(model.transform(validation), weights, ["negative", "positive"])
    return rounded(scored)


def _lifecycle(spark, sf):
    reviews = inputs.reviews(spark, sf)
    config = Config(gate=RUN.gate)
    record = provenance.local_provenance(f"{sf}/documents.parquet", reviews.count())
    return lifecycle.run_on(reviews, config, record, inputs.prediction_log(spark, sf))


def run_summary(spark, sf):
    return _lifecycle(spark, sf)[2]


def lifecycle_gate(spark, sf):
    return _lifecycle(spark, sf)[1].gate


# ---- audits and registry -------------------------------------------------------------------


def gate_report_audit(spark, sf):
    return audits.audit_gate_reports(inputs.gate_reports(spark, sf)).select(
        "report_id", "violation"
    )


def lineage_audit(spark, sf):
    return audits.audit_lineage(inputs.lineage_records(spark, sf)).select(
        "lineage_id", "violation"
    )


def dimension_audit(spark, sf):
    return audits.audit_dimensions(inputs.dimension_records(spark, sf)).select(
        "bundle_id", "violation"
    )


def registry_state(spark, sf):
    return registry.registry_state(inputs.registry_events(spark, sf)).drop("registered_at")


def registry_illegal_transitions(spark, sf):
    return registry.illegal_transitions(inputs.registry_events(spark, sf)).select(
        "event_id", "model", "version", "new_stage", "reason"
    )


def production_model(spark, sf):
    return registry.production_model(registry.registry_state(inputs.registry_events(spark, sf)))


def serving_eligibility(spark, sf):
    state = registry.registry_state(inputs.registry_events(spark, sf))
    wanted = inputs.table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_id % 97 = 0 then '../outside' else 'model-' || cast(user_id % 20 as string)"
        " || '/v' || cast(event_id % 9 as string) end as bundle_path",
    )
    return registry.serving_eligibility(wanted, state)


# ---- requests and log ----------------------------------------------------------------------


def request_validation(spark, sf):
    return rq.validate_requests(inputs.requests(spark, sf), batch_id="batch_id").select(
        "channel", "request_id", "accepted", "reason"
    )


def feature_override(spark, sf):
    rows = inputs.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        "text",
        F.when(F.col("turn") % 2 == 0, F.col("conv_id") % 50).alias("review_length"),
    )
    return rq.override_features(rows, numeric=("review_length", "word_count", "stars")).drop("text")


def prediction_log_projection(spark, sf):
    scored = inputs.table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("props").alias("text"),
        F.col("event_type").alias("prediction"),
        F.lit(0.5).alias("confidence"),
        F.col("value").alias("latency_ms"),
    )
    return rq.prediction_log(scored, keep=("event_id",))


def recent_log_metrics(spark, sf):
    return latency.recent_log_metrics(inputs.prediction_log(spark, sf))


def recent_label_distribution(spark, sf):
    return latency.recent_label_distribution(inputs.prediction_log(spark, sf))


# ---- streams -------------------------------------------------------------------------------


def _event_stream(spark, sf):
    schema = inputs.table(spark, sf, "events").schema
    stream = streams.stream_table(spark, sf, "events", schema)
    return stream.selectExpr(*inputs.LOG_COLUMNS)


def _folders(spark, name):
    path = scratch.new_path(spark, name)
    return f"{path}/out", f"{path}/checkpoint"


def stream_log_metrics(spark, sf):
    return rounded(streams.run_log_metrics(_event_stream(spark, sf), *_folders(spark, "log")))


def stream_totals(spark, sf):
    return streams.run_totals(_event_stream(spark, sf), *_folders(spark, "totals"))


def stream_recent_log(spark, sf):
    read = streams.keep_recent(_event_stream(spark, sf), *_folders(spark, "recent"))
    return read()


def stream_scoring(spark, sf):
    model, classifier = _scorer(spark, sf)
    schema = inputs.table(spark, sf, "conversations").schema
    stream = streams.stream_table(spark, sf, "conversations", schema)
    scored = scoring.run_scoring(stream, model, classifier, *_folders(spark, "scoring"))
    return scored.select("conv_id", "turn", "prediction", "confidence")


QUERIES = {
    "clean_text": clean_text,
    "clean_pages": clean_pages,
    "derived_columns": derived_columns,
    "tokens": tokens,
    "raw_tokens": raw_tokens,
    "ngrams": ngrams,
    "null_check": null_check,
    "duplicate_check": duplicate_check,
    "class_balance": class_balance,
    "class_distribution": class_distribution,
    "validation_report": validation_report,
    "data_fingerprint": data_fingerprint,
    "data_fingerprint_orders": data_fingerprint_orders,
    "lineage_match": lineage_match,
    "parse_labelled_lines": parse_labelled_lines,
    "parse_quarantine_counts": parse_quarantine_counts,
    "csv_roundtrip": csv_roundtrip,
    "synthetic_reviews": synthetic_reviews,
    "provenance": provenance_record,
    "data_manifest": data_manifest,
    "checksum_audit": checksum_audit,
    "stratified_split": stratified_split,
    "stratified_split_orders": stratified_split_orders,
    "split_sizes": split_sizes,
    "split_overlap": split_overlap,
    "cv_folds": cv_folds,
    "cv_fold_rows": cv_fold_rows,
    "weighted_scoring": weighted_scoring,
    "vocabulary": vocabulary,
    "tfidf_fit_transform": tfidf_fit_transform,
    "tfidf_transform": tfidf_transform,
    "scaled_numeric": scaled_numeric,
    "leakage_terms": leakage_terms,
    "features": feature_vectors,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": classification_metrics,
    "classification_report": classification_report,
    "majority_baseline": majority_baseline,
    "baseline_margin": baseline_margin,
    "roc_curve": roc_curve,
    "roc_auc": roc_auc,
    "pr_curve": pr_curve,
    "pr_auc": pr_auc,
    "curve_areas_lineitem": curve_areas_lineitem,
    "cv_summary": cv_summary,
    "latency_summary": latency_summary,
    "promotion_gate": promotion_gate,
    "golden_check": golden_check,
    "word_count_histogram": word_count_histogram,
    "psi": psi,
    "ks_statistic": ks_statistic,
    "drift_report": drift_report,
    "train_lr": train_lr,
    "train_rf": train_rf,
    "train_svm": train_svm,
    "train_svm_rbf": train_svm_rbf,
    "cv_scores": cv_scores,
    "training_metrics": training_metrics,
    "batch_scoring": batch_scoring,
    "run_summary": run_summary,
    "gate_report_audit": gate_report_audit,
    "lineage_audit": lineage_audit,
    "dimension_audit": dimension_audit,
    "registry_state": registry_state,
    "registry_illegal_transitions": registry_illegal_transitions,
    "production_model": production_model,
    "serving_eligibility": serving_eligibility,
    "request_validation": request_validation,
    "feature_override": feature_override,
    "prediction_log_projection": prediction_log_projection,
    "recent_log_metrics": recent_log_metrics,
    "recent_label_distribution": recent_label_distribution,
    "stream_log_metrics": stream_log_metrics,
    "stream_totals": stream_totals,
    "stream_recent_log": stream_recent_log,
    "stream_scoring": stream_scoring,
}
