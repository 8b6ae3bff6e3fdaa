"""Audits of files, lineage records, gate reports and feature dimensions.

Each audit adds ``violation``: the first rule a record breaks, in a fixed order, or null. JSON is
read as VARIANT, which keeps the type of a value: a number in quotes is not a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.operators.gate import REQUIRED_CHECKS

# type names as VARIANT reports them
NUMBER = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
# an unescaped quote that opens a value (not a key) starting with a slash
ABSOLUTE_PATH = r'(?<!\\)"(?:/|\\/|\\u002[fF])(?:[^"\\]|\\.)*+"(?!\s*:)'


# ---- files ---------------------------------------------------------------------------------


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(file, sha256)`` of every file under a folder, by file name."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file"),
            F.sha2("content", 256).alias("sha256"),
        )
    )


def audit_checksums(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(file, status)``: ok, mismatch, missing, or unexpected when the manifest lacks it."""
    pinned = manifest.select("file", F.col("sha256").alias("pinned"))
    found = actual.select("file", F.col("sha256").alias("found"))
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("pinned").isNull(), "unexpected")
        .when(F.col("found") != F.col("pinned"), "mismatch")
        .otherwise("ok")
    )
    return found.join(pinned, "file", "full_outer").select("file", status.alias("status"))


# ---- JSON records --------------------------------------------------------------------------


def _node(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def _kind(document: Column, path: str) -> Column:
    """Type name of a node; '' if it is not there."""
    return F.coalesce(F.schema_of_variant(_node(document, path)), F.lit(""))


def _is(document: Column, path: str, pattern: str) -> Column:
    return _kind(document, path).rlike(pattern)


def _is_whole(json: str, document: Column, path: str) -> Column:
    """A number spelled without point or exponent; 42.0 is not one, and VARIANT hides that.

    A JSON true counts as whole for whoever writes these records, so it does here.
    """
    spelled_whole = F.get_json_object(json, path).rlike(r"^-?\d+$")
    return _is(document, path, "^BOOLEAN$") | (_is(document, path, NUMBER) & spelled_whole)


def _filled_string(document: Column, path: str) -> Column:
    return (_kind(document, path) == "STRING") & (
        F.coalesce(F.length(F.try_variant_get(document, path, "string")), F.lit(0)) > 0
    )


def _first(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that does not hold."""
    return F.coalesce(
        *[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules]
    )


def audit_lineage(records: DataFrame, lineage: str = "lineage") -> DataFrame:
    """Check lineage records: hash, no absolute paths, feature schema, provenance, split."""
    document = F.col("__v")
    test_size = F.try_variant_get(document, "$.split.test_size", "double")
    parsed = records.withColumn("__v", F.try_parse_json(lineage))
    violation = _first(
        ("not_an_object", _is(document, "$", "^OBJECT")),
        ("data_hash", _filled_string(document, "$.data_hash")),
        ("absolute_path", ~F.col(lineage).rlike(ABSOLUTE_PATH)),
        ("feature_schema", _is(document, "$.feature_schema", "^OBJECT")),
        ("text_column", _is(document, "$.feature_schema.text_column", "^STRING$")),
        ("label_column", _is(document, "$.feature_schema.label_column", "^STRING$")),
        ("numeric_columns", _is(document, "$.feature_schema.numeric_columns", "^ARRAY")),
        ("dataset", _is(document, "$.dataset", "^OBJECT")),
        ("dataset_kind", _filled_string(document, "$.dataset.kind")),
        ("dataset_key", _filled_string(document, "$.dataset.key")),
        ("dataset_license", _filled_string(document, "$.dataset.license")),
        ("split", _is(document, "$.split", "^OBJECT")),
        ("random_state", _is_whole(lineage, document, "$.split.random_state")),
        (
            "test_size",
            _is(document, "$.split.test_size", NUMBER) & (test_size > 0) & (test_size < 1),
        ),
        (
            "stratified",
            _is(document, "$.split.stratified", "^BOOLEAN$")
            & F.try_variant_get(document, "$.split.stratified", "boolean"),
        ),
    )
    return parsed.withColumn("violation", violation).drop("__v")


def audit_gate_reports(
    records: DataFrame, report: str = "report", recorded_hash: str = "lineage_hash"
) -> DataFrame:
    """Check evaluation reports: one may not attest its own pass.

    Every check must restate its source metric, be consistent with its threshold, and add up to
    the overall verdict and the status.
    """
    document = F.col("__v")
    parsed = records.withColumn("__v", F.try_parse_json(report))
    status = F.try_variant_get(document, "$.evaluation_status", "string")
    checks_path = "$.performance_gate.checks"
    names = F.json_object_keys(F.get_json_object(report, checks_path))
    rules = [
        ("not_an_object", _is(document, "$", "^OBJECT")),
        (
            "not_evaluated",
            _is(document, "$.evaluation_status", "^STRING$") & status.isin("passed", "failed"),
        ),
        (
            "hash_mismatch",
            F.try_variant_get(document, "$.data_hash", "string").eqNullSafe(F.col(recorded_hash)),
        ),
        (
            "metrics_or_latency",
            _is(document, "$.metrics", "^OBJECT") & _is(document, "$.latency", "^OBJECT"),
        ),
        ("gate_checks", _is(document, checks_path, "^OBJECT")),
        (
            "gate_inventory",
            F.sort_array(F.array_distinct(names))
            == F.array(*[F.lit(name) for name in sorted(REQUIRED_CHECKS)]),
        ),
    ]
    verdicts = []
    for name, (section, metric, direction) in REQUIRED_CHECKS.items():
        check = f"{checks_path}.{name}"
        paths = (f"$.{section}.{metric}", f"{check}.value", f"{check}.threshold")
        source, value, threshold = (F.try_variant_get(document, p, "double") for p in paths)
        expected = value >= threshold if direction == "minimum" else value <= threshold
        verdicts.append(expected)
        numbers = F.lit(True)
        for path in paths:
            numbers = numbers & _is(document, path, NUMBER)
        rules += [
            (f"{name}_not_an_object", _is(document, check, "^OBJECT")),
            (f"{name}_not_numeric", numbers),
            (f"{name}_not_source", value == source),
            (
                f"{name}_inconsistent",
                _is(document, f"{check}.passed", "^BOOLEAN$")
                & (F.try_variant_get(document, f"{check}.passed", "boolean") == expected),
            ),
        ]
    all_passed = verdicts[0] & verdicts[1] & verdicts[2] & verdicts[3]
    rules += [
        (
            "overall_inconsistent",
            _is(document, "$.performance_gate.overall_passed", "^BOOLEAN$")
            & (
                F.try_variant_get(document, "$.performance_gate.overall_passed", "boolean")
                == all_passed
            ),
        ),
        ("status_inconsistent", (status == "passed") == all_passed),
    ]
    return parsed.withColumn("violation", _first(*rules)).drop("__v")


def audit_dimensions(records: DataFrame) -> DataFrame:
    """Check that vocabulary, scaler, metadata and model agree on the feature dimension.

    Columns: ``tfidf_dim, n_numeric, scaler_dim, expected_dim, metadata_total, model_dim``; a
    null scaler_dim means there is no scaler, a null model_dim that the model does not say.
    """
    expected = F.col("expected_dim")
    scaler_fits = F.when(
        F.col("n_numeric") > 0, F.col("scaler_dim").eqNullSafe(F.col("n_numeric"))
    ).otherwise(F.col("scaler_dim").isNull())
    return records.withColumn(
        "violation",
        _first(
            ("expected_dimension", expected > 0),
            ("scaler_dimension", scaler_fits),
            ("transformer_dimension", F.col("tfidf_dim") + F.col("n_numeric") == expected),
            ("metadata_dimension", F.col("metadata_total") == expected),
            ("model_dimension", F.coalesce("model_dim", "expected_dim") == expected),
        ),
    )
