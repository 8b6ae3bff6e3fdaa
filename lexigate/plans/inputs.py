"""Input views over the driver tables.

Expressions are plain SQL that Spark and DuckDB read alike, so that both sides of a check start
from the same rows. Hash digits stand in for scores and faults; they exercise arithmetic and are
never a quality result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.operators.scale import spread


# tables on which much is done per row, and what to spread them by
SPREAD_KEYS = {
    "documents": "doc_id",
    "lineitem": "l_orderkey",
    "pages": "page_id",
    "conversations": "conv_id",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(frame, SPREAD_KEYS[name]) if name in SPREAD_KEYS else frame


def hex_digit(digest: str, position: int) -> str:
    return f"(instr('0123456789abcdef', substr({digest}, {position}, 1)) - 1)"


def hex_number(digest: str, digits: int, start: int = 1) -> str:
    return "(" + " * 16 + ".join(
        ["(" * (digits - 1) + hex_digit(digest, start)]
        + [hex_digit(digest, start + i) + ")" for i in range(1, digits)]
    ) + ")"


DOC_HASH = "md5(cast(doc_id as string))"
EVENT_HASH = "md5(cast(event_id as string))"

REVIEW_COLUMNS = (
    "doc_id as row_id",
    "text as review_text",
    "case when quality = 1 then 'positive' else 'negative' end as sentiment",
    "source",
)
SCORED_COLUMNS = (
    "doc_id as row_id",
    "case when quality = 1 then 'positive' else 'negative' end as label",
    f"cast({hex_number(DOC_HASH, 3)} + 1500 * quality as double) / 5600 as score",
    f"case when {hex_number(DOC_HASH, 3)} + 1500 * quality >= 2100 then 'positive' "
    "else 'negative' end as prediction",
)
MULTICLASS_COLUMNS = (
    "event_type as label",
    f"case when {hex_digit(EVENT_HASH, 1)} < 4 then 'click' else event_type end as prediction",
)
LOG_COLUMNS = (
    "event_id",
    "ts",
    "event_type as prediction",
    "value as latency_ms",
    "cast(length(props) as int) as text_length",
)
REGISTRY_COLUMNS = (
    "case when user_id % 50 = 13 then 'team/model' "
    "else 'model-' || cast(user_id % 20 as string) end as model",
    "'c' || cast(user_id as string) as version",
    "case event_type when 'signup' then 'none' when 'view' then 'staging' "
    "when 'click' then 'production' when 'purchase' then 'archived' else "
    f"case when {hex_digit(EVENT_HASH, 1)} < 12 then 'staging' else 'retired' end end as new_stage",
    "ts",
    "event_id",
    "value >= 5 as gate_passed",
)

_FAULT = f"substr({DOC_HASH}, 1, 1)"


def _unless(fault: str, value: str, otherwise: str) -> str:
    return f"case when {_FAULT} = '{fault}' then {otherwise} else {value} end"


LINEAGE_COLUMNS = (
    "doc_id as lineage_id",
    "case when " + _FAULT + " = 'f' then '[1, 2]' else "
    "'{\"data_hash\": \"' || " + _unless("0", f"substr({DOC_HASH}, 1, 12)", "''") + " || '\", "
    "\"dataset\": {\"kind\": \"licensed\", \"key\": ' || "
    + _unless("1", "'\"' || source || '\"'", "'7'")
    + " || ', \"name\": \"' || "
    + _unless("2", "source || '.csv'", "'/data/' || source || '.csv'")
    + " || '\", \"license\": \"' || " + _unless("3", "'CC BY 4.0'", "''")
    + " || '\"}, \"feature_schema\": ' || "
    + _unless(
        "4",
        "'{\"text_column\": \"text\", \"label_column\": \"quality\", \"numeric_columns\": ' || "
        + _unless("5", "'[\"n_chars\"]'", "'\"n_chars\"'") + " || '}'",
        "'null'",
    )
    + " || ', \"split\": {\"random_state\": ' || " + _unless("6", "'42'", "'42.5'")
    + " || ', \"stratified\": ' || " + _unless("7", "'true'", "'1'")
    + " || ', \"test_size\": ' || " + _unless("8", "'0.2'", "'1.0'")
    + " || ', \"validation_size\": 0.2}}' end as lineage",
)

_VALUE = f"cast({hex_number(DOC_HASH, 2, 5)} as double) / 256"


def _report_check(name: str, fault: str, threshold: str, value: str, passed: str) -> str:
    return (
        f"'\"{name}\": {{\"value\": ' || "
        + _unless(fault, f"cast({value} as string)", "'0.125'")
        + f" || ', \"threshold\": {threshold}, \"passed\": ' || {passed} || '}}'"
    )


_ACCURACY_OK = f"case when {_VALUE} >= 0.25 then 'true' else 'false' end"
REPORT_COLUMNS = (
    "doc_id as report_id",
    f"substr({DOC_HASH}, 1, 12) as lineage_hash",
    "case when " + _FAULT + " = 'f' then 'not json' else "
    "'{\"data_hash\": \"' || " + _unless("0", f"substr({DOC_HASH}, 1, 12)", "'other'")
    + " || '\", \"evaluation_status\": \"' || "
    + _unless("1", f"case when {_VALUE} >= 0.25 then 'passed' else 'failed' end", "'pending'")
    + " || '\", \"metrics\": {\"accuracy\": ' || cast(" + _VALUE + " as string) || "
    "', \"f1_weighted\": ' || " + _unless("2", "'0.5'", "'true'")
    + " || ', \"accuracy_over_baseline\": 0.375}, \"latency\": {\"p95_latency_ms\": 1.5}, "
    "\"performance_gate\": {\"overall_passed\": ' || "
    + _unless("3", _ACCURACY_OK, "'1'")
    + " || ', \"checks\": {' || "
    + _report_check("accuracy", "4", "0.25", _VALUE, _unless("5", _ACCURACY_OK, "'true'"))
    + " || ', ' || " + _report_check("f1_weighted", "-", "0.25", "0.5", "'true'")
    + " || ', ' || "
    + _report_check("accuracy_over_baseline", "-", "0.25", "0.375", "'true'")
    + " || " + _unless("6", "', ' || " + _report_check("latency_p95", "-", "2", "1.5", "'true'"), "''")
    + " || '}}}' end as report",
)
DIMENSION_COLUMNS = (
    "p_partkey as bundle_id",
    "p_size * 10 as tfidf_dim",
    "p_partkey % 3 as n_numeric",
    "case when p_partkey % 3 = 0 and p_partkey % 7 <> 0 then null "
    "when p_partkey % 11 = 0 then 5 else p_partkey % 3 end as scaler_dim",
    "p_size * 10 + p_partkey % 3 + case when p_partkey % 13 = 0 then 1 else 0 end as expected_dim",
    "p_size * 10 + p_partkey % 3 + case when p_partkey % 17 = 0 then 1 else 0 end "
    "as metadata_total",
    "case when p_partkey % 2 = 0 then null else p_size * 10 + p_partkey % 3 "
    "+ case when p_partkey % 19 = 0 then 1 else 0 end end as model_dim",
)
REQUEST_COLUMNS = {
    "conversations": (
        "conv_id * 10 + turn as request_id",
        "'conv-' || cast(conv_id as string) as batch_id",
        "case when substr(md5(text), 1, 2) = '00' then null else text end as text",
    ),
    "events": (
        "event_id as request_id",
        "'user-' || cast(user_id as string) as batch_id",
        "case when event_id % 997 = 5 then null when event_type = 'error' then '' else props end "
        "as text",
    ),
    "documents": (
        "doc_id as request_id",
        "cast(null as string) as batch_id",
        "case " + _FAULT + " when '0' then '' when '1' then null else text end as text",
    ),
}


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, review_text, sentiment, source)``."""
    return labelled_documents(spark, sf_dir).selectExpr(*REVIEW_COLUMNS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr(*SCORED_COLUMNS)


def multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*MULTICLASS_COLUMNS)


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*LOG_COLUMNS)


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*REGISTRY_COLUMNS)


def lineage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*LINEAGE_COLUMNS)


def gate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*REPORT_COLUMNS)


def dimension_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*DIMENSION_COLUMNS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        table(spark, sf_dir, name).selectExpr(f"'{name}' as channel", *columns)
        for name, columns in REQUEST_COLUMNS.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per document: its text on one line, and for labelled ones a tab and the label."""
    text = F.regexp_replace("text", r"[\t\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", " ")
    label = F.coalesce(F.concat(F.lit("\t"), F.col("quality").cast("string")), F.lit(""))
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("doc_id", F.concat(text, label).alias("value"), "source")
    )
