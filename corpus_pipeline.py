"""A training-data pipeline over ``documents``: classify, deduplicate, decontaminate, redact, mix.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The caller
writes a stage's result as Parquet and reads it back as the next one's docs; ``run`` does so in the
shared folder. Rows without text are empty texts throughout; extra columns are carried along; an
empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.llm import decontaminate, mixing, pii, quality, simhash
from lexigate.llm.queries import QUALITY_LEAST, table
from lexigate.scratch import new_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at least ``QUALITY_LEAST``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.quality_score(F.col("text"), model) >= QUALITY_LEAST)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near duplicates.

    Classes are those of ``op6_simhash``: fingerprints of four-word shingles, linked at four bits.
    """
    return simhash.representatives(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; ``n_chars`` is kept true."""
    redacted = docs.withColumn("text", pii.redacted(F.col("text"), pii.train(docs)))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        redacted = redacted.withColumn(
            "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length)
        )
    return redacted


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how many of their words it takes, repeats counted."""
    names = {name.lower() for name in docs.columns}
    added = {
        name: f"mix_{name}" if name in names else name
        for name in ("size", "source_size", "target", "taken")
    }
    return (
        mixing.mix(docs, keep=docs.columns)
        .filter("taken > 0")
        .select("row.*", *(F.col(name).alias(alias) for name, alias in added.items()))
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", not_in_benchmark),
    ("personal data", without_private),
    ("source mix", mixed_sources),
]

# Stages score with fitted models and XXH64 fingerprints, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES, 1):
        path = new_path(spark, f"pipeline-{place}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
