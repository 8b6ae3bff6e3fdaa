"""Deterministic labelled fixture for tests and offline runs; never a quality result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigate.functions.hashing import hash_int

# any sentences do: what counts is two balanced classes and texts that differ
POSITIVE_TEMPLATES = (
    "the soup was warm and the bread came fresh from the oven",
    "our guide knew every path and the view was splendid",
    "a quiet room with a wide bed and a garden below",
    "the band played two hours and nobody sat down",
    "clear photographs and a chapter on birds that delighted me",
)
NEGATIVE_TEMPLATES = (
    "the bus left early and the next one never arrived",
    "rain came through the tent and the ground was mud",
    "the plot stops halfway and the jokes fall flat",
    "cold coffee again and a queue out to the street",
    "the museum was shut although the board said open",
)


def synthetic_reviews(spark: SparkSession, n: int = 400, seed: int = 42) -> DataFrame:
    """``n`` rows: even ids positive, odd ids negative, each text numbered by its row."""
    return label_by_position(spark.range(n).withColumnRenamed("id", "row_id"), seed)


def label_by_position(rows: DataFrame, seed: int = 42) -> DataFrame:
    """The fixture over given row ids."""
    position = F.col("row_id")
    draw = hash_int(F.md5(F.concat(F.lit(f"{seed}:"), position.cast("string"))), 8)
    index = (draw % len(POSITIVE_TEMPLATES)).cast("int")

    def pick(templates: tuple[str, ...]) -> Column:
        return F.get(F.array(*[F.lit(t) for t in templates]), index)

    even = position % 2 == 0
    text = F.when(even, pick(POSITIVE_TEMPLATES)).otherwise(pick(NEGATIVE_TEMPLATES))
    return rows.select(
        "row_id",
        F.concat(text, F.lit(" number "), position.cast("string")).alias("review_text"),
        F.when(even, "positive").otherwise("negative").alias("sentiment"),
        F.lit("synthetic").alias("source"),
    )
