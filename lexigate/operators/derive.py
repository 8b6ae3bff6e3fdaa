"""Derived columns: cleaned text and the two length features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigate.functions import text as tx


def add_derived_columns(
    df: DataFrame,
    text_column: str = "review_text",
    label_column: str = "sentiment",
    id_column: str | None = "row_id",
) -> DataFrame:
    """Project to text, label, clean text, length, words and, if there, ``source``.

    Every value comes from the row's own text. Spark rows have no position, so the row id is
    carried along.
    """
    text = F.col(text_column)
    kept = [id_column] if id_column and id_column in df.columns else []
    tail = ["source"] if "source" in df.columns else []
    return df.select(
        *kept,
        text_column,
        label_column,
        tx.clean_text(text).alias(f"{text_column}_clean"),
        tx.text_length(text).alias("review_length"),
        tx.word_count(text).alias("word_count"),
        *tail,
    )


def add_tokens(df: DataFrame, text_column: str = "review_text", bigrams: bool = False):
    """Add the ``tokens`` array, from the cleaned column if there is one, else the raw text."""
    words = token_column(df, text_column)
    out = df.withColumn("tokens", words)
    return out.withColumn("tokens", tx.with_bigrams(F.col("tokens"))) if bigrams else out


def token_column(df: DataFrame, text_column: str):
    clean = f"{text_column}_clean"
    if clean in df.columns:
        return tx.tokens(F.col(clean))
    if text_column in df.columns:
        return tx.raw_tokens(F.col(text_column))
    raise ValueError(f"No text column {text_column} to take tokens from; rename yours or pass its name")
