"""TF-IDF and scaled numeric features, fitted on the training rows only.

``TextFeatures.fit(train)`` is the only thing here that learns; ``TextFeaturesModel.transform``
cannot. Both avoid shuffling the corpus:

* fit: each row emits its tokens and, after them, its distinct ones; a single map-side combined
  ``groupBy(term)`` then has document frequency and corpus count, so only distinct terms move;
* transform: a map-only step. One Arrow UDF takes the cleaned text, looks up its words and pairs of
  neighbours in the vocabulary (at most ``max_features`` terms) and returns the vector; a row's terms,
  of which there are many more than entries, are never a column.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexigate.functions import text as tx
from lexigate.operators.derive import token_column
from lexigate.operators.drift import numeric_columns

MIN_DOCUMENTS = 2


def term_statistics(df: DataFrame, terms: str = "terms") -> DataFrame:
    """``(term, df, tf)``: rows that contain the term, and its occurrences."""
    # plain strings told apart by position: structs would be built and copied one by one
    entries = F.concat("__terms", F.array_distinct("__terms"))
    occurs = F.col("pos") < F.col("__n")
    return (
        df.select(F.col(terms).alias("__terms"), F.size(terms).alias("__n"))
        .select("__n", F.posexplode(entries).alias("pos", "term"))
        .groupBy("term")
        .agg(F.count_if(~occurs).alias("df"), F.count_if(occurs).alias("tf"))
    )


def vocabulary(
    df: DataFrame,
    terms: str = "terms",
    max_features: int = 10_000,
    min_df: int = MIN_DOCUMENTS,
    n_rows: int | None = None,
) -> DataFrame:
    """``(term, idx, df, tf, idf)`` of the most frequent terms, numbered alphabetically.

    Rare terms go first, then the top ``max_features`` by corpus count stay; a tie at the limit
    goes to the term that sorts first. ``n_rows`` defaults to the row count of ``df``.
    """
    top = (
        term_statistics(df, terms)
        .filter(F.col("df") >= min_df)
        .orderBy(F.col("tf").desc(), F.col("term"))
        .limit(max_features)
    )
    # at most max_features rows from here on
    numbered = top.withColumn(
        "idx", F.row_number().over(Window.orderBy("term")).cast("int") - 1
    )
    rows = F.lit(n_rows) if n_rows is not None else df.agg(F.count("*")).scalar()
    return numbered.withColumn("__rows", rows).select(
        "term", "idx", "df", "tf", idf(F.col("__rows"), F.col("df")).alias("idf")
    )


def idf(rows: Column, document_frequency: Column) -> Column:
    return F.log((1.0 + rows) / (1.0 + document_frequency)) + 1.0


def with_terms(df: DataFrame, text_column: str) -> DataFrame:
    """Add ``terms``: the row's words and bigrams."""
    worded = df.withColumn("__words", token_column(df, text_column))
    return worded.withColumn("terms", tx.with_bigrams(F.col("__words"))).drop("__words")


def scaler_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``n_rows`` and, per column, ``scaling`` of (column, mean, scale).

    A null counts as 0; the deviation is the population's, and 0 becomes 1.
    """
    cells = []
    for name in columns:
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        deviation = F.stddev_pop(value)
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.avg(value).alias("mean"),
                F.when(deviation == 0, 1.0).otherwise(deviation).alias("scale"),
            )
        )
    return df.agg(F.count("*").alias("n_rows"), F.array(*cells).alias("scaling"))


def scale_column(name: str, mean: float, scale: float) -> Column:
    return (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) - F.lit(mean)) / F.lit(scale)


class TextFeatures(Estimator):
    """Learns vocabulary, document frequencies and numeric scaling from training rows."""

    def __init__(
        self,
        text_column: str = "review_text",
        label_column: str = "sentiment",
        id_column: str = "row_id",
        max_features: int = 10_000,
        min_df: int = MIN_DOCUMENTS,
        numeric: list[str] | None = None,
    ):
        super().__init__()
        self.text_column = text_column
        self.label_column = label_column
        self.id_column = id_column
        self.max_features = max_features
        self.min_df = min_df
        self.numeric = numeric

    def _fit(self, dataset: DataFrame) -> TextFeaturesModel:
        numeric = self.numeric
        if numeric is None:
            numeric = numeric_columns(
                dataset,
                exclude=(
                    self.text_column,
                    f"{self.text_column}_clean",
                    self.label_column,
                    self.id_column,
                ),
            )
        statistics = scaler_statistics(dataset, numeric).first()
        n_rows = statistics["n_rows"]
        terms = with_terms(dataset, self.text_column)
        learned = vocabulary(
            terms, max_features=self.max_features, min_df=self.min_df, n_rows=n_rows
        )
        # at most max_features rows
        rows = sorted(learned.collect(), key=lambda row: row["idx"])
        if not rows:
            raise ValueError("No terms remain after dropping those of fewer rows than min_df")
        return TextFeaturesModel(
            terms=[row["term"] for row in rows],
            document_frequencies=[row["df"] for row in rows],
            corpus_counts=[row["tf"] for row in rows],
            idf=[row["idf"] for row in rows],
            scaler=[tuple(column) for column in statistics["scaling"]],
            n_rows=n_rows,
            text_column=self.text_column,
            label_column=self.label_column,
        )


class TextFeaturesModel(Model):
    """Fitted state and the map-only transform."""

    def __init__(
        self,
        terms: list[str],
        document_frequencies: list[int],
        corpus_counts: list[int],
        idf: list[float],
        scaler: list[tuple[str, float, float]],
        n_rows: int,
        text_column: str = "review_text",
        label_column: str = "sentiment",
    ):
        super().__init__()
        self.terms = terms
        self.document_frequencies = document_frequencies
        self.corpus_counts = corpus_counts
        self.idf = idf
        self.scaler = scaler
        self.n_rows = n_rows
        self.text_column = text_column
        self.label_column = label_column

    @property
    def numeric(self) -> list[str]:
        return [name for name, _, _ in self.scaler]

    @property
    def dimension(self) -> int:
        return len(self.terms) + len(self.scaler)

    def metadata(self) -> dict:
        return {
            "tfidf_features": len(self.terms),
            "tfidf_vocab_size": len(self.terms),
            "numeric_columns": self.numeric,
            "total_features": self.dimension,
        }

    def vocabulary_table(self, spark: SparkSession) -> DataFrame:
        rows = zip(
            self.terms,
            range(len(self.terms)),
            self.document_frequencies,
            self.corpus_counts,
            self.idf,
            strict=True,
        )
        return spark.createDataFrame(
            list(rows), "term string, idx int, df bigint, tf bigint, idf double"
        )

    def scaler_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.scaler, "column string, mean double, scale double"
        )

    def _clean(self, df: DataFrame) -> Column:
        """The cleaned text, which is made of the raw one if there is no column of it."""
        clean = f"{self.text_column}_clean"
        if clean in df.columns:
            return F.col(clean).cast("string")
        if self.text_column not in df.columns:
            raise ValueError(f"The rows have no text column {self.text_column}; rename yours or set text_column")
        return tx.clean_text(F.col(self.text_column))

    def weights(self, df: DataFrame, id_column: str = "row_id") -> DataFrame:
        """Long form ``(id, term, weight)`` of the TF-IDF part; unknown terms have no row."""
        terms = F.from_json(F.lit(json.dumps(self.terms)), "array<string>")
        found = df.select(id_column, _weighted(self.terms, self.idf)(self._clean(df)).alias("__found"))
        entries = F.arrays_zip(
            F.col("__found.indices").alias("idx"), F.col("__found.values").alias("weight")
        )
        return (
            found.select(id_column, F.explode(entries).alias("e"))
            .select(id_column, F.get(terms, F.col("e.idx")).alias("term"), "e.weight")
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        missing = [name for name in self.numeric if name not in dataset.columns]
        if missing:
            raise ValueError(f"These numeric columns were there at the fit and are not now: {missing}; derive them first")
        scaled = [scale_column(*column) for column in self.scaler]
        vector = _weighted(self.terms, self.idf, len(scaled))
        return dataset.withColumn("features", vector(self._clean(dataset), *scaled))

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the fitted state as two tables and a metadata record."""
        self.vocabulary_table(spark).write.mode("errorifexists").parquet(f"{path}/vocabulary")
        self.scaler_table(spark).write.mode("errorifexists").parquet(f"{path}/scaler")
        record = {
            **self.metadata(),
            "n_rows": self.n_rows,
            "text_column": self.text_column,
            "label_column": self.label_column,
        }
        spark.createDataFrame([(json.dumps(record),)], "value string").write.text(
            f"{path}/metadata"
        )

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> TextFeaturesModel:
        record = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        # at most max_features rows
        rows = sorted(
            spark.read.parquet(f"{path}/vocabulary").collect(), key=lambda row: row["idx"]
        )
        scaling = {r["column"]: r for r in spark.read.parquet(f"{path}/scaler").collect()}
        model = cls(
            terms=[row["term"] for row in rows],
            document_frequencies=[row["df"] for row in rows],
            corpus_counts=[row["tf"] for row in rows],
            idf=[row["idf"] for row in rows],
            scaler=[
                (name, scaling[name]["mean"], scaling[name]["scale"])
                for name in record["numeric_columns"]
            ],
            n_rows=record["n_rows"],
            text_column=record["text_column"],
            label_column=record["label_column"],
        )
        if model.dimension != record["total_features"]:
            raise ValueError(
                f"The saved record speaks of {record['total_features']} features and the model has "
                f"{model.dimension}; save both again"
            )
        return model


@lru_cache(maxsize=1)
def _logarithms() -> list[float]:
    """Of small counts, by the library that Spark's own ``log`` uses: vectors agree in every bit."""
    log = SparkContext.getOrCreate()._jvm.java.lang.StrictMath.log
    return [-math.inf, *(log(float(n)) for n in range(1, 256))]


def _weighted(terms: list[str], idf_values: list[float], numbers: int | None = None):
    """Arrow UDF from cleaned text to its non-zero TF-IDF entries, unit length, by place.

    With a count of ``numbers`` these follow as further columns, and the result is the vector of all.
    Defined inside a function so that it ships by value and executors need no package.
    """
    size, logs = len(terms) + (numbers or 0), _logarithms()

    def build(clean: pd.Series, *scaled: pd.Series) -> pd.DataFrame:
        words = {term: i for i, term in enumerate(terms) if " " not in term}
        pairs = {tuple(term.split(" ")): i for i, term in enumerate(terms) if term.count(" ") == 1}
        weigh = np.array(idf_values)
        tail = np.arange(len(terms), size, dtype=np.int32)
        numeric = np.stack([s.to_numpy(np.float64) for s in scaled], axis=1) if scaled else None
        indices, values = [], []
        for row, text in enumerate(clean):
            found = [word for word in text.split(" ") if len(word) >= 2]
            counts = Counter(map(words.get, found))
            counts.update(map(pairs.get, zip(found, found[1:])))
            counts.pop(None, None)
            places = np.array(sorted(counts), dtype=np.int32)
            times = [counts[i] for i in places.tolist()]
            raw = (1.0 + np.array([logs[n] if n < len(logs) else math.log(n) for n in times])) * weigh[places]
            if len(raw):
                # added up in order of place
                raw /= math.sqrt(np.cumsum(raw * raw)[-1])
            indices.append(np.concatenate([places, tail]))
            values.append(raw if numeric is None else np.concatenate([raw, numeric[row]]))
        found = {"indices": indices, "values": values}
        return pd.DataFrame(found if numbers is None else {"type": 0, "size": size, **found})

    if numbers is None:
        return F.pandas_udf(build, "indices array<int>, values array<double>")
    return F.pandas_udf(build, VectorUDT())


def leakage_terms(train: DataFrame, held_out: DataFrame, learned: DataFrame) -> DataFrame:
    """One row: vocabulary size, terms seen only outside training, and how many leaked in.

    ``train`` and ``held_out`` have ``terms``; ``learned`` is a vocabulary table.
    """
    def terms(df: DataFrame, inside: bool) -> DataFrame:
        return df.select(
            F.explode(F.array_distinct("terms")).alias("term"), F.lit(inside).alias("inside")
        )

    only_outside = (
        terms(train, True)
        .unionByName(terms(held_out, False))
        .groupBy("term")
        .agg(F.bool_or("inside").alias("inside"))
        .filter(~F.col("inside"))
    )
    # at most max_features terms
    known = learned.select("term", F.lit(1).alias("learned"))
    return (
        only_outside.join(known, "term", "left")
        .agg(F.count("*").alias("outside_only_terms"), F.count("learned").alias("leaked_terms"))
        .select(
            learned.agg(F.count("*")).scalar().alias("vocabulary_terms"),
            "outside_only_terms",
            "leaked_terms",
        )
    )
