"""Classification metrics, all computed from the confusion matrix.

The rows are read once, into ``(keys, label, prediction) -> n``; whatever follows works on one row
per pair of classes. ``keys`` allows one result per fold, model or source in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(
        *keys,
        F.col(label).cast("string").alias("label"),
        F.col(prediction).cast("string").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """``(label, prediction, n)`` for every pair of classes seen on either side."""
    pairs = pair_counts(df, label, prediction)
    names = F.explode(F.array("label", "prediction")).alias("name")
    classes = pairs.select(names).agg(F.sort_array(F.collect_set("name")).alias("classes"))
    # the matrix has a cell per pair of classes by definition
    cells = (
        classes.select(F.explode("classes").alias("label"), "classes")
        .select("label", F.explode("classes").alias("prediction"))
    )
    return cells.join(pairs, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def ratio(part: Column, whole: Column) -> Column:
    """Division of doubles with 0 where nothing is there to divide by."""
    return F.when(whole == 0, 0.0).otherwise(part.cast("double") / whole.cast("double"))


def class_scores(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per class: precision, recall, F1, support, from pair counts."""
    sides = F.array(
        F.struct(
            F.col("label").alias("name"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("name"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    sums = (
        pairs.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.name").alias("label"))
        .agg(
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
            F.sum("s.hits").alias("hits"),
        )
    )
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    return (
        sums.withColumns({"precision": precision, "recall": recall})
        .withColumn(
            "f1",
            ratio(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
        .select(*keys, "label", "precision", "recall", "f1", "support", "hits")
    )


def _weighted(name: str) -> Column:
    return ratio(F.sum(F.col(name) * F.col("support")), F.sum("support"))


def summarise(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 from pair counts."""
    return (
        class_scores(pairs, keys)
        .groupBy(*keys)
        .agg(
            ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
            _weighted("f1").alias("f1_weighted"),
            _weighted("precision").alias("precision_weighted"),
            _weighted("recall").alias("recall_weighted"),
            F.sum("support").alias("n_rows"),
        )
    )


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    return summarise(pair_counts(df, label, prediction, keys), keys)


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted averages."""
    scores = class_scores(pair_counts(df, label, prediction))
    rows = scores.select(
        F.lit("class").alias("kind"), "label", "precision", "recall", "f1", "support"
    )
    averages = scores.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("kind"),
                *[
                    ratio(F.sum("hits"), F.sum("support")).alias(name)
                    for name in ("precision", "recall", "f1")
                ],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("kind"),
                *[F.avg(name).alias(name) for name in ("precision", "recall", "f1")],
                F.sum("support").alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("kind"),
                *[_weighted(name).alias(name) for name in ("precision", "recall", "f1")],
                F.sum("support").alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return rows.unionByName(
        averages.withColumn("label", F.lit(None).cast("string")).select(rows.columns)
    )


def majority_class(df: DataFrame, label: str = "label") -> DataFrame:
    """The most frequent label, one row ``(label, n)``; a tie goes to the smallest label."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).cast("string").alias("label"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "label")
        .limit(1)
    )


def baseline_metrics(
    df: DataFrame, label: str = "label", majority: DataFrame | str | None = None
) -> DataFrame:
    """Metrics of always answering one label on ``df``, with that label as ``baseline``.

    ``majority`` is the label itself, or a one-row frame that has it (the training majority);
    by default it is the most frequent label of ``df``.
    """
    if isinstance(majority, str):
        answer = F.lit(majority)
    else:
        chosen = majority if majority is not None else majority_class(df, label)
        answer = chosen.select("label").scalar()
    counts = df.groupBy(F.col(label).cast("string").alias("label")).agg(F.count("*").alias("n"))
    pairs = counts.withColumn("prediction", answer)
    return summarise(pairs, ["prediction"]).withColumnRenamed("prediction", "baseline")


def evaluation_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    baseline: str | None = None,
) -> DataFrame:
    """One row: metrics, baseline metrics and the margin over the baseline."""
    pairs = pair_counts(df, label, prediction)
    baseline_row = baseline_metrics(df, label, baseline).select(
        F.struct("baseline", "accuracy", "f1_weighted")
    )
    return (
        summarise(pairs)
        .withColumn("__base", baseline_row.scalar())
        .select(
            "accuracy",
            "f1_weighted",
            "precision_weighted",
            "recall_weighted",
            "n_rows",
            F.col("__base.baseline").alias("baseline_prediction"),
            F.col("__base.accuracy").alias("baseline_accuracy"),
            F.col("__base.f1_weighted").alias("baseline_f1_weighted"),
            (F.col("accuracy") - F.col("__base.accuracy")).alias("accuracy_over_baseline"),
        )
    )


def cv_summary(fold_scores: DataFrame, score: str = "f1_weighted") -> DataFrame:
    """Mean and population deviation over the folds."""
    return fold_scores.agg(
        F.avg(score).alias("cv_mean"),
        F.stddev_pop(score).alias("cv_std"),
        F.count("*").alias("folds"),
    )


def as_rows(one_row: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """A one-row frame of numbers as ``(metric, value)`` rows."""
    names = list(names or one_row.columns)
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    return one_row.select(F.inline(cells))
