"""ROC and PR curves and their areas, for two classes.

Scores are first counted per distinct value (map-side combined, so a score shared by a third of
the rows is one row), then ranked with ``running``; no task sees the whole curve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigate.operators.metrics import ratio
from lexigate.operators.scale import ROWS_PER_RANGE, range_edges, running

# fixed value: stands for the threshold above every score
TOP_THRESHOLD = 1e9


def score_table(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    positive: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per distinct score: ``pos``, ``neg``, and ``tps``, ``fps`` of the rows at or above it.

    ``positive`` defaults to the second label in sorted order; other than two labels is an error.
    Rows without a score (null or NaN) are left out; infinite scores rank like any other.
    """
    if positive is None:
        positive = positive_label(df, label)
    df = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    counted = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == positive).alias("pos"),
        F.count_if(F.col(label) != positive).alias("neg"),
    )
    totals = counted.select(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    ranked = running(
        counted,
        ["score"],
        sums={"pos_upto": F.col("pos"), "neg_upto": F.col("neg")},
        last_before={"below": F.struct("score", "pos", "neg")},
        edges=range_edges(df, score, rows_per_range),
    )
    return ranked.withColumn("__t", totals.select(F.struct("p", "n")).scalar()).select(
        "score",
        "pos",
        "neg",
        "below",
        F.col("__t.p").alias("p"),
        F.col("__t.n").alias("n"),
        (F.col("__t.p") - F.col("pos_upto") + F.col("pos")).alias("tps"),
        (F.col("__t.n") - F.col("neg_upto") + F.col("neg")).alias("fps"),
    )


def positive_label(df: DataFrame, label: str) -> str:
    """The larger of exactly two labels."""
    labels = [row[0] for row in df.select(label).distinct().orderBy(label).limit(3).collect()]
    if len(labels) != 2:
        raise ValueError(f"Curves need exactly two classes, found {labels}")
    return labels[1]


def roc_curve(scores: DataFrame) -> DataFrame:
    """``(threshold, fpr, tpr)`` without points in the middle of a straight run.

    The start (0, 0) has a threshold above every score, clipped to 1e9.
    """
    first = (F.col("tps") == F.col("pos")) & (F.col("fps") == F.col("neg"))
    last = F.col("below").isNull()
    bend = (F.col("pos") != F.col("below.pos")) | (F.col("neg") != F.col("below.neg"))
    points = scores.filter(first | last | bend).select(
        F.least(F.greatest(F.col("score"), F.lit(-TOP_THRESHOLD)), F.lit(TOP_THRESHOLD)).alias(
            "threshold"
        ),
        ratio(F.col("fps"), F.col("n")).alias("fpr"),
        ratio(F.col("tps"), F.col("p")).alias("tpr"),
    )
    start = scores.sparkSession.createDataFrame(
        [(TOP_THRESHOLD, 0.0, 0.0)], "threshold double, fpr double, tpr double"
    )
    return _rounded(start.unionByName(points))


def roc_auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids, one row."""
    above = F.col("tps") - F.col("pos")
    area = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    return scores.agg(
        ratio(area, F.max("p").cast("double") * F.max("n").cast("double")).alias("roc_auc")
    )


def pr_curve(scores: DataFrame) -> DataFrame:
    """``(threshold, precision, recall)`` per distinct score, and the end (1, 0) without one."""
    points = scores.select(
        F.col("score").alias("threshold"),
        _precision(F.col("tps"), F.col("fps")).alias("precision"),
        ratio(F.col("tps"), F.col("p")).alias("recall"),
    )
    end = scores.sparkSession.createDataFrame(
        [(None, 1.0, 0.0)], "threshold double, precision double, recall double"
    )
    return _rounded(points.unionByName(end))


def pr_auc(scores: DataFrame) -> DataFrame:
    """Area under the PR curve by trapezoids from the anchor (recall 0, precision 1)."""
    tps_above = F.col("tps") - F.col("pos")
    fps_above = F.col("fps") - F.col("neg")
    previous = F.when(tps_above + fps_above == 0, 1.0).otherwise(_precision(tps_above, fps_above))
    here = _precision(F.col("tps"), F.col("fps"))
    step = ratio(F.col("pos"), F.col("p"))
    return scores.agg(F.sum(step * (here + previous) / 2.0).alias("pr_auc"))


def _precision(tps: Column, fps: Column) -> Column:
    return ratio(tps, tps + fps)


def _rounded(points: DataFrame) -> DataFrame:
    return points.select(*[F.round(name, 6).alias(name) for name in points.columns])
