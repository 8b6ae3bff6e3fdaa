"""Drift between two versions of a numeric table, and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigate.operators.scale import ROWS_PER_RANGE, range_edges, running

KS_SERIES_TERMS = 100
KS_EXACT_ROWS = 10_000  # per side; fixed value: the documented call counts paths up to here


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in exclude
    ]


def equal_width_edges(low: float, high: float, buckets: int) -> list[float]:
    step = (high - low) / buckets
    return [low + i * step for i in range(buckets)] + [high]


def bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """Index of the bucket with edge <= value; the last bucket is closed.

    Edges are literals, so no engine can bin a boundary value differently.
    """
    index = F.lit(0)
    for edge in edges[1:-1]:
        index = index + F.when(value >= F.lit(edge), 1).otherwise(0)
    return index


def _long(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, side, value)`` without nulls; side 0 is the reference."""

    def unpivot(df: DataFrame, side: int) -> DataFrame:
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                for c in columns
            ]
        )
        return (
            df.select(F.explode(cells).alias("cell"))
            .select("cell.column", F.lit(side).alias("side"), "cell.value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        )

    return unpivot(reference, 0).unionByName(unpivot(current, 1))


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, in_reference, in_current)``: what the KS statistic starts from."""
    return (
        _long(reference, current, columns)
        .groupBy("column", "value")
        .agg(
            F.count_if(F.col("side") == 0).alias("in_reference"),
            F.count_if(F.col("side") == 1).alias("in_current"),
        )
    )


def value_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column; one scan, one row to the driver."""
    cells = []
    for name in columns:
        value = F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double"))
        cells += [F.min(value), F.max(value)]
    row = df.agg(*cells).first()
    return {
        name: (row[2 * i], row[2 * i + 1])
        for i, name in enumerate(columns)
        if row[2 * i] is not None
    }


def compute_psi(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Population stability index per column: ``(column, n_reference, n_current, psi)``.

    Equal-width buckets over the joint range, one added to every bucket count so that an empty
    bucket stays finite. Rows are binned where they are read; only bucket counts are shuffled.
    """
    bounds = value_bounds(
        reference.select(*columns).unionByName(current.select(*columns)), columns
    )
    bucket = F.lit(None).cast("int")
    for name in bounds:
        edges = equal_width_edges(*bounds[name], buckets)
        bucket = F.when(F.col("column") == name, bucket_of(F.col("value"), edges)).otherwise(
            bucket
        )
    counted = (
        _long(reference, current, columns)
        .groupBy("column", bucket.alias("bucket"))
        .agg(
            F.count_if(F.col("side") == 0).alias("in_reference"),
            F.count_if(F.col("side") == 1).alias("in_current"),
        )
    )

    def bucket_counts(side: str) -> Column:
        return F.array(
            *[
                F.coalesce(F.sum(F.when(F.col("bucket") == i, F.col(side))), F.lit(0))
                for i in range(buckets)
            ]
        )

    histograms = counted.groupBy("column").agg(
        bucket_counts("in_reference").alias("reference"),
        bucket_counts("in_current").alias("current"),
    )

    def total(counts: str) -> Column:
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, n: acc + n)

    totals = histograms.withColumns(
        {"n_reference": total("reference"), "n_current": total("current")}
    )
    terms = F.zip_with(
        "reference",
        "current",
        lambda r, c: _psi_term(
            (r + 1).cast("double") / (F.col("n_reference") + buckets),
            (c + 1).cast("double") / (F.col("n_current") + buckets),
        ),
    )
    return totals.select(
        "column",
        "n_reference",
        "n_current",
        F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term).alias("psi"),
    )


def _psi_term(reference_share: Column, current_share: Column) -> Column:
    return (current_share - reference_share) * F.log(current_share / reference_share)


def ks_two_sample(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Two-sample KS per column: ``(column, ks_statistic, ks_pvalue)``.

    The statistic is exact. So is the p-value if neither side has more than ``KS_EXACT_ROWS`` values;
    beyond that it is the asymptotic series.
    """
    edges = range_edges(_long(reference, current, columns), "value", rows_per_range)
    return _ks(value_counts(reference, current, columns), edges)


def _ks(values: DataFrame, edges: Sequence[float]) -> DataFrame:
    totals = values.groupBy("column").agg(
        F.sum("in_reference").alias("n_reference"), F.sum("in_current").alias("n_current")
    )
    ranked = running(
        values,
        ["value"],
        sums={"upto_reference": F.col("in_reference"), "upto_current": F.col("in_current")},
        keys=["column"],
        edges=edges,
    )
    # totals has one row per column of the schema
    # (a column without values on one side has no statistic)
    gap = F.abs(
        F.try_divide(F.col("upto_reference"), F.col("n_reference"))
        - F.try_divide(F.col("upto_current"), F.col("n_current"))
    )
    statistic = (
        ranked.join(F.broadcast(totals), "column")
        .groupBy("column")
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.max("n_reference").alias("n_reference"),
            F.max("n_current").alias("n_current"),
        )
    )
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    scaled = F.col("ks_statistic") * F.sqrt(n * m / (n + m))
    exact = _exact_pvalues(F.col("n_reference"), F.col("n_current"), F.col("ks_statistic"))
    return statistic.withColumn("__scaled", scaled).select(
        "column",
        "ks_statistic",
        F.coalesce(exact, ks_pvalue(F.col("__scaled"))).alias("ks_pvalue"),
    )


@F.arrow_udf(T.DoubleType())
def _exact_pvalues(n: pa.Array, m: pa.Array, statistic: pa.Array) -> pa.Array:
    """A row per column; null where the samples are too large or there is no statistic."""
    found = []
    for a, b, d in zip(n.to_pylist(), m.to_pylist(), statistic.to_pylist(), strict=True):
        small = d is not None and max(a, b) <= KS_EXACT_ROWS
        found.append(exact_ks_pvalue(a, b, round(d * math.lcm(a, b))) if small else None)
    return pa.array(found, pa.float64())


def exact_ks_pvalue(n: int, m: int, steps: int) -> float:
    """Chance that two samples of a continuous law lie ``steps`` / lcm(n, m) or more apart.

    All orders of the pooled sample are equally likely: they are the lattice paths from (0, 0) to
    (n, m). A path is far at (i, j) if |i / n - j / m| reaches the distance. The share of paths to a
    point that were far on the way is the mean of its two predecessors' shares, weighed by i and j;
    only sums of positive numbers occur, so small chances keep their digits. Points further from the
    diagonal than the distance are far, hence one antidiagonal after another needs a band alone.
    """
    if steps <= 0:
        return 1.0
    limit, total = steps * math.gcd(n, m), n + m
    half = limit // total + 2
    offset = np.arange(2 * half + 2)
    first, share = -half, np.where(offset == half, 0.0, 1.0)
    for s in range(1, total + 1):
        moved = s * n // total - half
        shift, first = moved - first, moved
        i = first + offset
        before = np.concatenate([[1.0], share, [1.0]])
        left = np.clip(i / s, 0.0, 1.0)
        share = left * before[shift : shift + len(i)] + (1 - left) * before[shift + 1 : shift + 1 + len(i)]
        share[np.abs(i * total - s * n) >= limit] = 1.0
    return float(share[n - first])


def ks_pvalue(scaled: Column) -> Column:
    """2 * sum of (-1)^(k-1) exp(-2 k^2 x^2); below x = 0.2 the value is 1 to 12 digits."""
    series = F.lit(0.0)
    for k in range(1, KS_SERIES_TERMS + 1):
        series = series + F.lit(float((-1) ** (k - 1))) * F.exp(
            F.lit(-2.0 * k * k) * scaled * scaled
        )
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series))
    )


def check_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    max_psi: float = 0.2,
    buckets: int = 10,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """KS and PSI per column. Only PSI decides ``passed``; KS is there to be read.

    Columns default to the reference's numeric ones; columns the current version lacks are
    skipped, nulls are dropped.
    """
    wanted = list(columns) if columns is not None else numeric_columns(reference)
    wanted = [c for c in wanted if c in current.columns]
    psi = compute_psi(reference, current, wanted, buckets)
    ks = ks_two_sample(reference, current, wanted, rows_per_range)
    return psi.join(ks, "column").select(
        "column", "ks_statistic", "ks_pvalue", "psi", (F.col("psi") <= max_psi).alias("passed")
    )


def histogram(df: DataFrame, column: str, buckets: int = 30) -> DataFrame:
    """Equal-width histogram ``(bucket, low, high, n)`` with its empty buckets."""
    bounds = value_bounds(df, [column])
    if column not in bounds:
        raise ValueError(f"No values in {column}")
    edges = equal_width_edges(*bounds[column], buckets)
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(bucket_of(F.col(column).cast("double"), edges).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    frame = df.sparkSession.createDataFrame(
        [(i, float(edges[i]), float(edges[i + 1])) for i in range(buckets)],
        "bucket int, low double, high double",
    )
    return frame.join(counted, "bucket", "left").select(
        "bucket", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )
