"""Helpers that keep ordered and grouped work spread over many tasks.

``running`` computes prefix sums and prefix maxima without a single-partition window: rows are
cut into value ranges, each range is scanned on its own, and what earlier ranges contribute is
added from a table with one row per range.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigate.functions.clock import wall_micros

# A side is broadcast only after it was counted and found no larger than this.
SMALL_SIDE_ROWS = 100_000
ROWS_PER_RANGE = 2_000_000
# Edges go through the driver; beyond 20 billion rows ranges grow instead of becoming more.
MAX_RANGES = 10_000


def bounded_side(side: DataFrame, limit: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Materialise a side that is expected to be small and mark it for broadcast.

    At most ``limit + 1`` rows reach the driver. A larger side is returned as it was, without a
    hint, and joins by shuffle. A stream can't be counted and is returned as it was too.
    """
    if side.isStreaming:
        return side
    table = side.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return side
    return F.broadcast(side.sparkSession.createDataFrame(table, schema=side.schema))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table of few, small files to all cores before costly per-row work.

    A file that holds one row group is one task however many cores wait. Only a table with fewer
    files and fewer splits than cores is moved; a large one is left as it is read. ``df`` must be
    a plain scan. Rows go by hash of the key, so a retried task sends them the same way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, key)


def range_edges(
    df: DataFrame, column: str, rows_per_range: int = ROWS_PER_RANGE
) -> list[float]:
    """Values that cut ``column`` into ranges of about ``rows_per_range`` rows; [] for one range.

    Edges come from a quantile sketch, so they are approximate; they only affect how even the
    ranges are, never a result. Ask this of the rows as they are read: a count and a sketch of
    one column shuffle nothing, and ranges that are even over the rows hold no more distinct
    values than rows. Only finite values cut; infinite ones and NaN belong to the outer ranges.
    """
    ranges = min(MAX_RANGES, math.ceil(df.count() / rows_per_range))
    if ranges <= 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    position = _position(column, df)
    finite = F.when(F.abs(position) < F.lit(math.inf), position)
    edges = df.select(
        F.percentile_approx(finite, shares, max(10_000, 20 * ranges))
    ).first()[0]
    return sorted(set(edges or ()))


def running(
    df: DataFrame,
    order_by: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    last_before: Mapping[str, Column] | None = None,
    keys: Sequence[str] = (),
    edges: Sequence[float] = (),
) -> DataFrame:
    """Add running values in the order of ``order_by`` within ``keys``.

    ``edges`` are what ``range_edges`` gives for the first order column; without any there is one
    range per key.

    ``sums``: running total, the row itself included. ``last_before``: largest non-null value
    over the strictly earlier rows; pass a struct that starts with the order columns to get "the
    latest earlier row such that". The first order column must be a number or a timestamp without
    nulls, and ``order_by`` must order the rows of a key fully.
    """
    sums = dict(sums or {})
    last_before = dict(last_before or {})
    inputs = {f"__in_{name}": expr for name, expr in {**sums, **last_before}.items()}
    data = df.withColumns(inputs) if inputs else df

    if edges:
        data = data.withColumn("__position", _position(order_by[0], df))
        data = Bucketizer(
            splits=[-math.inf, *edges, math.inf],
            inputCol="__position",
            outputCol="__range",
            handleInvalid="keep",
        ).transform(data)
        data = data.drop("__position")
    else:
        data = data.withColumn("__range", F.lit(0.0))

    within = Window.partitionBy(*keys, "__range").orderBy(*order_by)
    up_to_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_here = within.rowsBetween(Window.unboundedPreceding, -1)
    scanned = data.withColumns(
        {
            **{name: F.sum(f"__in_{name}").over(up_to_here) for name in sums},
            **{name: F.max(f"__in_{name}").over(before_here) for name in last_before},
        }
    )
    if not edges:
        return scanned.drop("__range", *inputs)

    totals = data.groupBy(*keys, "__range").agg(
        *[F.sum(f"__in_{name}").alias(f"__total_{name}") for name in sums],
        *[F.max(f"__in_{name}").alias(f"__total_{name}") for name in last_before],
    )
    # one row per range and key
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("__range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *keys,
        "__range",
        *[F.sum(f"__total_{name}").over(earlier).alias(f"__carry_{name}") for name in sums],
        *[
            F.max(f"__total_{name}").over(earlier).alias(f"__carry_{name}")
            for name in last_before
        ],
    )
    joined = scanned.join(carried, [*keys, "__range"], "left")
    return joined.withColumns(
        {
            **{
                name: F.col(name) + F.coalesce(F.col(f"__carry_{name}"), F.lit(0))
                for name in sums
            },
            # within a range every earlier row is later than any row of an earlier range
            **{name: F.coalesce(name, f"__carry_{name}") for name in last_before},
        }
    ).drop("__range", *inputs, *[f"__carry_{name}" for name in {**sums, **last_before}])


def _position(column: str, df: DataFrame) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return wall_micros(F.col(column)).cast("double")
    return F.col(column).cast("double")


def exact_percentiles(
    df: DataFrame,
    value: str,
    shares: Mapping[str, float],
    keys: Sequence[str] = (),
    weight: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Mean, count and exact linearly interpolated percentiles of a column, per key.

    Nulls and NaN are no values and are left out; infinite values count.

    The built-in exact percentile keeps every distinct value of a group in one task; here values
    are first counted, then ranked with ``running``, so no group is held anywhere. ``weight``
    names a column with the number of rows each row stands for.
    """
    one = F.col(weight) if weight else F.lit(1)
    present = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    edges = range_edges(present, value, rows_per_range)
    counted = present.groupBy(*keys, F.col(value).cast("double").alias("__value")).agg(
        F.sum(one).cast("long").alias("__n")
    )
    ranked = running(
        counted,
        ["__value"],
        sums={"__upto": F.col("__n")},
        keys=keys,
        edges=edges,
    )
    totals = counted.groupBy(*keys).agg(
        F.sum("__n").alias("n"),
        (F.sum(F.col("__value") * F.col("__n")) / F.sum("__n")).alias("mean"),
    )
    if keys:
        placed = ranked.join(totals, list(keys))
    else:
        total = totals.select(F.struct("n", "mean")).scalar()
        placed = ranked.withColumn("__total", total).select("*", "__total.n", "__total.mean")

    def at(rank: Column) -> Column:
        inside = (F.col("__upto") - F.col("__n") <= rank) & (rank < F.col("__upto"))
        return F.max(F.when(inside, F.col("__value")))

    # both neighbours of the wanted position; the position counts from 0
    picks = []
    for name, share in shares.items():
        position = (F.col("n") - 1) * F.lit(float(share))
        picks += [
            at(F.floor(position)).alias(f"__low_{name}"),
            at(F.ceil(position)).alias(f"__high_{name}"),
        ]
    picked = placed.groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("mean").alias("mean"), *picks
    )
    results = []
    for name, share in shares.items():
        position = (F.col("n") - 1) * F.lit(float(share))
        low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
        between = low + (high - low) * (position - F.floor(position))
        # equal neighbours may be infinite, and no part of an infinite step is a number
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    return picked.select(*keys, "n", "mean", *results)
