"""Mix sources to target weights by capped water-filling, in DataFrame operations only.

Every source gets its weight's part of ``share`` times all words. A source whose part exceeds
``max_epochs`` times its own words is clamped there, and the excess goes to the others by weight
until none is above. Sorted by cap per weight, the clamped sources come first, so the common level
of the rest follows from running sums over one row per source.

A source's words are then taken as whole repetitions of all its documents plus a seeded fractional
one: documents in the order of a seeded hash until the words wanted are reached; the document on
the edge gives a part of its words. So every source meets its target to the word. The order is a
running sum per (source, hash range) plus what earlier ranges hold, hence no source is one group.

Cases: null text has no words; a null source is a source of its own, ranked last; documents without
words and sources without words take 0; rows repeated in full are taken in any order among
themselves; an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigate.scratch import new_path

WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3  # hash digits, two values to a range: 2048 ranges per source


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    by_source: DataFrame, weights: Sequence[int], share: float, max_epochs: float
) -> DataFrame:
    """``source_key, source_size, target`` from one row per source (``source``, ``source_size``).

    Sources are names in a mix, one row each after aggregation, so ordered passes over them are
    small whatever the number of documents.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.array(*[F.lit(int(w)) for w in weights])
    placed = (
        by_source.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(weight, (F.col("place") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("clamped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(onwards))
        .withColumn("turn", F.row_number().over(by_ratio))
        .withColumn("level", (F.col("wanted") - F.col("clamped")) / F.col("open"))
        .withColumn("below", F.col("level") * F.col("weight") < F.col("cap"))
        .withColumn("first", F.min(F.when(F.col("below"), F.col("turn"))).over(everything))
        .withColumn(
            "common", F.max(F.when(F.col("turn") == F.col("first"), F.col("level"))).over(everything)
        )
    )
    free = F.col("turn") >= F.col("first")
    return placed.select(
        "source_key",
        "source_size",
        F.when(free, F.col("common") * F.col("weight")).otherwise(F.col("cap")).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 20240601,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` in a struct ``row``, with ``size, source_size, target, taken``.

    ``weights`` go to the sources by name, repeating. Sizes and hashes are written once to the
    shared folder, with ``row``, and every later step reads them there.
    """
    text, number = F.coalesce("text", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), number, F.md5(text)))
    digits = F.conv(F.substring("key", 1, RANGE_DIGITS), 16, 10).cast("int")
    sized = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"),
        F.col("doc_id").alias("tie"),
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"),
        words_in(F.col("text")).alias("size"),
        key.alias("key"),
    ).withColumn("range", F.shiftright(digits, 1))
    path = new_path(docs.sparkSession, "mix")
    sized.write.parquet(path)
    sized = docs.sparkSession.read.parquet(path)

    ranges = sized.groupBy("source_key", "range").agg(
        F.first("source").alias("source"), F.sum("size").alias("range_size")
    )
    by_source = ranges.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("range_size").alias("source_size")
    )
    size, target = F.col("source_size"), F.col("target")
    epochs = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0))
    plans = (
        source_targets(by_source, weights, share, max_epochs)
        .withColumn("epochs", epochs)
        .withColumn("rest", F.round(target).cast("long") - F.col("epochs") * size)
    )
    earlier = (
        Window.partitionBy("source_key")
        .orderBy("range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ranges.select(
        "source_key",
        "range",
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("earlier"),
    ).join(plans, "source_key")
    running = (
        Window.partitionBy("source_key", "range")
        .orderBy("key", "tie", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begins = F.col("earlier") + F.sum("size").over(running) - F.col("size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - begins))
    return sized.join(starts, ["source_key", "range"]).select(
        "row",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )
