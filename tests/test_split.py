import math
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexigate.functions.hashing import seeded_key
from lexigate.operators import split


@pytest.fixture(scope="module")
def rows(spark):
    # a hot class, a middling one and a rare one
    return spark.range(3001).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 100 == 0, "rare")
        .when(F.col("id") % 3 == 0, "some")
        .otherwise("hot")
        .alias("sentiment"),
    ).cache()


def places(frame):
    return {(r["row_id"], r["split"]) for r in frame.select("row_id", "split").collect()}


def test_sizes_are_exact_and_stratified(rows):
    assigned = split.assign_splits(rows, test_size=0.2, validation_size=0.1)
    n = rows.count()
    sizes = Counter(r["split"] for r in assigned.collect())
    assert sizes["test"] == math.ceil(0.2 * n)
    assert sizes["validation"] == math.ceil((n - sizes["test"]) * 0.125)
    by_class = {(r["split"], r["label"]): r["n"] for r in split.split_sizes(assigned).collect()}
    totals = {r["label"]: r["n"] for r in split.class_counts(rows, "sentiment").collect()}
    for label, count in totals.items():
        assert abs(by_class["test", label] - sizes["test"] * count / n) < 1
    assert sum(by_class.values()) == n


def test_equals_ranking_each_class(rows):
    key = seeded_key(42, F.col("row_id"))
    rank = F.row_number().over(Window.partitionBy("sentiment").orderBy(key))
    ranked = {r["row_id"]: (r["sentiment"], r["rank"]) for r in rows.withColumn("rank", rank).collect()}
    assigned = split.assign_splits(rows).collect()
    quota = Counter((r["sentiment"], r["split"]) for r in assigned)
    for r in assigned:
        label, place = ranked[r["row_id"]]
        test, validation = quota[label, "test"], quota[label, "validation"]
        expected = "test" if place <= test else "validation" if place <= test + validation else "train"
        assert r["split"] == expected


def test_same_seed_same_split_however_partitioned(rows):
    first = places(split.assign_splits(rows))
    assert places(split.assign_splits(rows.repartition(7))) == first
    assert places(split.assign_splits(rows.coalesce(1))) == first
    assert places(split.assign_splits(rows, seed=7)) != first


def test_parts_are_disjoint_and_complete(rows):
    train, validation, test = split.three_way_split(rows)
    report = split.split_overlap({"train": train, "validation": validation, "test": test}, rows)
    assert {r["n"] for r in report.collect()} == {0}


def test_sizes_are_decimal_not_binary(spark):
    frame = spark.range(100).selectExpr("id as row_id", "string(id % 2) as sentiment")
    # 0.07 * 100 is 7.000000000000001 in binary
    assigned = split.assign_splits(frame, test_size=0.07, validation_size=0.1)
    assert Counter(r["split"] for r in assigned.collect())["test"] == 7


def test_folds_are_dealt_like_sorted_rows(rows):
    assigned = split.assign_folds(rows, folds=5).collect()
    got = Counter((r["sentiment"], r["fold"]) for r in assigned)
    dealt = Counter(
        (label, place % 5) for place, label in enumerate(sorted(r["sentiment"] for r in assigned))
    )
    assert got == dealt
    totals = Counter(r["fold"] for r in assigned)
    assert max(totals.values()) - min(totals.values()) <= 1


def test_a_class_of_one_row_and_null_labels_are_errors(spark):
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "row_id int, sentiment string")
    with pytest.raises(split.SplitError, match="smallest class"):
        split.assign_splits(one)
    unlabelled = spark.createDataFrame([(1, "a"), (2, None)], "row_id int, sentiment string")
    with pytest.raises(split.SplitError, match="without a label"):
        split.assign_splits(unlabelled)
    with pytest.raises(split.SplitError, match="no rows"):
        split.assign_splits(one.limit(0))
