import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexigate.operators.scale import (
    bounded_side,
    exact_percentiles,
    range_edges,
    running,
    spread,
)


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    rows = [
        (i, f"k{int(rng.random() ** 3 * 4)}", float(rng.integers(0, 300)), int(rng.integers(0, 9)))
        for i in range(4000)
    ]
    return spark.createDataFrame(rows, "id bigint, k string, v double, w bigint").cache()


@pytest.mark.parametrize("rows_per_range", [10_000, 300])
def test_running_equals_a_plain_window(values, rows_per_range):
    edges = range_edges(values, "v", rows_per_range)
    assert bool(edges) == (rows_per_range < 4000)
    flagged = F.when(F.col("w") == 0, F.struct("v", "id"))
    got = running(
        values, ["v", "id"], sums={"s": F.col("w")}, last_before={"m": flagged}, keys=["k"],
        edges=edges,
    ).select("id", "s", F.col("m.id").alias("latest"))
    w = Window.partitionBy("k").orderBy("v", "id")
    want = values.select(
        "id",
        F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max(flagged).over(w.rowsBetween(Window.unboundedPreceding, -1))["id"].alias("latest"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("rows_per_range", [10_000, 250])
def test_percentiles_equal_numpy(values, rows_per_range):
    frame = values.toPandas()
    got = exact_percentiles(
        values, "v", {"a": 0.5, "b": 0.95, "c": 0.99}, rows_per_range=rows_per_range
    ).first()
    assert got["n"] == 4000
    assert got["mean"] == pytest.approx(frame.v.mean())
    for name, share in (("a", 50), ("b", 95), ("c", 99)):
        assert got[name] == pytest.approx(np.percentile(frame.v, share))
    by_key = exact_percentiles(values, "v", {"p": 0.95}, ["k"], rows_per_range=rows_per_range)
    for row in by_key.collect():
        assert row["p"] == pytest.approx(np.percentile(frame.v[frame.k == row["k"]], 95))


def test_percentiles_with_weights(spark):
    frame = spark.createDataFrame([(1.0, 3), (10.0, 1)], "v double, n bigint")
    got = exact_percentiles(frame, "v", {"p": 0.95}, weight="n").first()
    assert (got["n"], got["mean"]) == (4, 3.25)
    assert got["p"] == pytest.approx(np.percentile([1, 1, 1, 10], 95))


def test_percentiles_of_a_hot_value_need_no_big_group(spark):
    frame = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    got = exact_percentiles(frame, "v", {"p": 0.4}, rows_per_range=500).first()
    assert got["p"] == pytest.approx(np.percentile(frame.toPandas().v, 40))


def test_bounded_side_hints_only_what_it_counted(spark):
    def has_hint(frame):
        joined = spark.range(10).join(frame, "id")
        return "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()

    assert has_hint(bounded_side(spark.range(5), limit=5))
    assert not has_hint(bounded_side(spark.range(6), limit=5))
    assert bounded_side(spark.range(5)).count() == 5


def test_spread_moves_only_small_scans(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(100).repartition(2 * cores).write.parquet(str(tmp_path / "many"))
    assert spread(spark.read.parquet(str(tmp_path / "one")), "id").rdd.getNumPartitions() == cores
    many = spark.read.parquet(str(tmp_path / "many"))
    assert spread(many, "id") is many
