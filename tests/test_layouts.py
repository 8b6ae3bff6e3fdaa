"""Results do not hang on table size, file layout or odd values."""

import math

import pytest
from pyspark.sql import functions as F

from lexigate import scratch
from lexigate.operators import curves, drift, latency
from lexigate.operators.scale import exact_percentiles, range_edges
from lexigate.sources import csv_source
from lexigate.streaming import prediction_log as streams

ODD = [0.1, 0.1, 0.4, -0.0, 0.0, 0.8, 0.9, 0.95, math.nan, math.inf, -math.inf, None, 0.3, 0.7]
ONE_RANGE, MANY_RANGES = 1000, 2


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(s, "ab"[i % 2]) for i, s in enumerate(ODD)]
    return spark.createDataFrame(rows, "score double, label string")


def test_edges_are_finite(scored):
    assert all(map(math.isfinite, range_edges(scored, "score", MANY_RANGES)))
    assert len(range_edges(scored, "score", MANY_RANGES)) > 2


def test_curves_are_alike_at_every_size(scored):
    tables = [
        curves.score_table(scored, rows_per_range=n).orderBy("score").collect()
        for n in (ONE_RANGE, MANY_RANGES)
    ]
    assert tables[0] == tables[1]
    assert [r["score"] for r in tables[0]] == sorted({x for x in ODD if x is not None and x == x})


def test_percentiles_are_alike_at_every_size(scored):
    shares = {"low": 0.0, "mid": 0.5, "top": 1.0}
    few, many = (
        exact_percentiles(scored, "score", shares, rows_per_range=n).drop("mean").first()
        for n in (ONE_RANGE, MANY_RANGES)
    )
    assert few == many
    assert few.asDict() == {"n": 12, "low": -math.inf, "mid": 0.35, "top": math.inf}


def test_drift_survives_a_column_without_values(spark):
    left = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    right = spark.createDataFrame([(1.0, 3.0), (5.0, 4.0)], "a double, b double")
    found = {r["column"]: r for r in drift.ks_two_sample(left, right, ["a", "b"]).collect()}
    assert found["a"]["ks_statistic"] == 0.5 and found["b"]["ks_statistic"] is None


@pytest.mark.parametrize("files", [1, 5])
def test_streams_read_a_file_or_a_folder(spark, tmp_path, files):
    schema = "ts timestamp, prediction string, latency_ms double, event_id bigint"
    rows = spark.range(1000).selectExpr(
        "timestamp_seconds(1700000000 + id * 60) as ts", "concat('p', id % 3) as prediction",
        "cast(id % 17 as double) as latency_ms", "id as event_id",
    )
    folder = tmp_path / "tables"
    if files == 1:
        rows.coalesce(1).write.parquet(str(tmp_path / "one"))
        folder.mkdir()
        part = next((tmp_path / "one").glob("part-*.parquet"))
        (folder / "events.parquet").write_bytes(part.read_bytes())
    else:
        rows.repartition(files).write.parquet(str(folder / "events.parquet"))
    frame = spark.read.schema(schema).parquet(str(folder / "events.parquet"))
    stream = streams.stream_table(spark, str(folder), "events", frame.schema)
    found = streams.run_totals(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    expected = rows.groupBy("prediction").agg(F.count("*").alias("total"))
    assert sorted(found.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("backwards", [False, True])
def test_small_batches_equal_one_batch_but_for_reported_rows(spark, tmp_path, backwards):
    """Files in order of time lose nothing; days that come behind a later one are counted."""
    days = [range(lo, lo + 2) for lo in (0, 2, 4)]
    for some in reversed(days) if backwards else days:
        spark.createDataFrame([(d, "a", float(d)) for d in some], "d int, prediction string, latency_ms double").selectExpr(
            "timestamp_seconds(d * 86400) as ts", "prediction", "latency_ms"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    schema = spark.read.parquet(str(tmp_path / "log")).schema
    stream = streams.read_stream(spark, str(tmp_path / "log"), schema, files_per_batch=1)
    counts = streams.latency_counts(streams.event_time(stream))
    query = streams.write_changes(counts, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    streams.await_end(query)
    keys = ["window", "prediction", "latency_ms"]
    found = streams.latest_changes(spark, str(tmp_path / "out"), keys, ["n"]).count()
    assert found + streams.late_rows(query) == 6
    assert (streams.late_rows(query) > 0) == backwards


def test_only_a_missing_folder_means_no_epochs(spark, tmp_path):
    assert streams._epochs(spark, str(tmp_path / "none")) == []
    with pytest.raises(Exception, match="nosuchscheme"):
        streams._epochs(spark, "nosuchscheme://host/x")


def test_shared_folder_must_be_named_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Cluster())


def test_csv_files_with_another_header_order_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("review_text,sentiment\nfine,positive\n")
    assert csv_source.read_csv(spark, str(tmp_path)).count() == 1
    (tmp_path / "b.csv").write_text("sentiment,review_text\npositive,fine\n")
    for schema in (None, "review_text string, sentiment string"):
        with pytest.raises(Exception, match="(?i)header"):
            csv_source.read_csv(spark, str(tmp_path), schema=schema).collect()


CSV_ROWS = [
    b'plain,positive', b'"a, b","neg\native"', b'"two\r\nlines ""said"" she",x', b'5" pipe,"y', b'\n\n"",z"',
    b'"ends with quote""",""', b',', b'"cut"off,"q"', "\u00e4\u00f6,\u2028".encode(), b'"\n\n\n",a',
]


@pytest.mark.parametrize("ending", [b"\n", b"\r\n"])
def test_csv_blocks_give_the_rows_of_whole_files(spark, tmp_path, ending):
    """Whatever byte a block ends at, rows are those that Spark reads in one task per file, and line
    breaks in fields stay as they are."""
    (tmp_path / "whole").mkdir()
    (tmp_path / "split").mkdir()
    plain = b"\n".join([b"review_text,sentiment", *CSV_ROWS])
    body = ending.join([b"review_text,sentiment", *CSV_ROWS])
    for folder, content, end in (("whole", plain, b"\n"), ("split", body, ending)):
        (tmp_path / folder / "a.csv").write_bytes(content + end)
        # byte order mark, no last line end
        (tmp_path / folder / "b.csv").write_bytes(b"\xef\xbb\xbf" + content)
        (tmp_path / folder / "c.csv").write_bytes(end * 40 + content)  # empty lines before the header
    schema = "review_text string, sentiment string"
    whole = spark.read.csv(
        str(tmp_path / "whole"), schema=schema, header=True, quote='"', escape='"', multiLine=True
    )
    broken = f"y{ending.decode()}\n\n\",z"
    wanted = [
        (row[0], broken if row[1] == 'y\n\n\n",z' else row[1]) for row in whole.collect()
    ]
    wanted.sort(key=repr)
    assert len(wanted) == 27
    for size in (7, 33, 10_000):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            found = csv_source.read_csv(
                spark, str(tmp_path / "split"), schema=schema, null_words=False
            )
            assert sorted(map(tuple, found.collect()), key=repr) == wanted, size
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_odd_csv_files(spark, tmp_path):
    """Too few and too many cells, a quote that is never closed, no rows, no bytes, clashing names."""
    (tmp_path / "a.csv").write_text('review_text,sentiment,odd `name`\nfine\nbad,negative,1,2\n"open,x\n\ny')
    (tmp_path / "b.csv").write_text('"review_text",Sentiment,odd `name`\r\n')
    (tmp_path / "c.csv").write_text("")
    found = csv_source.read_csv(spark, str(tmp_path))
    assert found.columns == ["review_text", "sentiment", "odd `name`"]
    whole = spark.read.csv(
        str(tmp_path / "a.csv"), schema=found.schema, header=True, quote='"', escape='"', multiLine=True
    )
    rows = sorted(map(tuple, found.collect()), key=repr)
    assert rows == sorted(map(tuple, whole.collect()), key=repr)
    assert [row[:2] for row in rows] == [
        ("bad", "negative"), ("fine", None), ("open,x\n\ny", None),
    ]


def test_large_csv_files_are_split(spark, tmp_path):
    lines = [f'"text,\n {i}",{i}' for i in range(2000)]
    (tmp_path / "a.csv").write_text("\n".join(["review_text,sentiment", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = csv_source.read_csv(spark, str(tmp_path / "a.csv"))
        assert dict(rows.dtypes) == {"review_text": "string", "sentiment": "int"}
        assert rows.select(F.spark_partition_id()).distinct().count() > 1
        assert sorted(rows.collect()) == sorted((f"text,\n {i}", i) for i in range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latency_ignores_what_is_no_number(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (math.nan,), (None,)], "latency_ms double")
    found = latency.latency_summary(rows).first()
    assert (found["mean_latency_ms"], found["n_runs"]) == (2.0, 2)
