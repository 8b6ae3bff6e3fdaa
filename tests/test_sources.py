import hashlib
import json

import pytest

from lexigate.config import DataConfig
from lexigate.operators.quality import DataValidationError
from lexigate.sources import csv_source, labelled_lines, provenance, sinks, synthetic
from lexigate.sources.acquire import acquire


def write(folder, **files):
    for name, content in files.items():
        (folder / f"{name}.txt").write_text(content, encoding="utf-8", newline="")


def test_labelled_files(spark, tmp_path):
    write(
        tmp_path,
        amazon_cells_labelled="good\t1\nno label here\n\n  bad thing \t0\n",
        imdb_labelled="two\ttabs\t1\nwrong\t2\n\t1\nlate \t 0 \none half\t1",
    )
    lines = labelled_lines.read_lines(spark, str(tmp_path))
    rows = {
        (r["review_text"], r["sentiment"], r["source"])
        for r in labelled_lines.parse_labelled_lines(lines).collect()
    }
    assert rows == {
        ("good", "positive", "amazon"),
        ("bad thing", "negative", "amazon"),
        # only the last tab separates
        ("two\ttabs", "positive", "imdb"),
        ("late", "negative", "imdb"),
        ("half", "positive", "imdb"),
    }
    counts = {r["source"]: (r["parsed"], r["skipped"]) for r in labelled_lines.quarantine_counts(lines).collect()}
    # blank lines are not skipped lines; a line with a label and no text is one
    assert counts == {"amazon": (2, 1), "imdb": (3, 3)}
    ids = [r["row_id"] for r in labelled_lines.read_labelled_files(spark, str(tmp_path)).collect()]
    assert len(set(ids)) == 5


def test_no_labelled_row_is_an_error(spark, tmp_path):
    write(tmp_path, yelp_labelled="nothing parseable\n")
    with pytest.raises(labelled_lines.DatasetIntegrityError, match="No labelled rows"):
        labelled_lines.read_labelled_files(spark, str(tmp_path))


def test_csv_gives_the_same_rows_back(spark, tmp_path):
    texts = ["plain", 'quoted "words", commas', "line\nbreak", "  spaces  ", "back\\slash", 'end"']
    frame = spark.createDataFrame(
        [(i, t, "positive") for i, t in enumerate(texts)],
        "row_id int, review_text string, sentiment string",
    )
    path = str(tmp_path / "csv")
    csv_source.write_csv(frame, path)
    assert sorted(csv_source.read_csv(spark, path).collect()) == sorted(frame.collect())


def test_csv_missing_columns_and_null_words(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text("review_text,stars\nNA,1\nfine,2\n")
    with pytest.raises(ValueError, match="sentiment"):
        csv_source.read_csv(spark, str(path))
    rows = csv_source.read_csv(spark, str(path), label_column="stars").collect()
    assert [tuple(r) for r in rows] == [(None, 1), ("fine", 2)]


def test_synthetic_rows(spark):
    first = synthetic.synthetic_reviews(spark, 400, 42).collect()
    assert first == synthetic.synthetic_reviews(spark, 400, 42).collect()
    assert first != synthetic.synthetic_reviews(spark, 400, 7).collect()
    assert sum(r["sentiment"] == "positive" for r in first) == 200
    assert len({r["review_text"] for r in first}) == 400
    # every template is in use
    stems = {r["review_text"].rsplit(" number ", 1)[0] for r in first}
    assert stems == {*synthetic.POSITIVE_TEMPLATES, *synthetic.NEGATIVE_TEMPLATES}


def test_provenance_has_no_path(spark):
    record = provenance.local_provenance("/home/me/data/reviews.csv", 12)
    assert record["name"] == "reviews.csv" and record["n_rows"] == "12"
    assert not any(value.startswith("/") for value in record.values())
    rows = provenance.provenance_of(spark.range(12), "/home/me/data/reviews.csv")
    assert {r["field"]: r["value"] for r in rows.collect()} == record
    licensed = provenance.licensed_provenance("uci-sentiment-labelled-sentences")
    assert licensed["license"] == "CC BY 4.0"
    with pytest.raises(KeyError, match="no dataset"):
        provenance.licensed_provenance("nope")


def test_source_policy(spark, tmp_path):
    csv = tmp_path / "mine.csv"
    csv.write_text("review_text,sentiment\nfine,positive\n")
    # 1. a configured CSV that is there, even if the fixture is preferred
    frame, record = acquire(
        spark,
        DataConfig(csv_path=str(csv), allow_synthetic_fallback=True, prefer_synthetic=True),
    )
    assert record["kind"] == "local-csv" and frame.count() == 1 and "row_id" in frame.columns
    # 2. the fixture needs both permission and preference
    frame, record = acquire(
        spark,
        DataConfig(csv_path="/no/such.csv", allow_synthetic_fallback=True, prefer_synthetic=True, synthetic_rows=10),
    )
    assert record["kind"] == "synthetic-fixture" and frame.count() == 10
    # 3. the licensed files
    write(tmp_path, yelp_labelled="good\t1\n")
    frame, record = acquire(spark, DataConfig(dataset_path=str(tmp_path / "yelp_labelled.txt")))
    assert record["kind"] == "licensed-download" and frame.count() == 1
    # 4. refuse, unless the fixture is allowed
    for path in (None, "/no/such/folder"):
        with pytest.raises(DataValidationError):
            acquire(spark, DataConfig(dataset_path=path, prefer_synthetic=True))
        _, record = acquire(spark, DataConfig(dataset_path=path, allow_synthetic_fallback=True))
        assert record["kind"] == "synthetic-fixture"


def test_pinned_files(spark, tmp_path):
    write(tmp_path, a_labelled="good\t1\nno label\n", b_labelled="bad\t0\n")
    digests = {
        p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.iterdir()
    }
    pinned = DataConfig(dataset_path=str(tmp_path), dataset_digests=digests)
    frame, record = acquire(spark, pinned)
    assert frame.count() == 2
    assert (record["n_rows"], record["n_skipped"], record["n_files_verified"]) == ("2", "1", "2")
    missing = {**digests, "c_labelled.txt": "0" * 64}
    with pytest.raises(DataValidationError, match="c_labelled.txt .missing."):
        acquire(spark, DataConfig(dataset_path=str(tmp_path), dataset_digests=missing))
    write(tmp_path, b_labelled="bad\t1\n", d_labelled="more\t1\n")
    with pytest.raises(DataValidationError, match="b_labelled.txt .mismatch., d_labelled.txt .unexpected."):
        acquire(spark, pinned)


def test_manifest(spark, tmp_path):
    frame = synthetic.synthetic_reviews(spark, 20)
    sinks.write_manifest(frame, "synthetic-reviews", str(tmp_path / "m"))
    (written,) = spark.read.json(str(tmp_path / "m")).collect()
    assert (written["n_rows"], written["n_cols"], written["source_path"]) == (20, 4, "synthetic-reviews")
    assert written["data_hash"] == sinks.data_manifest(frame, "x").first()["data_hash"]
    summary = spark.createDataFrame([("a", 1)], "name string, n int")
    sinks.write_summary(summary, str(tmp_path / "s"))
    assert json.loads(spark.read.text(str(tmp_path / "s")).first()[0]) == {"name": "a", "n": 1}
