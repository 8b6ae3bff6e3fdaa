import pytest
from pyspark.sql import functions as F

from lexigate.functions import text as tx
from lexigate.operators.derive import add_derived_columns, token_column

CLEANED = [
    ("HELLO WORLD", "hello world"),
    ("see http://x.y/z?q=1 now", "see now"),
    ("a <b>bold</b> move", "a bold move"),
    ("great!!! product... #1", "great product 1"),
    ("Great Product!", "great product"),
    # the URL rule runs first and eats up to the next whitespace, closing quote included
    ('<a href="http://x.y">link</a> text', "a href text"),
    # a tag may span a carriage return but not a newline
    ("a <b\rc> d", "a d"),
    ("a <b\nc> d", "a b c d"),
    # a no-break space ends a URL
    ("http://x tail", "tail"),
    ("café", "caf"),
    ("", ""),
    (None, "nan"),
]


@pytest.mark.parametrize("raw,expected", CLEANED)
def test_clean_text(spark, raw, expected):
    frame = spark.createDataFrame([(raw,)], "t string")
    assert frame.select(tx.clean_text(F.col("t"))).first()[0] == expected


def test_whitespace_class_is_that_of_python(spark):
    every = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    frame = spark.createDataFrame([(c,) for c in every], "c string")
    found = frame.filter(F.col("c").rlike(f"^[{tx.WHITESPACE}]$")).collect()
    assert {row[0] for row in found} == {c for c in every if c.isspace()}


def test_lengths_use_the_raw_text(spark):
    texts = ["Great Product!", "  two words \n", "\U0001f600 ok", "", None]
    frame = spark.createDataFrame(
        [(i, t, "positive") for i, t in enumerate(texts)],
        "row_id int, review_text string, sentiment string",
    )
    rows = add_derived_columns(frame).orderBy("row_id").collect()
    stringified = ["nan" if t is None else t for t in texts]
    assert [r["review_length"] for r in rows] == [len(t) for t in stringified]
    assert [r["word_count"] for r in rows] == [len(t.split()) for t in stringified]
    # the raw cell stays null so that the null check sees it
    assert rows[4]["review_text"] is None
    assert rows[4]["review_text_clean"] == "nan"


def test_words_are_cut_and_not_matched_one_by_one(spark):
    spaces = tx.WHITESPACE_CHARACTERS
    texts = [*(f"{c}a{c}{c}b c{c}" for c in spaces), spaces, f"x{spaces}y\u180e\u200bz", "a" * 9, "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    counted = frame.select("i", tx.word_count(F.col("t")).alias("n"))
    assert counted.dtypes[1] == ("n", "int")
    assert dict(counted.collect()) == {i: 1 if t is None else len(t.split()) for i, t in enumerate(texts)}
    # one match at a time takes six times as long
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "regexp_" not in plan


def test_source_is_optional_and_the_order_fixed(spark):
    frame = spark.createDataFrame(
        [("a", "x", "s", 1)], "sentiment string, review_text string, source string, extra int"
    )
    assert add_derived_columns(frame).columns == [
        "review_text", "sentiment", "review_text_clean", "review_length", "word_count", "source",
    ]
    assert "source" not in add_derived_columns(frame.drop("source")).columns


def test_bigrams_skip_one_character_words(spark):
    frame = spark.createDataFrame([("love a car",), ("a",), ("",)], "c string")
    rows = frame.select(tx.with_bigrams(tx.tokens(F.col("c"))).alias("t")).collect()
    assert [row["t"] for row in rows] == [["love", "car", "love car"], [], []]


def test_raw_tokens_strip_accents_and_keep_word_characters(spark):
    frame = spark.createDataFrame(
        [("Café naïve Ångström x y_z ﬁn 42!",), (None,)], "t string"
    )
    rows = frame.select(tx.raw_tokens(F.col("t")).alias("t")).collect()
    assert rows[0]["t"] == ["cafe", "naive", "angstrom", "y_z", "fin", "42"]
    assert rows[1]["t"] == ["nan"]


def test_missing_text_column_is_an_error(spark):
    with pytest.raises(ValueError, match="review_text"):
        token_column(spark.range(1), "review_text")


def test_words_are_counted_without_a_pattern(spark):
    plan = spark.createDataFrame([("a b",)], "t string").select(tx.word_count(F.col("t")))
    # two patterns of many characters in one projection slow each other down
    assert tx.WHITESPACE not in plan._jdf.queryExecution().executedPlan().toString()
