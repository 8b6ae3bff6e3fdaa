import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from lexigate.operators import features
from lexigate.operators.derive import add_derived_columns
from lexigate.sources.synthetic import synthetic_reviews


@pytest.fixture(scope="module")
def rows(spark):
    return add_derived_columns(synthetic_reviews(spark, 120, 1)).cache()


@pytest.fixture(scope="module")
def model(rows):
    return features.TextFeatures().fit(rows.filter("row_id < 80"))


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, t, len(t)) for i, t in enumerate(texts)],
        "row_id int, review_text_clean string, review_length int",
    )


def test_vocabulary_by_hand(spark):
    data = frame(spark, ["red red blue", "red blue", "blue green", "green green green"])
    model = features.TextFeatures().fit(data)
    # red blue and green green are in one row, blue green in one
    assert dict(zip(model.terms, model.document_frequencies)) == {
        "blue": 3, "green": 2, "red": 2, "red blue": 2,
    }
    assert dict(zip(model.terms, model.corpus_counts))["green"] == 4
    assert model.idf[0] == pytest.approx(math.log(5 / 4) + 1)
    weights = {
        (r["row_id"], r["term"]): r["weight"] for r in model.weights(data).collect()
    }
    red = (1 + math.log(2)) * (math.log(5 / 3) + 1)
    blue = math.log(5 / 4) + 1
    pair = math.log(5 / 3) + 1
    assert weights[0, "red"] == pytest.approx(red / math.sqrt(red**2 + blue**2 + pair**2))


def test_terms_are_counted_without_a_struct_for_each(spark):
    rows = [(["a", "b", "a", "a b"],), (["a"],), ([],), (None,), (["b", None, None],)]
    data = spark.createDataFrame(rows, "words array<string>")
    counted = features.term_statistics(data, "words")
    assert counted.schema.simpleString() == "struct<term:string,df:bigint,tf:bigint>"
    assert {tuple(r) for r in counted.collect()} == {("a", 2, 3), ("b", 2, 2), ("a b", 1, 1), (None, 1, 2)}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(" in plan and "struct(" not in plan


def test_limit_keeps_the_most_frequent_and_breaks_ties_by_term(spark):
    data = frame(spark, ["bb aa cc", "cc bb aa", "cc"])
    model = features.TextFeatures(max_features=2).fit(data)
    assert model.terms == ["aa", "cc"]


def test_rare_terms_go_before_the_limit(spark):
    data = frame(spark, ["zz zz zz zz", "aa bb", "aa bb"])
    assert features.TextFeatures(max_features=2).fit(data).terms == ["aa", "aa bb"]


def test_rows_have_unit_length(rows, model):
    lengths = (
        model.weights(rows).groupBy("row_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    )
    assert len(lengths) == 120
    assert all(row["s"] == pytest.approx(1) for row in lengths)


def test_vectors_hold_weights_then_scaled_numbers(rows, model):
    row = model.transform(rows).filter("row_id = 5").first()
    vector = row["features"]
    assert vector.size == model.dimension == len(model.terms) + 2
    expected = {
        model.terms.index(r["term"]): r["weight"]
        for r in model.weights(rows.filter("row_id = 5")).collect()
    }
    for index, weight in expected.items():
        assert vector[index] == pytest.approx(weight)
    _, mean, scale = model.scaler[0]
    assert vector[len(model.terms)] == pytest.approx((row["review_length"] - mean) / scale)


def test_scaling_uses_the_population_deviation(spark):
    data = spark.createDataFrame(
        [("aa bb", 1.0, 5), ("aa bb", 3.0, 5), ("aa bb", None, 5)],
        "review_text_clean string, x double, c int",
    )
    model = features.TextFeatures().fit(data)
    assert model.numeric == ["x", "c"]
    (_, mean, scale), (_, _, constant) = model.scaler
    assert mean == pytest.approx(4 / 3)
    assert scale == pytest.approx(math.sqrt((1 + 9 + 0) / 3 - (4 / 3) ** 2))
    assert constant == 1.0


def test_unknown_terms_are_ignored_and_empty_rows_kept(spark, model):
    data = spark.createDataFrame(
        [(1, "zzhapaxmarker", 3, 1), (2, "", 0, 0)],
        "row_id int, review_text_clean string, review_length int, word_count int",
    )
    assert "zzhapaxmarker" not in model.terms
    assert model.weights(data).isEmpty()
    assert [list(r["features"].indices) for r in model.transform(data).collect()] == [
        [model.dimension - 2, model.dimension - 1]
    ] * 2


def test_terms_outside_training_do_not_leak(spark, rows, model):
    marked = rows.filter("row_id >= 80").withColumn(
        "review_text_clean", F.concat("review_text_clean", F.lit(" zzhapaxmarker"))
    )
    train = features.with_terms(rows.filter("row_id < 80"), "review_text")
    held_out = features.with_terms(marked, "review_text")
    report = features.leakage_terms(train, held_out, model.vocabulary_table(spark)).first()
    assert report["leaked_terms"] == 0
    assert report["outside_only_terms"] > 1
    everything = features.TextFeatures().fit(marked.unionByName(rows.filter("row_id < 80")))
    leaky = features.leakage_terms(train, held_out, everything.vocabulary_table(spark)).first()
    assert leaky["leaked_terms"] > 0


def test_raw_text_is_cleaned_on_transform(spark, model):
    raw = spark.createDataFrame(
        [(1, "Rain CAME through the <b>tent</b>!", 9, 5)],
        "row_id int, review_text string, review_length int, word_count int",
    )
    terms = {r["term"] for r in model.weights(raw).collect()}
    assert {"rain", "came", "rain came", "the tent"} <= terms


def test_guards(spark, rows, model):
    with pytest.raises(ValueError, match="numeric columns.*word_count"):
        model.transform(rows.drop("word_count"))
    with pytest.raises(ValueError, match="text column"):
        model.transform(rows.drop("review_text", "review_text_clean"))
    with pytest.raises(ValueError, match="No terms remain"):
        features.TextFeatures().fit(frame(spark, ["one text only"]))


def test_fits_in_a_pipeline_and_survives_saving(spark, rows, model, tmp_path):
    fitted = Pipeline(stages=[features.TextFeatures()]).fit(rows.filter("row_id < 80"))
    vector = fitted.transform(rows).filter("row_id = 3").first()["features"]
    assert vector == model.transform(rows).filter("row_id = 3").first()["features"]
    model.save(str(tmp_path / "m"), spark)
    loaded = features.TextFeaturesModel.load(str(tmp_path / "m"), spark)
    assert loaded.metadata() == model.metadata()
    assert loaded.transform(rows).filter("row_id = 3").first()["features"] == vector


def test_repartitioning_changes_nothing(rows):
    models = [features.TextFeatures().fit(rows.repartition(n)) for n in (1, 7, 64)]
    assert models[0].terms == models[1].terms == models[2].terms
    assert models[0].idf == models[1].idf == models[2].idf


def test_vectors_are_those_of_spark_in_every_bit(spark, rows, model):
    texts = ["a the tent rain rain", "rain came rain came  rain", "", "zzz", " ".join(["rain"] * 300)]
    data = frame(spark, texts).withColumn("word_count", F.lit(3))
    counted = CountVectorizerModel.from_vocabulary(model.terms, inputCol="terms", outputCol="counts").transform(
        features.with_terms(data, "review_text")
    )
    # plain array expressions, as before one UDF did it all
    raw = F.zip_with(
        "v.indices",
        "v.values",
        lambda i, n: (1.0 + F.log(n)) * F.get(F.lit(model.idf), i),
    )
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda total, w: total + w * w))
    plain = (
        counted.withColumn("v", F.unwrap_udt("counts"))
        .withColumn("raw", raw)
        .withColumn("weights", F.zip_with("raw", F.array_repeat(norm, F.size("raw")), lambda w, n: w / n))
    )
    expected = {r["row_id"]: (list(r["v"].indices), r["weights"]) for r in plain.collect()}
    terms = len(model.terms)
    transformed = model.transform(data)
    for row in transformed.collect():
        vector = row["features"]
        indices, weights = expected[row["row_id"]]
        assert vector.size == model.dimension
        assert vector.indices.tolist() == [*indices, *range(terms, model.dimension)]
        if row["row_id"] != 4:
            assert vector.values.tolist()[: len(indices)] == weights
        assert vector.values.tolist()[: len(indices)] == pytest.approx(weights, rel=1e-15)
    assert len(expected[1][0]) > 1 and not expected[2][0]
    # the row's terms are never a column
    plan = transformed._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and plan.count("ArrowEvalPython") == 1
