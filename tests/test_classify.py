import math
import uuid

import pytest
from conftest import rows
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill.functions import plain_words
from reviewmill.plans import demo_batches, star_model


def texts(spark):
    words = {"5.0": "lovely tasty", "3.0": "average fine", "1.0": "horrid cold"}
    data = [(f"{stars}-{i}", f"The {word} meal  number x{i} http://a.b/{i}", stars) for stars, word in words.items() for i in range(40)]
    return spark.createDataFrame(data, "review_id string, text string, stars string")


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert rows(op.index_labels(df, "x").distinct()) == [("a", 1.0), ("b", 2.0), ("c", 0.0)]


def test_assemble_skips_rows_with_a_null(spark):
    df = spark.createDataFrame([(1, 2.5), (3, None)], "a int, b double")
    assert [list(r.features) for r in op.assemble(df, ["a", "b"]).collect()] == [[1.0, 2.5]]


def test_stop_words_and_empty_words(spark):
    rows_ = op.tfidf_stages().fit(texts(spark)).transform(texts(spark)).where("review_id = '5.0-0'").first()
    assert rows_.words == ["the", "lovely", "tasty", "meal", "", "number", "x0", "http://a.b/0"]
    assert rows_.filtered_words == ["lovely", "tasty", "meal", "", "number", "x0", "http://a.b/0"]
    assert rows_.tf.size == 2 ** 16
    plain = op.tfidf_stages(stop_words=False).fit(texts(spark)).transform(texts(spark))
    assert "filtered_words" not in plain.columns and plain.where("review_id = '5.0-0'").first().tf.values.sum() == 8


def test_document_frequencies_agree_with_the_idf_stage(spark):
    df = texts(spark)
    found = {r.term: r for r in op.doc_freq(df).collect()}
    assert found["the"].doc_freq == 120 and found["the"].idf == 0.0
    assert found["lovely"].doc_freq == 40 and math.isclose(found["lovely"].idf, math.log(121 / 41))
    assert found["x0"].doc_freq == 3 and found["x0"].idf == 0.0
    weights = op.tfidf_stages(stop_words=False).fit(df).stages[2].idf.toArray()
    assert {round(w, 9) for w in weights} >= {round(r.idf, 9) for r in found.values() if r.doc_freq in (40, 120)}


def test_plain_words_are_those_of_the_tokenizer(spark):
    cases = ["", " ", "\n\t ", " a", "a ", "A  b", "x\x0by\n", "é\u00a0Z", "a\r\nb \n"]
    df = spark.createDataFrame([(c,) for c in cases], "text string")
    both = Tokenizer(inputCol="text", outputCol="words").transform(df).withColumn("own", plain_words(F.col("text")))
    assert [r.own for r in both.collect()] == [r.words for r in both.collect()]


def test_term_counts(spark):
    df = spark.createDataFrame([(1, "a b A"), (2, "")], "id int, text string")
    assert rows(op.term_counts(df, "id")) == [(1, "a", 2), (1, "b", 1), (2, "", 1)]


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2 + [(None,)], "label double")
    assert rows(op.class_weights(df)) == [(0.0, 6, 8 / 12), (1.0, 2, 2.0)]


def test_balanced_fit_weighs_the_small_class(spark):
    df = spark.createDataFrame([(0.0, 1.0)] * 90 + [(1.0, 1.0)] * 10, "label double, x double")
    df = op.assemble(df, ["x"])
    even = op.fit_stars(df).transform(df).first().probability
    assert abs(even[0] - 0.5) < 1e-3
    assert op.fit_stars(df, balanced=False).transform(df).first().probability[0] > 0.85


def test_metrics_of_an_unpredicted_and_an_unlabelled_class(spark):
    pairs = spark.createDataFrame([(0.0, 0.0)] * 3 + [(0.0, 2.0), (1.0, 0.0)], "label double, prediction double")
    found = {r["class"]: r for r in op.class_metrics(pairs).collect()}
    assert (found[0.0].support, found[0.0].predicted, found[0.0].hits, found[0.0].precision, found[0.0].recall) == (4, 4, 3, 0.75, 0.75)
    assert (found[1.0].precision, found[1.0].recall, found[1.0].f1) == (0.0, 0.0, 0.0)
    assert found[2.0].support == 0
    assert math.isclose(op.f1_weighted(pairs).first()[0], op.evaluate_f1(pairs))
    assert rows(op.confusion(pairs)) == [(0.0, 0.0, 3), (0.0, 2.0, 1), (1.0, 0.0, 1)]


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_star_model(spark, name):
    reviews = texts(spark).union(spark.createDataFrame([("x", None, "5.0"), ("y", "no stars", None)], texts(spark).schema))
    model, f1, metrics = star_model(spark, reviews, name, max_iter=20)
    assert model.numClasses == 3 and f1 > 0.9
    predictions = spark.read.table(name)
    assert predictions.columns == ["review_id", "stars", "label", "prediction"]
    assert predictions.count() == sum(r.support for r in metrics)


def test_embeddings(spark):
    df = spark.range(60).select(
        "id", F.array((F.col("id") % 2).cast("float"), F.lit(0.5).cast("float")).alias("embedding"), (F.col("id") % 2).cast("int").alias("label"))
    found = op.fit_embeddings(df).transform(op.embedding_features(df))
    assert found.where("label != prediction").count() == 0


def test_demo_batches(spark, name, tmp_path):
    reviews = texts(spark)
    demo_batches(spark, reviews, 40, str(tmp_path / "small"), name)
    first, second = op.overlapping_batches(reviews, 40, "review_id")
    assert rows(spark.read.table(name)) == rows(first.union(second).distinct())
