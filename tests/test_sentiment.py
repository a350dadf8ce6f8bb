import re
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill import sources as src
from reviewmill.plans import category_sentiment

GOOD, BAD = "Great food, great staff!", "Awful food; rude staff."


def reviews(spark):
    data = [(f"g{i}", "b1", GOOD, "d", "5.0") for i in range(6)] + [(f"b{i}", "b1", BAD, "d", "1.0") for i in range(5)]
    data += [("m", "b1", "great but awful", "d", "3.0"), ("e", "b1", "", "d", "4.0"), ("u", "b2", "12 !!", "d", "2.0"),
             ("n", "b1", None, "d", None)]
    return spark.createDataFrame(data, "review_id string, business_id string, text string, date string, stars string")


@pytest.fixture(scope="module")
def model(spark):
    return op.train_sentiment(op.weak_labels(reviews(spark)))


def words(spark, text):
    return op.normalize(op.tokenize(spark.createDataFrame([(text,)], "text string"))).first()


def test_tokens(spark):
    row = words(spark, "  Don't  WASTE\nyour\t time!!! 5 ...  ")
    assert row.token == ["don't", "waste", "your", "time!!!", "5", "..."]
    assert row.normal == ["dont", "waste", "your", "time"]
    assert words(spark, "").token == [] and words(spark, " \n").normal == [] and words(spark, "?! 7").normal == []
    assert words(spark, None).token is None and words(spark, None).normal is None
    assert words(spark, "Ünï-çødé ñ").normal == ["ünïçødé", "ñ"]


@pytest.mark.parametrize("text", ["a-b  c!d\n...\te", "", " ", "é1 2 x_y\r\nz", None, "...a"])
def test_words_straight_from_the_text_are_the_same(spark, text):
    from reviewmill.functions import normal_words
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(normal_words(df.text)).first()[0] == words(spark, text).normal


def test_weak_labels(spark):
    labels = {r.review_id: r.train_sentiment for r in op.weak_labels(reviews(spark)).collect()}
    assert labels["g0"] == "positive" and labels["b0"] == "negative" and labels["u"] == "negative"
    assert "m" not in labels and "n" not in labels


def test_word_class_counts_count_texts_not_occurrences(spark):
    counts = {r.word: (r.positive, r.negative) for r in op.word_class_counts(op.weak_labels(reviews(spark))).collect()}
    assert counts == {"great": (6, 0), "food": (6, 5), "staff": (6, 5), "awful": (0, 5), "rude": (0, 5)}


def test_scores(spark, model):
    scored = {r.review_id: r.final_sentiment for r in op.score_sentiment(reviews(spark), model).collect()}
    assert scored["g0"] == ["positive"] and scored["b0"] == ["negative"]
    assert scored["e"] == ["na"] and scored["u"] == ["na"] and scored["n"] == ["na"]
    assert op.score_sentiment(reviews(spark), model).columns == [*reviews(spark).columns, "final_sentiment"]


def test_every_word_of_the_training_texts_has_a_weight(spark):
    once = spark.createDataFrame([("x1", "b1", "singular", "d", "5.0")], reviews(spark).schema)
    model = op.train_sentiment(op.weak_labels(reviews(spark).union(once)))
    assert {r.word for r in model.weights.collect()} == {"great", "food", "staff", "awful", "rude", "singular"}
    assert op.score_sentiment(once, model).first().final_sentiment == ["positive"]


def test_equal_keys_and_equal_texts(spark, model):
    df = reviews(spark).where("review_id IN ('g0', 'b0', 'n')").withColumn("review_id", F.lit("same"))
    df = df.union(df).union(df)
    labels = sorted(r.final_sentiment[0] for r in op.score_sentiment(df, model).collect())
    assert labels == ["na"] * 3 + ["negative"] * 3 + ["positive"] * 3


def test_scoring_moves_no_word_of_the_texts(spark, model):
    """However large the model, its words are broadcast in parts: no word of a text is shuffled, and the labels stay."""
    expected = {r.review_id: r.final_sentiment for r in op.score_sentiment(reviews(spark), model).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for words_per_part in (2, 1000):
            scored = op.score_sentiment(reviews(spark), model, words_per_part=words_per_part)
            plan = scored._jdf.queryExecution().executedPlan().toString()
            assert all("word" not in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
            assert {r.review_id: r.final_sentiment for r in scored.collect()} == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_move_alike_on_small_and_large_tables(spark, model):
    """The texts meet their labels and their sums by a merge on small tables too, so what is shuffled grows with the input."""
    from conftest import executed

    from reviewmill.queries.standins import text_reviews

    joined = executed(text_reviews(spark, "/root/testdata/sf0.001"))
    assert re.search(r"SortMergeJoin \[doc_id#\d+L?\], \[doc_id#\d+L?\], LeftOuter", joined)
    scored = executed(op.score_sentiment(reviews(spark), model))
    assert re.search(r"SortMergeJoin \[_code#\d+\], \[_code#\d+\], LeftOuter", scored)


def test_training_needs_both_labels(spark):
    with pytest.raises(ValueError, match="both"):
        op.train_sentiment(op.weak_labels(reviews(spark).where("stars = '5.0'")))
    with pytest.raises(ValueError, match="no labelled text"):
        op.train_sentiment(op.weak_labels(reviews(spark).withColumn("text", F.lit("?!"))))


@pytest.mark.parametrize("label, stars, flag", [
    ("positive", "5.0", 1), ("positive", "4.0", 1), ("positive", "3.0", 1), ("positive", "2.0", 0), ("positive", "1.0", 0),
    ("negative", "5.0", 0), ("negative", "3.0", 1), ("negative", "2.0", 1), ("negative", "1.0", 1),
    ("na", "3.0", 0), (None, "5.0", 0), ("positive", None, 0), ("positive", "5", 0),
])
def test_right_prediction(spark, label, stars, flag):
    df = spark.createDataFrame([([label], stars)], "final_sentiment array<string>, stars string")
    assert op.right_prediction(df).first().right_prediction == flag


def test_null_label_array(spark):
    df = spark.createDataFrame([(None, "5.0")], "final_sentiment array<string>, stars string")
    assert op.right_prediction(df).first().right_prediction == 0


def test_accuracy_and_mispredicted(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (1,)], "right_prediction int")
    assert tuple(op.accuracy(df).first()) == (3, 4, 0.75)
    assert tuple(op.accuracy(df.where("false")).first()) == (None, 0, None)
    assert op.mispredicted(df).count() == 1


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}_scored")


def test_score_job(spark, model, name):
    src.overwrite_table(reviews(spark), name)
    op.score_job(spark, name, f"{name}_scored", model)
    assert rows(spark.read.table(f"{name}_scored")) == rows(op.score_sentiment(reviews(spark), model))


def test_application(spark, model, name):
    business = spark.createDataFrame([("b1", "Bars, Restaurants"), ("b2", "Shops")], "business_id string, categories string")
    measured = category_sentiment(spark, reviews(spark), business, "Restaurants", model, name)
    assert measured.total == 14 and measured.right == 12
    first = rows(spark.read.table(name))
    changed = reviews(spark).where("review_id IN ('g0', 'm')").selectExpr("review_id", "business_id", f"'{BAD}' AS text", "date", "'4.0' AS stars")
    measured = category_sentiment(spark, changed, business, "Restaurants", model, name)
    assert (measured.right, measured.total) == (0, 2)
    found = {r.review_id: r for r in spark.read.table(name).collect()}
    assert len(found) == len(first) == 14
    assert found["g0"].final_sentiment == ["negative"] and found["g0"].stars == "5.0" and found["m"].stars == "3.0"
