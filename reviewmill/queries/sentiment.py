"""Words, sentiment model, scores and agreement with the stars."""

from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..plans import category_sentiment, scored_category_reviews
from .registry import query
from .sampling import WIDTH, bucket_sql
from .standins import (
    NORMAL_SQL, TEXT_CATEGORY, TOKENS_SQL, documents, new_name, taken, text_business, text_reviews, with_text,
)

MODEL_SQL = f"""
, words AS (SELECT *, list_distinct({NORMAL_SQL}) AS normal FROM text_reviews)
, labelled AS (
  SELECT *, CASE WHEN stars IN ('5.0', '4.0') THEN 'positive' WHEN stars IN ('1.0', '2.0') THEN 'negative' END AS train_sentiment
  FROM words WHERE stars <> '3.0')
, counts AS (
  SELECT word, count(*) FILTER (train_sentiment = 'positive') AS positive, count(*) FILTER (train_sentiment = 'negative') AS negative
  FROM (SELECT train_sentiment, unnest(normal) AS word FROM labelled WHERE train_sentiment IS NOT NULL) GROUP BY word)
, totals AS (SELECT CAST(sum(positive) AS DOUBLE) AS p, CAST(sum(negative) AS DOUBLE) AS n, count(*) AS v FROM counts)
, prior AS (
  SELECT CAST(round((ln(count(*) FILTER (train_sentiment = 'positive') + 1) - ln(count(*) FILTER (train_sentiment = 'negative') + 1)) * 1000000000) AS BIGINT) AS s
  FROM labelled)
, weights AS (
  SELECT word, CAST(round((ln((positive + 1) / (p + v)) - ln((negative + 1) / (n + v))) * 1000000000) AS BIGINT) AS weight FROM counts, totals)
, scores AS (
  SELECT review_id, count(weight) AS known, (SELECT s FROM prior) + coalesce(sum(weight), 0) AS score
  FROM (SELECT review_id, unnest(normal) AS word FROM words) w LEFT JOIN weights ON weights.word = w.word GROUP BY review_id)
, scored AS (
  SELECT r.*, CASE WHEN coalesce(known, 0) = 0 THEN 'na' WHEN score > 0 THEN 'positive' ELSE 'negative' END AS final_sentiment
  FROM text_reviews r LEFT JOIN scores s ON s.review_id = r.review_id)
, flagged AS (
  SELECT *, CAST(CASE WHEN final_sentiment = 'positive' AND stars IN ('5.0', '4.0', '3.0') THEN 1
                      WHEN final_sentiment = 'negative' AND stars IN ('3.0', '2.0', '1.0') THEN 1 ELSE 0 END AS INTEGER) AS right_prediction
  FROM scored)"""


def _model(reviews):
    return op.train_sentiment(op.weak_labels(reviews))


def _flagged(spark, folder):
    reviews = text_reviews(spark, folder)
    return op.right_prediction(op.score_sentiment(reviews, _model(reviews)))


def _shown(df):
    return df.withColumn("final_sentiment", F.array_join("final_sentiment", ","))


@query(f"SELECT doc_id, array_to_string({TOKENS_SQL}, ' ') AS token FROM documents")
def tokenize_texts(spark, folder):
    return op.tokenize(documents(spark, folder)).select("doc_id", F.array_join("token", " ").alias("token"))


@query(f"SELECT doc_id, array_to_string({NORMAL_SQL}, ' ') AS normal FROM documents")
def normalize_texts(spark, folder):
    words = op.normalize(op.tokenize(documents(spark, folder)))
    return words.select("doc_id", F.array_join("normal", " ").alias("normal"))


@query(with_text("""
SELECT *, CASE WHEN stars IN ('5.0', '4.0') THEN 'positive' WHEN stars IN ('1.0', '2.0') THEN 'negative' END AS train_sentiment
FROM text_reviews WHERE stars <> '3.0'"""))
def weak_labels(spark, folder):
    return op.weak_labels(text_reviews(spark, folder))


@query(with_text(f"{MODEL_SQL} SELECT word, positive, negative FROM counts"))
def word_class_counts(spark, folder):
    return op.word_class_counts(op.weak_labels(text_reviews(spark, folder)))


@query(with_text(f"{MODEL_SQL} SELECT word, round(weight / 1000000000.0, 6) AS weight FROM weights"))
def model_vocabulary(spark, folder):
    """The trained model itself: every word of the labelled texts with its weight."""
    return _model(text_reviews(spark, folder)).weights.select("word", F.round(F.col("weight") / 1e9, 6).alias("weight"))


@query(with_text(f"{MODEL_SQL} SELECT * FROM scored"))
def sentiment_scores(spark, folder):
    reviews = text_reviews(spark, folder)
    return _shown(op.score_sentiment(reviews, _model(reviews)))


@query(with_text(f"{MODEL_SQL} SELECT review_id, stars, final_sentiment, right_prediction FROM flagged"))
def agreement_flag(spark, folder):
    return _shown(_flagged(spark, folder).select("review_id", "stars", "final_sentiment", "right_prediction"))


@query(with_text(f"""
{MODEL_SQL} SELECT CAST(sum(right_prediction) AS BIGINT) AS "right", count(*) AS total,
round(sum(right_prediction)::DOUBLE / count(*), 6) AS accuracy FROM flagged"""))
def sentiment_accuracy(spark, folder):
    return op.accuracy(_flagged(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


@query(with_text(f"{MODEL_SQL} SELECT review_id, stars, text FROM flagged WHERE right_prediction = 0"))
def mispredicted_rows(spark, folder):
    return op.mispredicted(_flagged(spark, folder)).select("review_id", "stars", "text")


@query(with_text(f"{MODEL_SQL} SELECT * FROM scored"))
def scoring_job(spark, folder):
    source, scored = new_name("reviews"), new_name("scored")
    src.overwrite_table(text_reviews(spark, folder), source)
    op.score_job(spark, source, scored, _model(spark.read.table(source)))
    src.drop_table(spark, source)
    return _shown(taken(spark, scored))


CATEGORY_SQL = f"""
{MODEL_SQL} SELECT r.review_id, b.business_id, r.text, r.date, b.categories, r.stars, r.final_sentiment, r.right_prediction
FROM flagged r JOIN text_business b ON b.business_id = r.business_id WHERE contains(b.categories, '{TEXT_CATEGORY}')"""


@query(with_text(CATEGORY_SQL))
def category_reviews_scored(spark, folder):
    reviews = text_reviews(spark, folder)
    scored = scored_category_reviews(reviews, text_business(spark, folder), TEXT_CATEGORY, _model(reviews))
    return _shown(scored)


@query(with_text(CATEGORY_SQL))
def category_reviews_upserted(spark, folder):
    """The main application twice on one table: create, then merge the same batch."""
    reviews, business = text_reviews(spark, folder), text_business(spark, folder)
    model, name = _model(reviews), new_name("category_sentiment")
    for _ in range(2):
        category_sentiment(spark, reviews, business, TEXT_CATEGORY, model, name)
    return _shown(taken(spark, name))


# Trained on four of five reviews by key; the others, without those of three stars, are what counts.
TRAIN_SQL = f"{bucket_sql('review_id', 42)} < 0.8::DOUBLE * {WIDTH}"
HELD_OUT_SQL = f"""
{MODEL_SQL.replace("FROM words WHERE stars <> '3.0')", f"FROM words WHERE stars <> '3.0' AND {TRAIN_SQL})")}
, held_out AS (SELECT * FROM flagged WHERE stars <> '3.0' AND NOT ({TRAIN_SQL}))"""


def _held_out(spark, folder):
    train, test = op.split(text_reviews(spark, folder), [0.8, 0.2], 42, "review_id")
    return op.right_prediction(op.score_sentiment(op.weak_labels(test), _model(train)))


@query(with_text(f"""
{HELD_OUT_SQL} SELECT CAST(sum(right_prediction) AS BIGINT) AS "right", count(*) AS total,
round(sum(right_prediction)::DOUBLE / count(*), 6) AS accuracy FROM held_out"""))
def held_out_accuracy(spark, folder):
    return op.accuracy(_held_out(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


@query(with_text(f"""
{HELD_OUT_SQL} SELECT CASE WHEN stars IN ('5.0', '4.0') THEN 'positive' ELSE 'negative' END AS label, final_sentiment AS prediction, count(*) AS count
FROM held_out GROUP BY ALL"""))
def held_out_confusion(spark, folder):
    return op.confusion(_shown(_held_out(spark, folder)), "train_sentiment", "final_sentiment").toDF("label", "prediction", "count")
