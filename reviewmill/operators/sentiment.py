"""Sentiment of review texts: train on star-derived labels, score, compare with the stars.

The model is a naive Bayes over the presence of words in a text, with Laplace smoothing. It is a table of words and weights, with every
word of the training texts; nothing of it passes through the driver but three sums. Weights are whole numbers, in parts of ``UNIT``,
so that a score is the same in whatever order it is added up.

Scoring explodes the words of a text, joins them with the weights and adds them up per text, in the task first. The words of the texts
never move: the weights are broadcast, in as many parts by the hash of the word as it takes to keep each part under
``WORDS_PER_BROADCAST`` words, and each part is joined in the tasks that read the texts. Only sums per text are shuffled, one row per text and
part. Texts are told apart by their digest, so equal ones are scored alike, whatever the key of the rows.
"""

from collections import namedtuple
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from ..functions.text import normal_tokens, normal_words, tokens
from ..schemas import AGREEING_STARS, NEGATIVE, NEUTRAL_STARS, POSITIVE, TRAINING_STARS, UNKNOWN
from ..session import scratch_path
from ..sources.catalog import overwrite_table
from ..sources.tables import read_table, write_parquet

UNIT = 10 ** 9

# Most words of the model that one broadcast part of the weights holds.
WORDS_PER_BROADCAST = 1 << 21

# ``weights``: a stored table (word, weight); ``prior``: the weight of a text without words.
SentimentModel = namedtuple("SentimentModel", "weights prior")


def tokenize(df, col="text"):
    return df.withColumn("token", tokens(F.col(col)))


def normalize(df):
    return df.withColumn("normal", normal_tokens(F.col("token")))


def weak_labels(df):
    """5 and 4 stars -> positive, 1 and 2 -> negative; rows with 3 stars, or with none, are dropped."""
    stars = F.col("stars")
    labels = [F.when(stars.isin(values), label) for label, values in TRAINING_STARS.items()]
    return df.where(stars != NEUTRAL_STARS).withColumn("train_sentiment", F.coalesce(*labels))


def word_class_counts(df, label_col="train_sentiment", text_col="text"):
    """Texts of each label that hold a word: (word, positive, negative).

    Words are counted on the map side, so a word that is in every text costs one row per task.
    """
    words = df.where(F.col(label_col).isin(POSITIVE, NEGATIVE)).select(
        label_col, F.explode(F.array_distinct(normal_words(F.col(text_col)))).alias("word")
    )
    return _class_counts(words, label_col)


def _class_counts(words, label_col):
    return words.groupBy("word").agg(
        F.count_if(F.col(label_col) == POSITIVE).alias("positive"),
        F.count_if(F.col(label_col) == NEGATIVE).alias("negative"),
    )


def _weight(positive, negative):
    return F.round((F.log(positive) - F.log(negative)) * UNIT).cast("long")


def train_sentiment(df, label_col="train_sentiment", text_col="text"):
    """Fit on the rows labelled positive or negative.

    The texts are read once, to count words per label; an empty word in each text counts the texts themselves.
    """
    texts = df.where(F.col(label_col).isin(POSITIVE, NEGATIVE))
    words = F.concat(F.array(F.lit("")), F.coalesce(F.array_distinct(normal_words(F.col(text_col))), F.array().cast("array<string>")))
    counts = _class_counts(texts.select(label_col, F.explode(words).alias("word")), label_col)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "word_counts")
    write_parquet(counts, path)
    counts = read_table(spark, path)
    sums = counts.groupBy((F.col("word") == "").alias("texts")).agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative"), F.count("*").alias("words")
    )
    sums = {row.texts: row for row in sums.collect()}
    if True not in sums or not sums[True].positive or not sums[True].negative:
        raise ValueError("training needs texts of both labels")
    if False not in sums:
        raise ValueError("no labelled text has a word")
    size, all_texts = sums[False], sums[True]
    positive = (F.col("positive") + 1) / F.lit(float(size.positive + size.words))
    negative = (F.col("negative") + 1) / F.lit(float(size.negative + size.words))
    weights = counts.where("word <> ''").select("word", _weight(positive, negative).alias("weight"))
    prior = spark.range(1).select(_weight(F.lit(all_texts.positive + 1.0), F.lit(all_texts.negative + 1.0)).alias("prior")).first().prior
    return SentimentModel(weights, prior)


def score_sentiment(df, model, text_col="text", words_per_part=WORDS_PER_BROADCAST):
    """Add ``final_sentiment``, an array with one label: positive, negative, or na without a known word."""
    coded = df.withColumn("_code", F.md5(F.col(text_col)))
    texts = coded.where("_code IS NOT NULL")
    weights = model.weights.select(F.col("word").alias("_word"), "weight")
    parts = max(1, -(-weights.count() // words_per_part))
    part = lambda word: F.pmod(F.xxhash64(word), F.lit(parts))
    # Rows of one text: its words are added up once per row, so the sums are divided by them.
    found = [texts.groupBy("_code").agg(F.lit(None).cast("long").alias("_sum"), F.lit(0).cast("long").alias("_known"), F.count("*").alias("_rows"))]
    for i in range(parts):
        words = texts.select("_code", F.explode(F.array_distinct(normal_words(F.col(text_col)))).alias("word")).where(part("word") == i)
        known = words.join(F.broadcast(weights.where(part("_word") == i)), F.col("word") == F.col("_word"))
        found.append(known.groupBy("_code").agg(F.sum("weight").alias("_sum"), F.count("weight").alias("_known"), F.lit(0).cast("long").alias("_rows")))
    sums = reduce(lambda a, b: a.unionByName(b), found).groupBy("_code").agg(
        F.sum("_sum").alias("_sum"), F.sum("_known").alias("_known"), F.sum("_rows").alias("_rows")
    )
    score = F.lit(model.prior) + F.col("_sum") / F.col("_rows")
    label = F.when(F.coalesce(F.col("_known"), F.lit(0)) == 0, UNKNOWN).when(score > 0, POSITIVE).otherwise(NEGATIVE)
    # Merged at every size, so that the rows move the same way however many texts there are.
    scored = coded.join(sums.hint("merge"), "_code", "left").withColumn("final_sentiment", F.array(label))
    return scored.select(*df.columns, "final_sentiment")


def right_prediction(df):
    """Flag 1 where the label agrees with the stars; three stars agree with either label."""
    agrees = reduce(or_, [
        F.array_contains("final_sentiment", label) & F.col("stars").isin(values) for label, values in AGREEING_STARS.items()
    ])
    return df.withColumn("right_prediction", F.coalesce(agrees, F.lit(False)).cast("int"))


def accuracy(df):
    """Sum of the flags, rows and their ratio, in one pass. The ratio is NULL without rows."""
    right, total = F.sum("right_prediction"), F.count("*")
    return df.agg(right.alias("right"), total.alias("total"), F.try_divide(right, total).alias("accuracy"))


def score_job(spark, src, dst, model):
    """Score the catalog table ``src`` and overwrite the table ``dst`` with it."""
    overwrite_table(score_sentiment(spark.read.table(src), model), dst)
