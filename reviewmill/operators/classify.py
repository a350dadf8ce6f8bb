"""Star-rating classifier on Spark ML: features, weights, fit, evaluation."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    HashingTF, IDF, StopWordsRemover, StringIndexer, Tokenizer, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.text import plain_words
from .sampling import join_per_class

# Width of the hashed term vector and the document frequency below which a term weighs 0.
TERM_BUCKETS = 2 ** 16
MIN_DOC_FREQ = 5


def tfidf_stages(stop_words=True, label_col="stars"):
    """Words, stop words, hashed counts, document frequencies, label index; to be fitted on the train rows."""
    words = Tokenizer(inputCol="text", outputCol="words")
    stop = StopWordsRemover(inputCol="words", outputCol="filtered_words")
    counts = HashingTF(numFeatures=TERM_BUCKETS, inputCol="filtered_words" if stop_words else "words", outputCol="tf")
    weights = IDF(inputCol="tf", outputCol="features", minDocFreq=MIN_DOC_FREQ)
    label = StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="skip")
    return Pipeline(stages=[words, *([stop] if stop_words else []), counts, weights, label])


def term_counts(df, key, text_col="text"):
    """Occurrences of each word in the rows of each key: the hashed counts without hashing.

    Counted in the task before anything moves. On a table that is bucketed by the key (``sources.create_bucketed_table``) nothing
    moves at all.
    """
    return df.select(key, F.explode(plain_words(F.col(text_col))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("count"))


def doc_freq(df, text_col="text", min_df=MIN_DOC_FREQ):
    """Rows that hold each word and its inverse document frequency, 0 below ``min_df`` rows."""
    words = F.explode(F.array_distinct(plain_words(F.col(text_col)))).alias("term")
    counts = df.select(words).groupBy("term").agg(F.count("*").alias("doc_freq"))
    rows = df.agg(F.count("*")).scalar()
    idf = F.log((rows + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    return counts.withColumn("idf", F.when(F.col("doc_freq") >= min_df, idf).otherwise(0.0))


def tfidf_weights(df, key, text_col="text", min_df=MIN_DOC_FREQ):
    """Count and TF-IDF weight of each word in each row: the feature vectors without hashing, as a table.

    Counts meet the document frequencies in a plain join, which Spark splits where a word is in a large share of all rows.
    """
    return term_counts(df, key, text_col).join(doc_freq(df, text_col, min_df), "term").select(
        key, "term", "count", (F.col("count") * F.col("idf")).alias("weight")
    )


def index_labels(df, col, output="label"):
    """Label index: most frequent class first, ties by name. Rows without a class are dropped."""
    indexer = StringIndexer(inputCol=col, outputCol=output, handleInvalid="skip")
    return indexer.fit(df).transform(df)


def assemble(df, cols, output="features"):
    """Numeric columns to one vector; rows with a NULL among them are dropped."""
    return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="skip").transform(df)


def class_weights(df, label_col="label"):
    """Weight of each class: rows / (classes * rows of the class)."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count("*").alias("count"))
    totals = counts.agg(F.sum("count") / F.count("*")).scalar()
    return counts.withColumn("weight", totals / F.col("count"))


def fit_stars(df, balanced=True, label_col="label", features_col="features", max_iter=100):
    """Multinomial logistic regression; ``balanced`` weighs every class alike."""
    model = LogisticRegression(maxIter=max_iter, featuresCol=features_col, labelCol=label_col)
    if not balanced:
        return model.fit(df)
    weights = class_weights(df, label_col).select(label_col, "weight")
    return model.setWeightCol("weight").fit(join_per_class(df, weights, label_col))


def loss_gradient(model, df, label_col="label", features_col="features", weight_col=None):
    """Gradient of the mean weighted loss of a fitted logistic regression, one row per class and feature: (class, feature, gradient).

    All of them near 0 prove that the fit has reached the optimum. Feature -1 is the intercept. One aggregation over the rows; features that are 0 in
    all rows have no row.
    """
    weight = F.lit(1.0) if weight_col is None else F.col(weight_col)
    vector = F.unwrap_udt(features_col)
    places = F.coalesce(vector["indices"], F.when(F.size(vector["values"]) > 0, F.sequence(F.lit(0), F.size(vector["values"]) - 1)))
    entries = F.arrays_zip(
        F.concat(F.array(F.lit(-1)), F.coalesce(places, F.array().cast("array<int>"))).alias("feature"),
        F.concat(F.array(F.lit(1.0)), vector["values"]).alias("value"),
    )
    rows = model.transform(df).select(F.col(label_col).alias("label"), weight.alias("weight"), entries.alias("entries"), vector_to_array(model.getProbabilityCol()).alias("p"))
    total = rows.agg(F.sum("weight")).scalar()
    classes = rows.select("label", "weight", "entries", F.posexplode("p").alias("class", "p"))
    miss = F.col("weight") * (F.col("p") - (F.col("label") == F.col("class")).cast("double"))
    cells = classes.select("class", miss.alias("miss"), F.inline("entries"))
    sums = cells.groupBy("class", "feature").agg(F.sum(F.col("miss") * F.col("value")).alias("sum"))
    return sums.select("class", "feature", (F.col("sum") / total).alias("gradient"))


class VectorClassifier:
    """Linear scores per class: weights is (dimensions + 1) x classes, its last line the intercepts."""

    def __init__(self, classes, weights, vec_col):
        self.classes, self.weights, self.vec_col = classes, weights, vec_col

    def transform(self, df):
        """``df`` with ``prediction``, the class of the highest score, ties to the lower class. NULL for a vector that is
        NULL, of another length or not finite."""
        vector = F.col(self.vec_col).cast("array<double>")

        def score(column):
            terms = F.zip_with(vector, F.array(*[F.lit(float(w)) for w in column[:-1]]), lambda x, w: x * w)
            return F.aggregate(terms, F.lit(float(column[-1])), lambda total, x: total + x)

        usable = _usable_vector(vector, len(self.weights) - 1)
        best = F.array_max(F.array(*[F.struct(score(self.weights[:, c]).alias("score"), F.lit(-c).alias("class")) for c in range(len(self.classes))]))
        value = F.element_at(F.array(*[F.lit(float(c)) for c in self.classes]), 1 - best["class"])
        return df.withColumn("prediction", F.when(usable, value))


def _usable_vector(vector, width=None):
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    right = vector.isNotNull() & ~wrong
    return right if width is None else right & (F.size(vector) == width)


# Components are rounded to so many steps of the largest one.
VECTOR_STEPS = 1 << 12


def fit_embeddings(df, vec_col="embedding", label_col="label", ridge=1e-3):
    """Least-squares classifier on ready-made dense vectors, in closed form.

    Every class has the indicator of its rows as its target. The sums of all products of two components, and of components and
    indicators, come from one aggregation; the driver solves the normal equations of so many lines as a vector has components. Products of
    components are whole numbers (in steps of the largest component), so their sums, and with them the fit, are the same on any layout
    and after any retry. Rows without a label, or with a vector that is NULL or not finite, take no part; all vectors
    must have one length. ``ridge`` is a share of the mean square of a component.
    """
    rows = df.select(F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vector")).where(F.col("label").isNotNull())
    rows = rows.where(_usable_vector(F.col("vector")))
    size = F.size("vector")
    shape = rows.agg(F.max(size).alias("width"), F.min(size).alias("least"), F.max(F.array_max(F.transform("vector", F.abs))).alias("largest")).first()
    if shape.width is None:
        raise ValueError("there is no row with a label and a vector")
    if shape.width != shape.least:
        raise ValueError(f"vectors have lengths from {shape.least} to {shape.width}")
    width, step = shape.width, (shape.largest or 1.0) / VECTOR_STEPS
    classes = sorted(r[0] for r in rows.select("label").distinct().collect())
    # In whole steps, and a last component that is always one step: the intercept.
    whole = F.concat(F.transform("vector", lambda x: F.round(x / step).try_cast("long")), F.array(F.lit(1).cast("long")))
    lines = rows.select("label", whole.alias("v")).select("label", "v", F.posexplode("v").alias("line", "x"))
    sums = lines.groupBy("line").agg(
        F.array(*[F.sum(F.col("x") * F.col("v")[i]) for i in range(width + 1)]).alias("products"),
        F.array(*[F.sum(F.when(F.col("label") == c, F.col("x")).otherwise(0)) for c in classes]).alias("targets"),
    ).collect()
    products, targets = np.zeros((width + 1, width + 1)), np.zeros((width + 1, len(classes)))
    for r in sums:
        products[r.line], targets[r.line] = r.products, r.targets
    penalty = np.eye(width + 1) * ridge * max(1.0, np.trace(products[:width, :width]) / max(width, 1))
    penalty[width, width] = 0.0
    root = np.linalg.cholesky(products + penalty)
    weights = np.linalg.solve(root.T, np.linalg.solve(root, targets))
    weights[:width] /= step
    return VectorClassifier(classes, weights, vec_col)


def embedding_features(df, vec_col="embedding"):
    return df.withColumn("features", array_to_vector(F.col(vec_col)))


def evaluate_f1(predictions):
    """Weighted F1 of an evaluated model, as a number."""
    return MulticlassClassificationEvaluator(predictionCol="prediction", labelCol="label").evaluate(predictions)


def confusion(df, label_col="label", prediction_col="prediction"):
    """Rows per (label, prediction)."""
    return df.groupBy(label_col, prediction_col).agg(F.count("*").alias("count"))


def class_metrics(df, label_col="label", prediction_col="prediction"):
    """Support, precision, recall and F1 of every class, from one pass over the rows.

    Each confusion cell is booked once under its label and once under its prediction.
    """
    hit = F.when(F.col(label_col) == F.col(prediction_col), F.col("count")).otherwise(0)
    booked = confusion(df, label_col, prediction_col).select(F.inline(F.array(
        F.struct(F.col(label_col).alias("class"), F.col("count").alias("support"), F.lit(0).alias("predicted"), hit.alias("hits")),
        F.struct(F.col(prediction_col).alias("class"), F.lit(0).alias("support"), F.col("count").alias("predicted"), F.lit(0).alias("hits")),
    )))
    sums = booked.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("predicted") + F.col("support")), F.lit(0.0))
    return sums.select("class", "support", "predicted", "hits", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def f1_weighted(df, label_col="label", prediction_col="prediction"):
    """Class F1 averaged by support."""
    metrics = class_metrics(df, label_col, prediction_col)
    total = F.sum("support")
    return metrics.agg(F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("f1_weighted"))
