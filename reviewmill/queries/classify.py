"""Features, weights, classifiers and their evaluation."""

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..plans import star_model
from .registry import query
from .sampling import WIDTH, bucket_sql
from .sentiment import MODEL_SQL, _flagged
from .standins import documents, new_name, table, taken, text_reviews, with_text

# Java drops empty words at the end of a split, so white space there goes first.
ML_WORDS_SQL = r"string_split_regex(regexp_replace(lower(text), '[\s\x0B]+$', ''), '[\s\x0B]')"

# Spark's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
itself they them their theirs themselves what which who whom this that these those am is are was were be been being
have has had having do does did doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over under again further then once
here there when where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()


def _stop_words_sql():
    quoted = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
    return f"list_filter({ML_WORDS_SQL}, lambda x: x NOT IN ({quoted}))"


@query(f"SELECT doc_id, array_to_string({ML_WORDS_SQL}, '|') AS words FROM documents")
def ml_words(spark, folder):
    words = Tokenizer(inputCol="text", outputCol="words").transform(documents(spark, folder))
    return words.select("doc_id", F.array_join("words", "|").alias("words"))


@query(f"SELECT doc_id, array_to_string({_stop_words_sql()}, '|') AS words FROM documents")
def ml_stop_words(spark, folder):
    words = Tokenizer(inputCol="text", outputCol="all").transform(documents(spark, folder))
    kept = StopWordsRemover(inputCol="all", outputCol="words").transform(words)
    return kept.select("doc_id", F.array_join("words", "|").alias("words"))


@query(f"SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, unnest({ML_WORDS_SQL}) AS term FROM documents) GROUP BY ALL")
def term_counts(spark, folder):
    """Kept in a table bucketed by document, so that counting moves no row."""
    name = new_name("documents")
    texts = documents(spark, folder).select("doc_id", "text")
    src.create_bucketed_table(texts, name, "doc_id", text_buckets(texts))
    return op.term_counts(taken(spark, name), "doc_id")


# A bucket is read and counted by one task: at most so many bytes of text go into one.
BUCKET_TEXT_BYTES = 32 << 20


def text_buckets(texts, least=16):
    """Buckets for the texts, so many that each holds about ``BUCKET_TEXT_BYTES`` of text, ``least`` at least."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-size // BUCKET_TEXT_BYTES))


@query(f"SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, unnest({ML_WORDS_SQL}) AS term FROM documents) GROUP BY ALL")
def term_counts_of_any_table(spark, folder):
    """The same on a table of any layout: counted in the task, then brought together."""
    return op.term_counts(documents(spark, folder), "doc_id")


@query(f"""
WITH counts AS (SELECT doc_id, term, count(*) AS count FROM (SELECT doc_id, unnest({ML_WORDS_SQL}) AS term FROM documents) GROUP BY ALL)
, freq AS (SELECT term, count(*) AS doc_freq FROM (SELECT unnest(list_distinct({ML_WORDS_SQL})) AS term FROM documents) GROUP BY term)
SELECT doc_id, c.term, count, CASE WHEN doc_freq >= 5
       THEN round(count * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (doc_freq + 1.0::DOUBLE)), 6) ELSE 0 END AS weight
FROM counts c JOIN freq f ON f.term = c.term""")
def tfidf_values(spark, folder):
    return op.tfidf_weights(documents(spark, folder), "doc_id").withColumn("weight", F.round("weight", 6))


@query(f"""
SELECT term, doc_freq, CASE WHEN doc_freq >= 5 THEN round(ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (doc_freq + 1.0::DOUBLE)), 6)
       ELSE 0 END AS idf
FROM (SELECT term, count(*) AS doc_freq FROM (SELECT unnest(list_distinct({ML_WORDS_SQL})) AS term FROM documents) GROUP BY term)""")
def document_frequencies(spark, folder):
    return op.doc_freq(documents(spark, folder)).withColumn("idf", F.round("idf", 6))


LABEL_SQL = """
, indexed AS (
  SELECT stars AS class, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, stars) - 1 AS DOUBLE) AS label
  FROM text_reviews WHERE stars IS NOT NULL GROUP BY stars)"""


@query(with_text(f"{LABEL_SQL} SELECT review_id, stars, label FROM text_reviews JOIN indexed ON class = stars"))
def label_index(spark, folder):
    return op.index_labels(text_reviews(spark, folder).select("review_id", "stars"), "stars")


@query("""
SELECT l_orderkey, l_linenumber, concat_ws(' ', CAST(l_quantity AS BIGINT), l_linenumber, l_partkey) AS features FROM lineitem""")
def vector_assembly(spark, folder):
    lines = op.assemble(table(spark, folder, "lineitem"), ["l_quantity", "l_linenumber", "l_partkey"])
    parts = F.transform(vector_to_array("features"), lambda x: x.cast("bigint").cast("string"))
    return lines.select("l_orderkey", "l_linenumber", F.array_join(parts, " ").alias("features"))


FEATURES_SQL = f"""
{LABEL_SQL}, kept AS (SELECT review_id, stars, {{words}} AS words FROM text_reviews WHERE stars IS NOT NULL)
SELECT review_id, label, CAST(len(words) AS BIGINT) AS n_words FROM kept JOIN indexed ON class = stars"""


def _features(spark, folder, stop):
    """Rows after the fitted feature stages; the hashed counts of a row add up to its words."""
    reviews = text_reviews(spark, folder).where("stars IS NOT NULL").select("review_id", "text", "stars")
    rows = op.tfidf_stages(stop).fit(reviews).transform(reviews)
    counts = F.aggregate(F.unwrap_udt("tf")["values"], F.lit(0.0), lambda total, x: total + x)
    return rows.select("review_id", "label", counts.cast("bigint").alias("n_words"))


@query(with_text(FEATURES_SQL.format(words=_stop_words_sql())))
def tfidf_features(spark, folder):
    return _features(spark, folder, True)


@query(with_text(FEATURES_SQL.format(words=ML_WORDS_SQL)))
def tfidf_features_all_words(spark, folder):
    return _features(spark, folder, False)


@query(with_text("""
SELECT stars, count(*) AS count, round(sum(count(*)) OVER () / (count(*) OVER ())::DOUBLE / count(*), 6) AS weight
FROM text_reviews WHERE stars IS NOT NULL GROUP BY stars"""))
def class_weights(spark, folder):
    return op.class_weights(text_reviews(spark, folder), "stars").withColumn("weight", F.round("weight", 6))


def _balanced_sql(name, part):
    """Rows of the text reviews that satisfy ``part``, balanced by class."""
    return f"""
, {name}_part AS (SELECT review_id, stars FROM text_reviews WHERE stars IS NOT NULL AND {part})
, {name}_counts AS (SELECT stars, count(*) AS n FROM {name}_part GROUP BY stars)
, {name} AS (SELECT p.* FROM {name}_part p JOIN {name}_counts c ON c.stars = p.stars
    WHERE {bucket_sql('p.review_id', 2)} < (SELECT min(n) FROM {name}_counts)::DOUBLE / c.n * {WIDTH})"""


TRAIN = f"{bucket_sql('review_id', 1)} < 0.8::DOUBLE * {WIDTH}"


@query(with_text(f"""
{_balanced_sql('train', TRAIN)} {_balanced_sql('test', 'NOT ' + TRAIN)}
, labels_of_train AS (
  SELECT stars, CAST(row_number() OVER (ORDER BY count(*) DESC, stars) - 1 AS DOUBLE) AS label FROM train GROUP BY stars)
SELECT review_id, t.stars, label FROM test t JOIN labels_of_train l ON l.stars = t.stars"""))
def star_predicted_rows(spark, folder):
    """All of the written predictions but the prediction: split, balance and labels of the whole classifier run."""
    return star_predictions(spark, folder).drop("prediction")


@query()
def star_predictions(spark, folder):
    name = new_name("star_predictions")
    star_model(spark, text_reviews(spark, folder), name)
    return taken(spark, name)


# The largest part of the mean weighted loss's gradient that a finished fit may have.
FLAT = 1e-3


@query(with_text(f"""
{_balanced_sql('train', TRAIN)}
SELECT stars, CAST(row_number() OVER (ORDER BY count(*) DESC, stars) - 1 AS DOUBLE) AS label, count(*) AS rows, true AS at_optimum FROM train GROUP BY stars"""))
def star_fit_certificate(spark, folder):
    """Per class its label, its rows, and whether the gradient of its part of the loss is flat at the fitted weights."""
    clean = op.strip_links(text_reviews(spark, folder).where("stars IS NOT NULL").select("review_id", "stars", "text").na.fill("", "text"))
    train, _ = op.stratified_split(clean, "stars", 0.8, 1, "review_id")
    with op.staged(op.balance(train, "stars", 2, "review_id").hint("rebalance"), "train") as rows:
        fitted = op.tfidf_stages().fit(rows)
        train = fitted.transform(rows)
        weights = op.class_weights(train).select("label", "weight")
        steepest = op.loss_gradient(op.fit_stars(train), train.join(weights, "label"), weight_col="weight").groupBy(F.col("class").cast("double").alias("label"))
        flat = steepest.agg((F.max(F.abs("gradient")) < FLAT).alias("at_optimum"))
        found = train.groupBy("stars", "label").agg(F.count("*").alias("rows")).join(flat, "label")
        lines = found.select("stars", "label", "rows", "at_optimum").collect()  # a line per class
    return spark.createDataFrame(lines, "stars string, label double, rows long, at_optimum boolean")


HELD_OUT_VECTOR = f"{bucket_sql('vec_id', 3)} >= 0.8::DOUBLE * {WIDTH}"


def _predicted_vectors(spark, folder):
    """Fitted on four of five vectors by key, applied to the others."""
    train, test = op.split(table(spark, folder, "embeddings"), [0.8, 0.2], 3, "vec_id")
    return op.fit_embeddings(train).transform(test)


@query()
def embedding_predictions(spark, folder):
    return _predicted_vectors(spark, folder).select("vec_id", "label", "prediction")


@query(f"SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS class_rows, true AS predicted FROM embeddings WHERE {HELD_OUT_VECTOR}")
def embedding_held_out_rows(spark, folder):
    """All of the predictions but the prediction: split, labels, class sizes, and that it is one of the classes."""
    classes = [r[0] for r in table(spark, folder, "embeddings").select("label").distinct().collect()]
    found = _predicted_vectors(spark, folder)
    sizes = found.groupBy("label").agg(F.count("*").alias("class_rows"))
    return found.join(sizes, "label").select("vec_id", "label", "class_rows", F.coalesce(F.col("prediction").isin(classes), F.lit(False)).alias("predicted"))


# Sentiment labels against the stars they stand for, as class indices: 1 positive, 0 negative.
PAIRS_SQL = f"""
{MODEL_SQL}, pairs AS (
  SELECT CAST(CASE WHEN stars IN ('5.0', '4.0') THEN 1 ELSE 0 END AS DOUBLE) AS label,
         CAST(CASE WHEN final_sentiment = 'positive' THEN 1 ELSE 0 END AS DOUBLE) AS prediction
  FROM flagged WHERE stars <> '3.0')
, cells AS (SELECT label, prediction, count(*) AS count FROM pairs GROUP BY ALL)
, metrics AS (
  SELECT class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(hits) AS BIGINT) AS hits
  FROM (SELECT label AS class, count AS support, 0 AS predicted, CASE WHEN label = prediction THEN count ELSE 0 END AS hits FROM cells
        UNION ALL SELECT prediction, 0, count, 0 FROM cells) GROUP BY class)
, rated AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits::DOUBLE / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits::DOUBLE / support END AS recall, 2.0::DOUBLE * hits / (predicted + support) AS f1
  FROM metrics)"""


def _pairs(spark, folder):
    positive = F.array_contains("final_sentiment", "positive")
    return _flagged(spark, folder).where("stars <> '3.0'").select(
        F.col("stars").isin("5.0", "4.0").cast("double").alias("label"), positive.cast("double").alias("prediction")
    )


@query(with_text(f"{PAIRS_SQL} SELECT * FROM cells"))
def confusion_matrix(spark, folder):
    return op.confusion(_pairs(spark, folder))


@query(with_text(f"""
{PAIRS_SQL} SELECT class, support, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM rated"""))
def class_metrics(spark, folder):
    metrics = op.class_metrics(_pairs(spark, folder))
    return metrics.select("class", "support", "predicted", "hits", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


F1_SQL = with_text(f"{PAIRS_SQL} SELECT round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM rated")


@query(F1_SQL)
def weighted_f1(spark, folder):
    return op.f1_weighted(_pairs(spark, folder)).withColumn("f1_weighted", F.round("f1_weighted", 6))


@query(F1_SQL)
def weighted_f1_of_evaluator(spark, folder):
    value = op.evaluate_f1(_pairs(spark, folder))
    return spark.createDataFrame([[round(value, 6)]], "f1_weighted double")


@query(with_text(f"{PAIRS_SQL} SELECT * FROM pairs"))
def persisted_predictions(spark, folder):
    name = new_name("predictions")
    src.overwrite_table(_pairs(spark, folder), name)
    return taken(spark, name)
