"""Samples, splits and balancing: by the hash bucket of a key, and without a key by that of the whole row."""

from pyspark.sql import functions as F

from .. import operators as op
from ..plans import demo_batches as run_demo
from ..session import scratch_path
from .registry import query
from .standins import new_name, sales_reviews, table, taken, text_reviews, with_text


def bucket_sql(key, seed):
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{seed}'), 1, 8)) AS UBIGINT)"


WIDTH = "4294967296.0::DOUBLE"
N_ROWS = 100


def sample_sql(seed):
    return f"SELECT * FROM documents WHERE {bucket_sql('doc_id', seed)} < {N_ROWS}::DOUBLE / (SELECT count(*) FROM documents) * {WIDTH}"


@query(sample_sql(42))
def sample_by_key(spark, folder):
    return op.sample_about(table(spark, folder, "documents"), N_ROWS, 42, "doc_id")


def drawn_sql(columns, source, seed):
    """Rows of ``source`` with the bucket of their fields and their place among equal rows."""
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    place = f"row_number() OVER (PARTITION BY {', '.join(columns)}) - 1"
    return f"SELECT *, {bucket_sql(f'(md5({text}) || {SLASH} || place)', seed)} AS bucket FROM (SELECT *, {place} AS place FROM {source})"


SLASH = "'/'"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
LINE = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(f"SELECT {', '.join(DOCUMENT)} FROM ({drawn_sql(DOCUMENT, 'documents', 42)}) WHERE bucket < {N_ROWS}::DOUBLE / (SELECT count(*) FROM documents) * {WIDTH}")
def sample_by_draw(spark, folder):
    return op.sample_about(table(spark, folder, "documents"), N_ROWS, 42)


@query(f"""
SELECT {', '.join(LINE)}, count(*) AS count FROM ({drawn_sql(LINE, 'lineitem', 42)})
WHERE bucket < 1000::DOUBLE / (SELECT count(*) FROM lineitem) * {WIDTH} GROUP BY ALL""")
def sample_of_equal_rows(spark, folder):
    """Few different rows, each there thousands of times: how often each was drawn."""
    return op.sample_about(table(spark, folder, "lineitem").select(LINE), 1000, 42).groupBy(LINE).agg(F.count("*").alias("count"))


@query(f"""
SELECT doc_id, CASE WHEN {bucket_sql('doc_id', 42)} < 0.8::DOUBLE * {WIDTH} THEN 'train' ELSE 'test' END AS part FROM documents""")
def split_by_key(spark, folder):
    train, test = op.split(table(spark, folder, "documents").select("doc_id"), [0.8, 0.2], 42, "doc_id")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(f"SELECT doc_id, CASE WHEN bucket < 0.8::DOUBLE * {WIDTH} THEN 'train' ELSE 'test' END AS part FROM ({drawn_sql(DOCUMENT, 'documents', 42)})")
def split_by_draw(spark, folder):
    """The drawn parts are disjoint and cover the table."""
    train, test = op.split(table(spark, folder, "documents"), [0.8, 0.2], 42)
    return train.select("doc_id", F.lit("train").alias("part")).union(test.select("doc_id", F.lit("test")))


@query(with_text(f"""
SELECT review_id, stars, CASE WHEN {bucket_sql('review_id', 1)} < 0.8::DOUBLE * {WIDTH} THEN 'train' ELSE 'test' END AS part
FROM text_reviews"""))
def stratified_split(spark, folder):
    reviews = text_reviews(spark, folder).select("review_id", "stars")
    train, test = op.stratified_split(reviews, "stars", 0.8, 1, "review_id")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(with_text(f"""
SELECT review_id, stars, CASE WHEN {bucket_sql('review_id', 1)} <
    CASE stars WHEN '5.0' THEN 0.25::DOUBLE WHEN '2.0' THEN 0.5::DOUBLE ELSE 0::DOUBLE END * {WIDTH} THEN 'train' ELSE 'test' END AS part
FROM text_reviews"""))
def stratified_split_per_class(spark, folder):
    reviews = text_reviews(spark, folder).select("review_id", "stars")
    train, test = op.stratified_split(reviews, "stars", {"5.0": 0.25, "2.0": 0.5}, 1, "review_id")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(with_text(f"""
SELECT review_id, stars, CASE WHEN bucket < CASE WHEN stars IS NULL THEN 0::DOUBLE ELSE 0.8::DOUBLE END * {WIDTH} THEN 'train' ELSE 'test' END AS part
FROM ({drawn_sql(['review_id', 'stars'], '(SELECT review_id, stars FROM text_reviews)', 1)})"""))
def stratified_by_draw(spark, folder):
    reviews = text_reviews(spark, folder).select("review_id", "stars")
    train, test = op.stratified_split(reviews, "stars", {"5.0": 0.8, "3.0": 0.8, "2.0": 0.8, "1.0": 0.8}, 1)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


RATIOS_SQL = """
counts AS (SELECT stars, count(*) AS count FROM text_reviews WHERE stars IS NOT NULL GROUP BY stars),
ratios AS (SELECT stars, count, (SELECT min(count) FROM counts)::DOUBLE / count AS count_ratio FROM counts)"""


@query(with_text(f", {RATIOS_SQL} SELECT stars, count, round(count_ratio, 6) AS count_ratio FROM ratios"))
def class_ratios(spark, folder):
    return op.class_ratios(text_reviews(spark, folder), "stars").withColumn("count_ratio", F.round("count_ratio", 6))


@query(with_text(f"""
, {RATIOS_SQL} SELECT r.* FROM text_reviews r JOIN ratios q ON q.stars = r.stars
WHERE {bucket_sql('review_id', 1)} < q.count_ratio * {WIDTH}"""))
def balanced_classes(spark, folder):
    return op.balance(text_reviews(spark, folder), "stars", 1, "review_id")


@query(f"SELECT 'a' AS batch, * FROM ({sample_sql(100)}) UNION ALL SELECT 'b', * FROM ({sample_sql(42)}) UNION ALL "
       f"SELECT 'b', * FROM ({sample_sql(100)}) WHERE {bucket_sql('doc_id', 7)} < 0.5::DOUBLE * {WIDTH}")
def overlapping_batches(spark, folder):
    first, second = op.overlapping_batches(table(spark, folder, "documents"), N_ROWS, "doc_id")
    return first.select(F.lit("a").alias("batch"), "*").union(second.select(F.lit("b"), "*"))


def _share_sql(seed):
    return f"{bucket_sql('review_id', seed)} < {N_ROWS}::DOUBLE / (SELECT count(*) FROM text_reviews) * {WIDTH}"


@query(with_text(f" SELECT * FROM text_reviews WHERE {_share_sql(100)} OR {_share_sql(42)}"))
def demo_batches(spark, folder):
    """Two overlapping batches, written as text and read back; the first makes the table, the second is merged into it."""
    name = new_name("demo")
    run_demo(spark, text_reviews(spark, folder), N_ROWS, scratch_path(spark, "demo"), name)
    return taken(spark, name)
