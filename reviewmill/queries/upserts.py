"""Upserts of pages into labelled documents: some match, some are new, some rows stay."""

from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..plans.category_sentiment import SCORED_COLUMNS
from .registry import query
from .standins import new_name, table, taken

SCORED = ["review_id", "business_id", "text", "date", "categories", "stars", "final_sentiment", "right_prediction"]


def scored_target(spark, folder):
    """Documents with a label, in the columns of scored reviews."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("business_id"), "text", F.lit("2020-01-01").alias("date"),
        F.col("lang").alias("categories"), F.concat(F.col("quality").cast("string"), F.lit(".0")).alias("stars"),
        F.array(F.when(F.col("toxic") == 1, "negative").otherwise("positive")).alias("final_sentiment"),
        F.col("quality").cast("int").alias("right_prediction"),
    )


def scored_updates(spark, folder):
    """Pages, in the same columns."""
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("review_id"), F.col("url").alias("business_id"), F.col("html").alias("text"),
        F.lit("2021-01-01").alias("date"), F.lit("page").alias("categories"), F.lit("5.0").alias("stars"),
        F.array(F.lit("positive")).alias("final_sentiment"), F.lit(1).alias("right_prediction"),
    )


UPSERT_SQL = """
old AS (
  SELECT d.doc_id AS review_id, source AS business_id, text, '2020-01-01' AS date, lang AS categories,
         CAST(quality AS VARCHAR) || '.0' AS stars, CASE WHEN toxic = 1 THEN 'negative' ELSE 'positive' END AS final_sentiment,
         CAST(quality AS INTEGER) AS right_prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
), new AS (
  SELECT page_id AS review_id, url AS business_id, html AS text, '2021-01-01' AS date, 'page' AS categories,
         '5.0' AS stars, 'positive' AS final_sentiment, CAST(1 AS INTEGER) AS right_prediction
  FROM pages
)"""


def merge_sql(columns):
    chosen = [
        f"CASE WHEN new.review_id IS NOT NULL THEN new.{c} ELSE old.{c} END AS {c}" if c in columns else f"old.{c} AS {c}"
        for c in SCORED
    ]
    return f"WITH {UPSERT_SQL} SELECT {', '.join(chosen)} FROM old FULL OUTER JOIN new ON old.review_id = new.review_id"


def _shown(df):
    """The label array as text, to be compared with SQL."""
    return df.withColumn("final_sentiment", F.array_join("final_sentiment", ","))


def _merged(spark, folder, columns):
    target, updates = scored_target(spark, folder), scored_updates(spark, folder)
    return _shown(op.upsert(target, updates, "review_id", columns, columns))


@query(merge_sql(SCORED))
def upsert_all_columns(spark, folder):
    return _merged(spark, folder, None)


@query(merge_sql(SCORED_COLUMNS))
def upsert_leaves_stars(spark, folder):
    return _merged(spark, folder, SCORED_COLUMNS)


WITHOUT_FLAG = [c for c in SCORED_COLUMNS if c != "right_prediction"]


@query(merge_sql(WITHOUT_FLAG))
def upsert_leaves_stars_and_flag(spark, folder):
    return _merged(spark, folder, WITHOUT_FLAG)


@query(merge_sql(SCORED_COLUMNS))
def upsert_by_path(spark, folder):
    """The first batch creates the table, the second is merged into it."""
    name = new_name("upsert")
    for batch in (scored_target(spark, folder), scored_updates(spark, folder)):
        op.upsert_table(spark, name, batch, "review_id", SCORED_COLUMNS, SCORED_COLUMNS)
    return _shown(taken(spark, name))


def _parted(spark, folder):
    """Reviews of the labelled documents in a table of 64 buckets, then a batch of pages: those of the touched buckets are merged, no other is read."""
    name = new_name("upsert")
    op.upsert_table(spark, name, scored_target(spark, folder), "review_id", buckets=64)
    op.upsert_table(spark, name, scored_updates(spark, folder).where("review_id % 40 = 0"), "review_id", SCORED_COLUMNS, SCORED_COLUMNS)
    return name


@query(merge_sql(SCORED_COLUMNS).replace("FROM pages", "FROM pages WHERE page_id % 40 = 0"))
def upsert_by_bucket(spark, folder):
    return _shown(taken(spark, _parted(spark, folder)))


@query(f"""
WITH {UPSERT_SQL.replace("FROM pages", "FROM pages WHERE page_id % 40 = 0")}
SELECT (SELECT count(*) FROM old) + (SELECT count(*) FROM new WHERE review_id NOT IN (SELECT review_id FROM old)) AS rows,
       (SELECT count(*) FROM new WHERE review_id IN (SELECT review_id FROM old)) AS updated, true AS others_untouched""")
def upsert_touches_its_buckets(spark, folder):
    """Rows after the merge, rows that it changed, and whether every bucket without a key of the batch still has the file that it was created with."""
    name = new_name("upsert")
    op.upsert_table(spark, name, scored_target(spark, folder), "review_id", buckets=64)
    batch = scored_updates(spark, folder).where("review_id % 40 = 0")
    place = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    before = {tuple(r) for r in spark.read.table(name).select("key_bucket", *place).distinct().collect()}  # a line per file
    op.upsert_table(spark, name, batch, "review_id", SCORED_COLUMNS, SCORED_COLUMNS)
    after = {tuple(r) for r in spark.read.table(name).select("key_bucket", *place).distinct().collect()}
    touched = {r[0] for r in batch.select(src.bucket_of_key(F.col("review_id"), 64)).distinct().collect()}
    same = {r for r in before if r[0] not in touched} == {r for r in after if r[0] not in touched}
    rows = taken(spark, name)
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.col("date") == "2021-01-01").alias("updated"), F.lit(same).alias("others_untouched")).withColumn(
        "updated", F.col("updated") - (F.col("rows") - scored_target(spark, folder).count()))


@query("""
SELECT coalesce(u.c_custkey, e.user_id) AS user_id,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_mktsegment ELSE e.event_type END AS event_type, e.n AS n
FROM (SELECT user_id, max(event_type) AS event_type, count(*) AS n FROM events GROUP BY user_id) e
FULL OUTER JOIN customer u ON u.c_custkey = e.user_id""")
def upsert_customers(spark, folder):
    """Segments of the customers merged into the users seen in the events."""
    users = table(spark, folder, "events").groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.count("*").alias("n"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"))
    return op.upsert(users, customers, "user_id", ["user_id", "event_type"], ["user_id", "event_type"])
