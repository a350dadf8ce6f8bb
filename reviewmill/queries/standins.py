"""Reviews and businesses read off the given tables, once for Spark and once as SQL.

* ``text_reviews``: documents with their labels. Stars from quality and toxicity, the source is the business.
* ``text_business``: one business per nation; its region is its category.
* ``sales_reviews`` and ``sales_business``: line items and parts, for joins at volume.
"""

import uuid

from pyspark.sql import functions as F

from ..sources import key_of, location, read_rows, read_table


def table(spark, folder, name):
    return read_table(spark, f"{folder}/{name}.parquet")


def documents(spark, folder):
    return table(spark, folder, "documents")


def new_name(prefix):
    """A name for a catalog table that no other run uses."""
    return f"{prefix}_{uuid.uuid4().hex}"


def taken(spark, name):
    """The rows of a catalog table, which is then dropped. Its files stay, so the result can still be read."""
    rows = read_rows(spark, name)
    if key_of(spark, name):
        # The parts of a keyed table are listed in the catalog, so from here on they are read from its folder.
        rows = spark.read.schema(rows.schema).parquet(location(spark, name)).select(rows.columns)
    rows.schema
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows


def text_reviews(spark, folder):
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    stars = (
        F.when(good & ~toxic, "5.0").when(good & toxic, "3.0").when(~good & ~toxic, "2.0").when(~good & toxic, "1.0")
    )
    # Merged at every size, not broadcast on small tables only: the texts then move in proportion to the input.
    return docs.join(labels.hint("merge"), "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("lang").alias("user_id"),
        F.col("source").alias("business_id"),
        stars.alias("stars"),
        F.col("n_chars").cast("int").alias("useful"),
        F.col("quality").cast("int").alias("funny"),
        F.col("toxic").cast("int").alias("cool"),
        "text",
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string").alias("date"),
    )


def text_business(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("business_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("categories"),
    )


def sales_reviews(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        F.concat((F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("string"), F.lit(".0")).alias("stars"),
        F.col("l_linenumber").alias("useful"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
        F.col("l_shipdate").cast("date").cast("string").alias("date"),
    )


def sales_business(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("city"),
        F.col("p_type").alias("categories"), F.col("p_retailprice").alias("stars"), F.col("p_size").alias("review_count"),
    )


# The category that plays the part of "Restaurants".
TEXT_CATEGORY, SALES_CATEGORY = "ASIA", "PROMO"

TEXT_REVIEWS_SQL = """
text_reviews AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_id, lang AS user_id, source AS business_id,
         CASE WHEN quality = 1 AND toxic <> 1 THEN '5.0' WHEN quality = 1 AND toxic = 1 THEN '3.0'
              WHEN quality <> 1 AND toxic <> 1 THEN '2.0' WHEN quality <> 1 AND toxic = 1 THEN '1.0' END AS stars,
         CAST(n_chars AS INTEGER) AS useful, CAST(quality AS INTEGER) AS funny, CAST(toxic AS INTEGER) AS cool, text,
         CAST(DATE '2020-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS VARCHAR) AS date
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

TEXT_BUSINESS_SQL = """
text_business AS (
  SELECT 'src' || n_nationkey AS business_id, n_name AS name, r_name AS categories
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

SALES_REVIEWS_SQL = """
sales_reviews AS (
  SELECT l_orderkey AS review_id, l_suppkey AS user_id, l_partkey AS business_id,
         CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS VARCHAR) || '.0' AS stars, l_linenumber AS useful,
         l_returnflag || l_linestatus AS text, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date
  FROM lineitem
)"""

SALES_BUSINESS_SQL = """
sales_business AS (
  SELECT p_partkey AS business_id, p_name AS name, p_brand AS city, p_type AS categories,
         p_retailprice AS stars, p_size AS review_count
  FROM part
)"""


def with_text(sql):
    return f"WITH {TEXT_REVIEWS_SQL}, {TEXT_BUSINESS_SQL} {sql}"


def with_sales(sql):
    return f"WITH {SALES_REVIEWS_SQL}, {SALES_BUSINESS_SQL} {sql}"


# Words of a text, as the sentiment operators and as the classifier see them.
TOKENS_SQL = r"list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')"
NORMAL_SQL = (
    rf"list_filter(list_transform({TOKENS_SQL}, lambda x: regexp_replace(x, '[^\p{{L}}]', '', 'g')), lambda x: x <> '')"
)
