"""Projections, filters, expressions, joins, sorting and set operations."""

from pyspark.sql import functions as F

from .. import operators as op
from .registry import query
from .standins import (
    SALES_CATEGORY, TEXT_CATEGORY, sales_business, sales_reviews, table, text_business, text_reviews,
    with_sales, with_text,
)


@query("SELECT doc_id, text FROM documents")
def project_sql(spark, folder):
    table(spark, folder, "documents").createOrReplaceTempView("projected_documents")
    return spark.sql("SELECT doc_id, text FROM projected_documents")


@query("SELECT l_orderkey AS id, l_partkey AS part, l_extendedprice * l_discount AS rebate FROM lineitem")
def project_columns(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("rebate", F.col("l_extendedprice") * F.col("l_discount"))
    return lines.select("l_orderkey", "l_partkey", "rebate").toDF("id", "part", "rebate")


@query(with_sales(f"SELECT * FROM sales_business WHERE contains(categories, '{SALES_CATEGORY}')"))
def filter_category(spark, folder):
    return op.in_category(sales_business(spark, folder), SALES_CATEGORY)


@query(with_text("SELECT * FROM text_reviews WHERE stars IS NULL OR business_id IS NULL"))
def filter_broken(spark, folder):
    return op.broken_rows(text_reviews(spark, folder), ["stars", "business_id"])


@query(with_sales("SELECT review_id, stars FROM sales_reviews WHERE stars <> '3.0'"))
def filter_not_equal(spark, folder):
    return sales_reviews(spark, folder).select("review_id", "stars").filter(F.col("stars") != "3.0")


@query(with_sales("SELECT review_id, useful, stars FROM sales_reviews WHERE stars IN ('5.0', '4.0')"))
def filter_in_list(spark, folder):
    return sales_reviews(spark, folder).select("review_id", "useful", "stars").filter(F.col("stars").isin("5.0", "4.0"))


@query("SELECT page_id, url FROM pages WHERE contains(html, 'https') AND NOT contains(url, 'https')")
def filter_substring(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.where(F.col("html").contains("https") & ~F.col("url").contains("https")).select("page_id", "url")


@query(r"""
SELECT page_id, regexp_replace(url, 'http[s]?:\S+|www\.[^\s]*', '', 'g') AS url,
       regexp_replace(html, 'http[s]?:\S+|www\.[^\s]*', '', 'g') AS html
FROM pages""")
def strip_links(spark, folder):
    return op.strip_links(op.strip_links(table(spark, folder, "pages"), "url"), "html")


@query(with_text("SELECT review_id, TRY_CAST(stars AS DOUBLE) AS stars, TRY_CAST(text AS DOUBLE) AS text FROM text_reviews"))
def cast_to_double(spark, folder):
    reviews = text_reviews(spark, folder).select("review_id", "stars", "text")
    return op.stars_to_double(op.stars_to_double(reviews), "text")


@query("""
SELECT event_id, CAST(CASE WHEN event_type IN ('click', 'view') AND value >= 50 THEN 1
                      WHEN event_type = 'error' OR value < 1 THEN -1 ELSE 0 END AS INTEGER) AS mark,
       round(value / 100, 6) AS share
FROM events""")
def case_expression(spark, folder):
    kind, value = F.col("event_type"), F.col("value")
    mark = F.when(kind.isin("click", "view") & (value >= 50), 1).when((kind == "error") | (value < 1), -1).otherwise(0)
    return table(spark, folder, "events").select("event_id", mark.alias("mark"), F.round(value / F.lit(100), 6).alias("share"))


JOINED = "r.review_id, b.business_id, r.text, r.date, b.categories, r.stars"


@query(with_sales(f"SELECT {JOINED} FROM sales_reviews r LEFT JOIN sales_business b ON b.business_id = r.business_id"))
def join_left(spark, folder):
    return op.attach_business(sales_reviews(spark, folder), sales_business(spark, folder))


@query("""
SELECT d.doc_id AS review_id, l.doc_id AS business_id, d.text, d.lang AS date, CAST(l.quality AS VARCHAR) AS categories, d.source AS stars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_left_with_unmatched(spark, folder):
    reviews = table(spark, folder, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("doc_id").alias("business_id"), "text",
        F.col("lang").alias("date"), F.col("source").alias("stars"),
    )
    business = table(spark, folder, "labels").select(
        F.col("doc_id").alias("business_id"), F.col("quality").cast("string").alias("categories"),
    )
    return op.attach_business(reviews, business)


CATEGORY_JOIN_SQL = with_sales(f"""
SELECT {JOINED} FROM sales_reviews r LEFT JOIN sales_business b ON b.business_id = r.business_id
WHERE contains(b.categories, '{SALES_CATEGORY}')""")


@query(CATEGORY_JOIN_SQL)
def join_then_filter(spark, folder):
    return op.category_reviews(sales_reviews(spark, folder), sales_business(spark, folder), SALES_CATEGORY)


@query(CATEGORY_JOIN_SQL)
def filter_then_join(spark, folder):
    return op.category_reviews(sales_reviews(spark, folder), sales_business(spark, folder), SALES_CATEGORY, filter_first=True)


@query(with_sales(f"""
SELECT {JOINED} FROM sales_reviews r
LEFT JOIN (SELECT * FROM sales_business WHERE contains(categories, '{SALES_CATEGORY}')) b ON b.business_id = r.business_id"""))
def filter_then_left_join(spark, folder):
    return op.attach_business(
        sales_reviews(spark, folder), op.in_category(sales_business(spark, folder), SALES_CATEGORY)
    )


@query(with_sales(f"""
SELECT * FROM sales_reviews r
WHERE EXISTS (SELECT 1 FROM sales_business b WHERE b.business_id = r.business_id AND contains(categories, '{SALES_CATEGORY}'))"""))
def join_semi(spark, folder):
    return op.reviews_in_category(sales_reviews(spark, folder), sales_business(spark, folder), SALES_CATEGORY)


@query(with_text(f"""
SELECT {JOINED} FROM text_reviews r JOIN text_business b ON b.business_id = r.business_id
WHERE contains(b.categories, '{TEXT_CATEGORY}')"""))
def join_texts(spark, folder):
    return op.category_reviews(text_reviews(spark, folder), text_business(spark, folder), TEXT_CATEGORY)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_ascending(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return orders.orderBy("o_totalprice", "o_orderkey")


@query("SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 20")
def preview_rows(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return op.preview(events, [F.col("value").desc(), "event_id"])


@query("SELECT doc_id AS id, text FROM documents UNION ALL SELECT page_id, html FROM pages")
def union_all(spark, folder):
    documents, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    return documents.select(F.col("doc_id").alias("id"), "text").union(pages.select("page_id", "html"))


@query("SELECT l_partkey AS id FROM lineitem EXCEPT SELECT l_suppkey FROM lineitem")
def set_difference(spark, folder):
    lines = table(spark, folder, "lineitem")
    return op.set_difference(lines.select(F.col("l_partkey").alias("id")), lines.select("l_suppkey"))
