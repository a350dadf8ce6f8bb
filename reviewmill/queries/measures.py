"""Aggregates, profiles and reuse."""

from pyspark.sql import functions as F

from .. import operators as op
from .registry import query
from .standins import sales_reviews, table, text_reviews, with_sales, with_text


@query("SELECT CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS n FROM lineitem")
def sum_and_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.sum("l_linenumber").alias("total"), F.count("*").alias("n"))


DISTRIBUTION_SQL = "SELECT stars, count(*) AS count FROM sales_reviews GROUP BY stars"


@query(with_sales(DISTRIBUTION_SQL + " ORDER BY stars"))
def star_distribution(spark, folder):
    return op.distribution(sales_reviews(spark, folder), "stars")


@query(with_sales(f"SELECT min(count) AS smallest FROM ({DISTRIBUTION_SQL})"))
def smallest_class(spark, folder):
    return op.distribution(sales_reviews(spark, folder), "stars").agg(F.min("count").alias("smallest"))


@query(with_sales("SELECT DISTINCT stars, CAST(0.8 AS DOUBLE) AS fraction FROM sales_reviews"))
def distinct_values(spark, folder):
    return sales_reviews(spark, folder).select("stars").distinct().withColumn("fraction", F.lit(0.8))


def _profile_sql(table_name, numbers, strings):
    lines = []
    for c in [*numbers, *strings]:
        number = c if c in numbers else f"TRY_CAST({c} AS DOUBLE)"
        lines.append(f"""
        SELECT '{c}' AS column, count({c}) AS count, round(avg({number}), 4) AS mean, round(stddev_samp({number}), 4) AS stddev,
               CAST(min({c}) AS VARCHAR) AS min, CAST(quantile_disc({number}, 0.25) AS DOUBLE) AS p25,
               CAST(quantile_disc({number}, 0.5) AS DOUBLE) AS p50, CAST(quantile_disc({number}, 0.75) AS DOUBLE) AS p75,
               CAST(max({c}) AS VARCHAR) AS max
        FROM {table_name}""")
    return " UNION ALL ".join(lines)


@query(_profile_sql("documents", ["doc_id", "n_chars"], ["text", "lang", "source"]))
def profile_documents(spark, folder):
    profile = op.profile(table(spark, folder, "documents"))
    return profile.withColumn("mean", F.round("mean", 4)).withColumn("stddev", F.round("stddev", 4))


@query(with_text("""
SELECT count(*) AS total, count(*) FILTER (review_id IS NULL OR stars IS NULL) AS broken,
       count(*) FILTER (review_id IS NULL) AS null_review_id, count(*) FILTER (stars IS NULL) AS null_stars
FROM text_reviews"""))
def quality_counts(spark, folder):
    return op.quality_report(text_reviews(spark, folder), ["review_id", "stars"])


@query("""
SELECT 'doc_id' AS column, 'bigint' AS type, count(doc_id) AS filled FROM documents
UNION ALL SELECT 'text', 'string', count(text) FROM documents
UNION ALL SELECT 'lang', 'string', count(lang) FROM documents
UNION ALL SELECT 'source', 'string', count(source) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM documents""")
def schema_listing(spark, folder):
    documents = table(spark, folder, "documents")
    filled = documents.agg(*[F.count(c).alias(c) for c in documents.columns])
    return filled.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("filled"))
        for f in documents.schema
    ])))


@query(with_sales("""
SELECT stars, count(*) AS count, (SELECT count(*) FROM sales_reviews WHERE stars IN ('5.0', '4.0')) AS high FROM sales_reviews
GROUP BY stars"""))
def reuse_for_two_actions(spark, folder):
    reviews = sales_reviews(spark, folder).select("stars")
    with op.reused(reviews) as kept:
        high = kept.where(F.col("stars").isin("5.0", "4.0")).count()
        rows = op.distribution(kept, "stars").withColumn("high", F.lit(high).cast("bigint")).collect()
    return spark.createDataFrame(rows, "stars string, count bigint, high bigint")
