"""Scans and sinks. Each query writes a given table to the shared scratch folder and reads it back."""

from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..schemas import BUSINESS_SCHEMA, REVIEW_SCHEMA
from ..session import scratch_path
from .registry import query
from .standins import NORMAL_SQL, new_name, table, taken, text_reviews, with_text

ALL_REVIEWS = with_text("SELECT * FROM text_reviews")


@query(ALL_REVIEWS)
def scan_delimited(spark, folder):
    path = scratch_path(spark, "scan_delimited")
    src.write_delimited(text_reviews(spark, folder), path, one_line=True)
    return src.read_delimited(spark, path, REVIEW_SCHEMA, one_line=True)


# Every seventh review is cut short, another has a field too many, another a word for a number.
MALFORMED_SQL = with_text("""
, lines AS (SELECT *, CASE CAST(review_id AS BIGINT) % 7 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'bad value' END AS bad_kind FROM text_reviews)
, malformed AS (
  SELECT review_id, user_id, business_id, CASE WHEN bad_kind = 'short' THEN NULL ELSE stars END AS stars,
         CASE WHEN bad_kind IN ('short', 'bad value') THEN NULL ELSE useful END AS useful, CASE WHEN bad_kind = 'short' THEN NULL ELSE date END AS date, bad_kind FROM lines)""")


def _malformed_lines(spark, folder):
    """Rendered reviews without their texts, some of them broken: the folder of the lines."""
    path = scratch_path(spark, "malformed")
    place = F.col("review_id").cast("long") % 7

    def field(column):
        return F.concat(F.lit('"'), column, F.lit('"'))

    named = [field(F.col(c)) for c in ("review_id", "user_id", "business_id")]
    useful = F.when(place == 3, "many").otherwise(F.col("useful").cast("string"))
    rest = [F.coalesce("stars", F.lit("")), useful, F.lit("0"), F.lit(""), F.lit('"a | b"'), F.col("date")]
    whole = F.concat_ws("|", *named, *rest)
    line = F.when(place == 1, F.concat_ws("|", *named)).when(place == 2, F.concat_ws("|", whole, F.lit("more"))).otherwise(whole)
    text_reviews(spark, folder).select(line.alias("value")).write.text(path)
    return path


@query(MALFORMED_SQL + " SELECT * FROM malformed")
def scan_malformed(spark, folder):
    """Typed rows of a file with broken lines, each with the kind of its fault."""
    rows = src.read_delimited_checked(spark, _malformed_lines(spark, folder), REVIEW_SCHEMA)
    return rows.select("review_id", "user_id", "business_id", "stars", "useful", "date", "bad_kind")


@query(MALFORMED_SQL + " SELECT coalesce(bad_kind, 'good') AS kind, count(*) AS rows, count(review_id) AS with_first_field FROM malformed GROUP BY ALL")
def malformed_line_counts(spark, folder):
    return src.malformed_counts(src.read_delimited_checked(spark, _malformed_lines(spark, folder), REVIEW_SCHEMA))


BUSINESS_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS business_id, p_name AS name, p_brand || ', ' || p_type AS address, p_brand AS city,
       p_type AS state, CAST(p_size AS VARCHAR) AS postal_code, p_retailprice / 10 AS latitude, -p_retailprice / 20 AS longitude,
       p_retailprice AS stars, p_size AS review_count, CAST(p_size % 2 AS INTEGER) AS is_open,
       '{"size":' || p_size || ',"brand":"' || p_brand || '"}' AS attributes,
       CASE WHEN p_size > 25 THEN p_type || ', ' || p_brand END AS categories, CAST(NULL AS VARCHAR) AS hours
FROM part"""


def part_business(spark, folder):
    brand, kind, size, price = F.col("p_brand"), F.col("p_type"), F.col("p_size"), F.col("p_retailprice")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("business_id"), F.col("p_name").alias("name"),
        F.concat_ws(", ", brand, kind).alias("address"), brand.alias("city"), kind.alias("state"),
        size.cast("string").alias("postal_code"), (price / 10).alias("latitude"), (-price / 20).alias("longitude"),
        price.alias("stars"), size.alias("review_count"), (size % 2).cast("int").alias("is_open"),
        F.to_json(F.struct(size.alias("size"), brand.alias("brand"))).alias("attributes"),
        F.when(size > 25, F.concat_ws(", ", kind, brand)).alias("categories"), F.lit(None).cast("string").alias("hours"),
    )


@query(BUSINESS_SQL)
def scan_delimited_business(spark, folder):
    path = scratch_path(spark, "scan_delimited_business")
    src.write_delimited(part_business(spark, folder), path)
    return src.read_delimited(spark, path, BUSINESS_SCHEMA)


@query("SELECT * FROM documents")
def scan_parquet(spark, folder):
    return src.read_table(spark, f"{folder}/documents.parquet")


@query("SELECT * FROM orders")
def scan_parquet_by_format(spark, folder):
    return spark.read.format("parquet").load(f"{folder}/orders.parquet")


@query(ALL_REVIEWS)
def scan_mergeable_table(spark, folder):
    name = new_name("reviews")
    src.overwrite_table(text_reviews(spark, folder), name)
    return taken(spark, name)


@query(ALL_REVIEWS)
def scan_catalog_table(spark, folder):
    """Save as a catalog table, read it by name, drop it. The files stay, so the result can still be read."""
    name = new_name("reviews")
    reviews = text_reviews(spark, folder)
    reviews.write.format("parquet").option("path", scratch_path(spark, name)).saveAsTable(name)
    reviews.write.mode("overwrite").option("path", scratch_path(spark, name)).saveAsTable(name)
    return taken(spark, name)


@query("""
SELECT r.id FROM (SELECT unnest(range((SELECT count(*) FROM documents))) AS id) r
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.id)""")
def scan_range(spark, folder):
    """Row numbers of the documents that have no label."""
    ids = spark.range(0, table(spark, folder, "documents").count())
    return ids.join(table(spark, folder, "labels"), F.col("id") == F.col("doc_id"), "left_anti")


PHRASES = ["The rest of the bread and the tea", "Por favor, que la en!!!"]


@query(f"""
SELECT p.text, count(*) AS texts FROM (SELECT DISTINCT text, unnest({NORMAL_SQL}) AS word FROM (VALUES {", ".join(f"('{p}')" for p in PHRASES)}) v(text)) p
JOIN (SELECT unnest(list_distinct({NORMAL_SQL})) AS word FROM documents) d ON d.word = p.word
GROUP BY p.text""")
def scan_rows(spark, folder):
    """Phrases held in memory: how often one of their words occurs in a document."""
    phrases = spark.createDataFrame([[phrase] for phrase in PHRASES]).toDF("text")
    words = op.normalize(op.tokenize(phrases)).select("text", F.explode(F.array_distinct("normal")).alias("word"))
    documents = op.normalize(op.tokenize(table(spark, folder, "documents")))
    found = documents.select(F.explode(F.array_distinct("normal")).alias("word"))
    # The phrases are constants of this query, so their words can go to every task.
    return found.join(F.broadcast(words), "word").groupBy("text").agg(F.count("*").alias("texts"))


@query("SELECT event_id || ' ' || event_type || ' ' || props AS value FROM events")
def scan_lines(spark, folder):
    path = scratch_path(spark, "scan_lines")
    events = table(spark, folder, "events")
    events.select(F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", "props").alias("value")).write.text(path)
    return src.read_lines(spark, path)


@query("SELECT doc_id, text FROM documents")
def sink_parquet(spark, folder):
    path = scratch_path(spark, "sink_parquet")
    documents = table(spark, folder, "documents")
    src.write_parquet(documents.select("doc_id", "lang"), path)
    src.write_parquet(documents.select("doc_id", "text"), path, mode="overwrite")
    return src.read_table(spark, path)


@query(ALL_REVIEWS)
def sink_table_overwrite(spark, folder):
    name, reviews = new_name("reviews"), text_reviews(spark, folder)
    src.overwrite_table(op.broken_rows(reviews, ["stars"]), name)
    src.overwrite_table(reviews, name)
    return taken(spark, name)


@query("SELECT doc_id, CAST(NULL AS VARCHAR) AS text, quality, toxic FROM labels")
def sink_table_new_columns(spark, folder):
    name = new_name("documents")
    src.overwrite_table(table(spark, folder, "documents").select("doc_id", "text"), name)
    src.overwrite_table(table(spark, folder, "labels"), name, new_columns=True)
    return taken(spark, name)


@query("SELECT * FROM documents")
def sink_adopt_parquet(spark, folder):
    name = new_name("documents")
    src.adopt_parquet(spark, f"{folder}/documents.parquet", name)
    return taken(spark, name)
