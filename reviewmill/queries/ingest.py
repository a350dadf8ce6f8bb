"""JSON lines, derived from the given tables, to values, delimited text and key-value rows."""

from pyspark.sql import functions as F

from .. import operators as op
from .. import sources as src
from ..functions import clean_line, extract_between
from ..plans import ingest_dump
from ..schemas import BUSINESS_FIELDS, REVIEW_FIELDS, REVIEW_SCHEMA
from ..session import scratch_path
from .registry import query
from .standins import table, text_reviews, with_text
from .tables import ALL_REVIEWS, BUSINESS_SQL, part_business

REVIEWS_AS_TEXT = with_text("""
SELECT review_id, user_id, business_id, stars, CAST(useful AS VARCHAR) AS useful, CAST(funny AS VARCHAR) AS funny,
       CAST(cool AS VARCHAR) AS cool, text, date
FROM text_reviews""")


def _json_lines(df):
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def _written(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.text(path)
    return path


def event_lines(spark, folder):
    """One JSON object per event, its properties nested; an error event is cut off before its last brace."""
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), "event_type",
        F.lit('","session":null,"props":'), "props",
    )
    end = F.when(F.col("event_type") == "error", "").otherwise("}")
    return table(spark, folder, "events").select("event_id", F.concat(line, end).alias("value"))


EVENT_LINES_SQL = """
event_lines AS (
  SELECT event_id, event_type, props, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","session":null,"props":' || props
         || CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS value
  FROM events
)"""
CLEANED = r"""replace(replace(replace(value, ':null', ':"null"'), '\n', ''), '\r', '')"""


@query(REVIEWS_AS_TEXT)
def json_records(spark, folder):
    path = _written(_json_lines(text_reviews(spark, folder)), "json_records")
    return src.read_json_records(spark, path, REVIEW_FIELDS).select(REVIEW_FIELDS)


@query(REVIEWS_AS_TEXT)
def json_values(spark, folder):
    return op.json_values(_json_lines(text_reviews(spark, folder)), REVIEW_FIELDS)


@query(f"""
WITH {EVENT_LINES_SQL}
SELECT CASE WHEN event_type <> 'error' THEN concat_ws('|', event_id, event_type, 'null', replace(props, ' ', '')) END AS line
FROM event_lines""")
def json_values_in_order(spark, folder):
    values = op.json_values(event_lines(spark, folder))
    return values.select(F.array_join("values", "|", "null").alias("line"))


@query(f"""
WITH {EVENT_LINES_SQL}
SELECT CASE WHEN json_valid(value)
            THEN '"' || event_id || '"|"' || event_type || '"|"null"|"' || replace(props, '"', '""') || '"'
            ELSE substring({CLEANED}, 15, 8) || '++++failed' END AS value
FROM event_lines""")
def json_to_delimited(spark, folder):
    fields = ["event_id", "event_type", "session", "props"]
    path = _written(event_lines(spark, folder).select("value"), "json_to_delimited")
    return op.records_to_lines(src.read_json_records(spark, path, fields), fields)


@query("SELECT '\"' || event_id || '\"|\"' || event_type || '\"|\"' || replace(props, '\"', '\"\"') || '\"' AS value FROM events")
def delimited_lines(spark, folder):
    return op.to_delimited(table(spark, folder, "events"), ["event_id", "event_type", "props"])


@query(f"WITH {EVENT_LINES_SQL} SELECT substring({CLEANED}, 15, 8) || '++++failed' AS marker FROM event_lines WHERE NOT json_valid(value)")
def bad_records(spark, folder):
    return op.split_bad_records(event_lines(spark, folder), ["event_id", "event_type"])[1]


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events WHERE event_type <> 'error'")
def good_records(spark, folder):
    return op.split_bad_records(event_lines(spark, folder), ["event_id", "event_type"])[0]


@query(f"WITH {EVENT_LINES_SQL} SELECT event_id, {CLEANED} AS line FROM event_lines")
def clean_lines(spark, folder):
    return event_lines(spark, folder).select("event_id", clean_line(F.col("value")).alias("line"))


# Lines whose names come and go: every third event has no session, every fourth names its kind last.
NAMED_SQL = """
SELECT event_id, event_type, user_id, event_id % 3 = 0 AS bare, event_id % 4 = 0 AS turned FROM events"""


@query(f"""
SELECT event_id, CASE WHEN turned THEN '' ELSE event_type || ',' END AS kind,
       CASE WHEN bare THEN NULL WHEN turned THEN user_id || ',event_type' || event_type || ',' ELSE user_id || ',' END AS session_to_end,
       CASE WHEN bare THEN NULL WHEN turned THEN user_id || ',' ELSE '' END AS session_to_kind
FROM ({NAMED_SQL})""")
def values_between_names(spark, folder):
    """Between two names of which one may be missing (NULL) or come first (empty)."""
    kind = F.concat(F.lit('"event_type":"'), "event_type", F.lit('"'))
    session = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit('"session":'), F.col("user_id").cast("string")))
    first = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    straight = F.concat_ws(",", first, kind, F.lit('"props":0'), session, F.lit('"end":1}'))
    turned = F.concat_ws(",", first, F.lit('"props":0'), session, kind, F.lit('"end":1}'))
    line = F.when(F.col("event_id") % 4 == 0, turned).otherwise(straight)
    return table(spark, folder, "events").select(
        "event_id",
        extract_between(line, '"event_type', '"props').alias("kind"),
        extract_between(line, '"session', '"end').alias("session_to_end"),
        extract_between(line, '"session', '"event_type').alias("session_to_kind"),
    )


@query(f"""
SELECT business_id, concat_ws('|', name, address, city, state, postal_code, CAST(round(latitude * 1000) AS BIGINT), CAST(round(longitude * 1000) AS BIGINT),
       CAST(round(stars * 1000) AS BIGINT), CAST(review_count AS VARCHAR), CAST(is_open AS VARCHAR),
       attributes, '', coalesce(categories, 'null'), 'null') AS line, CAST(14 AS INTEGER) AS n_values FROM ({BUSINESS_SQL})""")
def business_key_values(spark, folder):
    """The values as one line, floating-point ones in thousandths."""
    pairs = op.business_key_values(_json_lines(part_business(spark, folder)))
    names = [*BUSINESS_FIELDS[1:]]
    names.insert(names.index("categories"), "")
    shown = [
        F.round(F.col("values")[i].cast("double") * 1000).cast("bigint").cast("string") if name in ("latitude", "longitude", "stars") else F.col("values")[i]
        for i, name in enumerate(names)
    ]
    return pairs.select("business_id", F.concat_ws("|", *shown).alias("line"), F.size("values").alias("n_values"))


@query(with_text(r"""
SELECT concat_ws(',', review_id, user_id, business_id, coalesce(stars, 'null'), useful, coalesce(CAST(funny AS VARCHAR), 'null'),
       coalesce(CAST(cool AS VARCHAR), 'null'),
       replace(replace(replace(text, '\', '\s'), chr(10), '\n'), chr(13), '\r'), date) AS value
FROM text_reviews"""))
def review_lines(spark, folder):
    return op.reviews_to_lines(_json_lines(text_reviews(spark, folder)))


@query(ALL_REVIEWS)
def convert_to_parquet(spark, folder):
    text, table_path = scratch_path(spark, "convert_text"), scratch_path(spark, "convert_table")
    src.write_delimited(text_reviews(spark, folder), text, one_line=True)
    src.convert(spark, text, table_path, REVIEW_SCHEMA, one_line=True)
    return src.read_table(spark, table_path)


@query(ALL_REVIEWS)
def ingested_rows(spark, folder):
    """The table that the report is about."""
    lines, path = _written(_json_lines(text_reviews(spark, folder)), "dump"), scratch_path(spark, "dump_table")
    ingest_dump(spark, lines, scratch_path(spark, "dump_text"), path, REVIEW_SCHEMA, ["business_id"])
    return src.read_table(spark, path)


@query(with_text("""
SELECT count(*) AS total, count(*) FILTER (stars IS NULL) AS broken, CAST(0 AS BIGINT) AS null_business_id,
       count(*) FILTER (stars IS NULL) AS null_stars FROM text_reviews"""))
def ingest_report(spark, folder):
    lines = _written(_json_lines(text_reviews(spark, folder)), "dump")
    return ingest_dump(
        spark, lines, scratch_path(spark, "dump_text"), scratch_path(spark, "dump_table"), REVIEW_SCHEMA,
        ["business_id", "stars"],
    )
