"""JSON lines to delimited text or key-value rows: narrow jobs without a shuffle.

Values follow JSON: escapes are undone, nested objects stay as text, a last null is kept. The text
formats write one record per line, so line ends inside a value are encoded.
"""

from pyspark.sql import functions as F

from ..functions.text import clean_line, encode_lines, quoted
from ..schemas import BUSINESS_FIELDS, REVIEW_FIELDS
from ..sources.tables import BAD_RECORD


def json_values(df, fields=None, col="value"):
    """Top-level values of JSON lines held in a column.

    With ``fields``: one text column per name. Without: one array ``values`` in the order of the line.
    Numbers and nested objects come out in normal form; ``sources.read_json_records``
    keeps them letter by letter.
    """
    if fields is None:
        values = F.from_json(col, "map<string,string>", {"allowSingleQuotes": "false"})
        return df.select(F.map_values(values).alias("values"))
    schema = ", ".join(f"`{name}` string" for name in fields)
    parsed = F.from_json(col, schema, {"allowSingleQuotes": "false"})
    return df.select(parsed.alias("_parsed")).select("_parsed.*")


def split_bad_records(df, fields, col="value"):
    """(good, bad): parsed rows of the valid lines, and a marker for each other line.

    The marker is 8 characters from where the id stands in the cleaned line, then ``++++failed``.
    """
    schema = ", ".join(f"`{name}` string" for name in [*fields, BAD_RECORD])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, "allowSingleQuotes": "false"}
    parsed = df.select(F.col(col).alias("_line"), F.from_json(col, schema, options).alias("_parsed"))
    failed = F.col(f"_parsed.{BAD_RECORD}").isNotNull()
    good = parsed.where(~failed).select([F.col(f"_parsed.{name}") for name in fields])
    bad = parsed.where(failed).select(failure_marker(F.col("_line")).alias("marker"))
    return good, bad


def failure_marker(line):
    return F.concat(F.substring(clean_line(line), 15, 8), F.lit("++++failed"))


def to_delimited(df, cols=None, sep="|", null_text="null"):
    """One text column ``value``: every field quoted, no separator at the end."""
    fields = [quoted(encode_lines(F.col(c).cast("string")), null_text) for c in cols or df.columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def records_to_lines(records, fields, sep="|", null_text="null"):
    """Delimited line of each record, or its failure marker, in one pass over ``read_json_records``."""
    line = F.concat_ws(sep, *[quoted(encode_lines(F.col(c)), null_text) for c in fields])
    bad = F.col(BAD_RECORD)
    return records.select(F.when(bad.isNull(), line).otherwise(failure_marker(bad)).alias("value"))


def business_key_values(df, col="value"):
    """Business lines to (business_id, 14 texts). The slot before ``categories`` is always empty."""
    parsed = json_values(df, BUSINESS_FIELDS, col)
    names = BUSINESS_FIELDS[1:]
    at = names.index("categories")
    values = [F.coalesce(F.col(c), F.lit("null")) for c in names]
    values.insert(at, F.lit(""))
    return parsed.select("business_id", F.array(*values).alias("values"))


def reviews_to_lines(df, col="value"):
    """Review lines to one comma-joined line of the nine fields, unquoted."""
    parsed = json_values(df, REVIEW_FIELDS, col)
    fields = [F.coalesce(encode_lines(F.col(c)), F.lit("null")) for c in REVIEW_FIELDS]
    return parsed.select(F.concat_ws(",", *fields).alias("value"))
