"""Parquet tables, raw lines and JSON-lines records."""

from pyspark.sql.types import StringType, StructField, StructType

BAD_RECORD = "_bad_record"


def read_table(spark, path):
    return spark.read.parquet(path)


def write_parquet(df, path, mode="errorifexists"):
    df.write.mode(mode).parquet(path)


def read_lines(spark, path):
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_json_records(spark, path, fields):
    """Top-level values of each JSON line as text, plus the raw line where it is no JSON.

    The file scan keeps numbers and nested objects exactly as they are written (``from_json`` on a
    column would rewrite 1.10 as 1.1), unquotes strings, and gives NULL for null.
    """
    schema = StructType([StructField(name, StringType()) for name in [*fields, BAD_RECORD]])
    return (
        spark.read.schema(schema)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_RECORD, allowSingleQuotes=False)
        .json(path)
    )
