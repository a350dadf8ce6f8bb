"""Pipe-delimited text tables without a header.

Files stay splittable: one record is one line, never a quoted field over many lines. Texts with line
ends are therefore encoded (``one_line``) when they are written and decoded when they are read.
"""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ..functions.text import decode_lines, encode_lines
from .tables import write_parquet

BAD_ROW, BAD_KIND = "bad_row", "bad_kind"

_DIALECT = {"header": False, "quote": '"', "escape": '"'}

# Encoded texts never hold this word. Given as the word for NULL, it tells an empty field from a quoted empty one.
_NO_TEXT = "\\N"


def _map_strings(df, schema, change):
    strings = {field.name for field in schema if isinstance(field.dataType, StringType)}
    return df.select([change(F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def _reading(sep, null_text, one_line):
    options = dict(_DIALECT, sep=sep, mode="PERMISSIVE")
    if null_text is None and one_line:
        null_text = _NO_TEXT
    if null_text is not None:
        options["nullValue"] = null_text
    return options


def read_delimited(spark, path, schema, sep="|", null_text=None, one_line=True):
    """Scan with a fixed schema. Bad numbers become NULL, short rows are filled with NULL.

    An empty field is NULL, and so is a quoted empty one unless ``one_line`` says that the file holds texts
    as they were. ``null_text`` is one more word for NULL (the JSON ingest writes ``null``).
    """
    df = spark.read.schema(schema).options(**_reading(sep, null_text, one_line)).csv(path)
    return _map_strings(df, df.schema, decode_lines) if one_line else df


def _fields_of(line, sep):
    """Number of fields of a raw line: separators in quotes do not count."""
    outside = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1


def read_delimited_checked(spark, path, schema, sep="|", null_text=None, one_line=True):
    """``read_delimited`` with two more columns: ``bad_row``, the raw line if the reader found it malformed, and ``bad_kind``: ``short`` or ``long`` by its number
    of fields, ``bad value`` if a typed column is then NULL, else ``other``.

    The reader counts the fields of whole lines here, but checks the values of those columns only that a query uses. The kind uses all that can hold a bad
    value, so a row has the same one in any query; where all columns are texts, a query must use one of them beside it.
    """
    declared = DataType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = StructType([*declared, StructField(BAD_ROW, StringType())])
    df = spark.read.schema(fields).options(**_reading(sep, null_text, one_line), columnNameOfCorruptRecord=BAD_ROW, columnPruning=False).csv(path)
    found = _fields_of(F.col(BAD_ROW), sep)
    unread = reduce(or_, [F.col(f.name).isNull() for f in declared if not isinstance(f.dataType, StringType)], F.lit(False))
    kind = F.when(found < len(declared), "short").when(found > len(declared), "long").when(unread, "bad value").otherwise("other")
    df = df.withColumn(BAD_KIND, F.when(F.col(BAD_ROW).isNotNull(), kind))
    return _map_strings(df, declared, decode_lines) if one_line else df


def malformed_counts(df):
    """Rows per kind of ``read_delimited_checked``: good, then by the name of the kind."""
    names = [c for c in df.columns if c not in (BAD_ROW, BAD_KIND)]
    # The reader refuses a scan of the raw line alone.
    kinds = df.select(F.coalesce(BAD_KIND, F.lit("good")).alias("kind"), F.col(names[0]).alias("first"))
    return kinds.groupBy("kind").agg(F.count("*").alias("rows"), F.count("first").alias("with_first_field"))


def write_delimited(df, path, sep="|", mode="overwrite", one_line=True):
    """Write text as it is: blanks at both ends stay, NULL is an empty field, '' a quoted one."""
    if one_line:
        df = _map_strings(df, df.schema, encode_lines)
    options = dict(_DIALECT, sep=sep, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.write.mode(mode).options(**options).csv(path)


def convert(spark, src, dst, schema, sep="|", mode="errorifexists", **reading):
    """Delimited to Parquet: one narrow job, no shuffle."""
    write_parquet(read_delimited(spark, src, schema, sep, **reading), dst, mode)
