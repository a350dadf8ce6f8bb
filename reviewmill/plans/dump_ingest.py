"""JSON-lines dump -> delimited text -> Parquet table with a declared schema."""

from ..operators.ingest import records_to_lines
from ..operators.quality import quality_report
from ..sources.delimited import convert
from ..sources.tables import read_json_records, read_table


def ingest_dump(spark, src, text_path, table_path, schema, required):
    """Two narrow jobs and a report: total rows, broken rows, NULLs per required column.

    A line that is no JSON becomes a marker in the text file and a broken row in the table.
    """
    records = read_json_records(spark, src, schema.names)
    records_to_lines(records, schema.names, null_text=None).write.mode("overwrite").text(text_path)
    convert(spark, text_path, table_path, schema, mode="overwrite", one_line=True)
    return quality_report(read_table(spark, table_path), required)
