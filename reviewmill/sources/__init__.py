from .delimited import convert, malformed_counts, read_delimited, read_delimited_checked, write_delimited
from .tables import read_json_records, read_lines, read_table, write_parquet
from .catalog import (
    adopt_parquet, append_table, bucket_of_key, create_bucketed_table, create_keyed_table, drop_table, key_of, location, overwrite_table, read_rows, replace_buckets, table_exists,
)
