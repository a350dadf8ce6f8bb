"""Catalog tables over Parquet folders: the targets of overwrites and upserts.

The folders lie in the warehouse. An overwrite writes a new folder and then points the table to it, so a job that fails leaves the old rows,
and a job may read the table that it overwrites. The replaced folder is then deleted; a query that was planned on it before has to be
planned anew. One writer at a time.

A *keyed* table is also divided by a hash bucket of its key, the partition column ``key_bucket``. A batch then concerns only the
buckets of its own keys: they alone are read, and the others keep their files (``replace_buckets``). NULL keys have a bucket of their own, -1, as they
never match anything. ``read_rows`` gives the rows without that column.
"""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from ..session import drop_scratch, table_path

ADOPTED, KEY, BUCKETS = "adopted", "keyed.by", "keyed.buckets"
BUCKET = "key_bucket"


def table_exists(spark, name):
    return spark.catalog.tableExists(name)


def _properties(spark, name):
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def location(spark, name):
    """The folder of the table. Of several lines of that name the last is meant, the others are columns."""
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return lines[-1].data_type


def key_of(spark, name):
    """(key, number of buckets) of a keyed table, else None."""
    found = _properties(spark, name)
    return (found[KEY], int(found[BUCKETS])) if KEY in found else None


def bucket_of_key(key, buckets):
    """Bucket of a key column; -1 for NULL."""
    return F.coalesce(F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), F.lit(-1))


def read_rows(spark, name):
    """The rows of a table, without the bucket of a keyed one."""
    rows = spark.read.table(name)
    return rows if key_of(spark, name) is None else rows.drop(BUCKET)


def _like_table(df, table):
    """``df`` with the columns, types and order of ``table``; columns it lacks are NULL."""
    have = set(df.columns)
    return [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]


def _bucketed(df, key, buckets):
    """``df`` with its bucket as the last column, buckets together and large ones in several tasks."""
    if BUCKET in df.columns:
        raise ValueError(f"column {BUCKET!r} is the name of the bucket")
    return df.withColumn(BUCKET, bucket_of_key(F.col(key), buckets)).hint("rebalance", BUCKET)


@contextmanager
def _new_folder(spark, name):
    """A new folder for the table, deleted again if it cannot be filled."""
    folder = table_path(spark, name)
    try:
        yield folder
    except BaseException:
        drop_scratch(spark, folder)
        raise


def create_keyed_table(df, name, key, buckets):
    """A new table divided by the hash of ``key`` into ``buckets`` parts."""
    spark = df.sparkSession
    rows = _bucketed(df, key, buckets)
    with _new_folder(spark, name) as folder:
        rows.write.format("parquet").partitionBy(BUCKET).option("path", folder).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEY}' = '{key}', '{BUCKETS}' = '{buckets}')")


def create_bucketed_table(df, name, key, buckets):
    """A new table whose rows of one key lie in one file, for operators that group by the key (and more): their plans then
    need no exchange. Every bucket is written, and later read, by one task, so this is for keys that few rows share."""
    with _new_folder(df.sparkSession, name) as folder:
        df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", folder).saveAsTable(name)


@contextmanager
def _only_written_partitions(spark):
    """Overwrites replace the partitions that they write, when all is written, and leave the others."""
    conf = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def replace_buckets(df, name):
    """Replace the buckets of a keyed table that ``df`` has rows of; ``df`` may be made from these buckets. The others are not touched.

    All of ``df`` is written before the first bucket is replaced.
    """
    spark = df.sparkSession
    key, buckets = key_of(spark, name)
    with _only_written_partitions(spark):
        _bucketed(df.select(_like_table(df, read_rows(spark, name))), key, buckets).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def overwrite_table(df, name, new_columns=False):
    """Replace the rows of the table, or create it. Columns that ``df`` lacks become NULL; those that are new need
    ``new_columns=True``, which adds them at the end."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        with _new_folder(spark, name) as folder:
            df.write.format("parquet").option("path", folder).saveAsTable(name)
        return
    old, keyed = read_rows(spark, name), key_of(spark, name)
    added = [f for f in df.schema if f.name not in old.columns]
    if added and not new_columns:
        raise ValueError(f"columns {[f.name for f in added]} are not in the table; pass new_columns=True to add them")
    rows, replaced = df.select(*_like_table(df, old), *[f.name for f in added]), _own_folder(spark, name)
    if keyed:
        # Partitions know their own folders, so a whole new table takes the name.
        following = f"{name}_{uuid.uuid4().hex}"
        create_keyed_table(rows, following, *keyed)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    else:
        with _new_folder(spark, name) as folder:
            rows.write.parquet(folder)
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{ADOPTED}')")
    spark.catalog.refreshTable(name)
    if replaced:
        drop_scratch(spark, replaced)


def _own_folder(spark, name):
    """The folder of the table, unless it belongs to someone else."""
    return None if ADOPTED in _properties(spark, name) else location(spark, name)


def append_table(df, name):
    """Add rows. An adopted folder belongs to someone else, so its rows are copied first."""
    spark = df.sparkSession
    old, keyed = read_rows(spark, name), key_of(spark, name)
    df = df.select(_like_table(df, old))
    if ADOPTED in _properties(spark, name):
        overwrite_table(old.union(df), name)
    else:
        (_bucketed(df, *keyed) if keyed else df).write.insertInto(name)


def drop_table(spark, name):
    """Remove the table and its folder, unless that belongs to someone else."""
    if table_exists(spark, name):
        folder = _own_folder(spark, name)
        spark.sql(f"DROP TABLE {name}")
        if folder:
            drop_scratch(spark, folder)


def adopt_parquet(spark, src, name):
    """A table over an existing Parquet folder. No row is copied, and the folder is never written to."""
    spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (path '{src}') TBLPROPERTIES ('{ADOPTED}' = 'true')")
