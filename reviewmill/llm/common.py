"""Helpers shared by the operators of this subpackage."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path

# Words as runs of anything but blanks and the control characters 9 to 13.
WORD = r"[^ \t-\r]+"


def text_size(col):
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df, name, **options):
    """Write ``df`` to a new folder of the shared scratch space and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor costs nothing that was written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table):
    """Delete the files of a ``stored`` table that nothing will read again: all that was made from it is stored itself."""
    drop_scratch(table.sparkSession, table.stored_at)


def prefix_sums(df, groups, bucket, order, value, name, per_group=None):
    """Add ``name``: the sum of ``value`` over the rows before, per group, in the order (bucket, *order).

    ``bucket`` must ascend with the order. Rows are only brought together by group and bucket, so a group that holds a third
    of all rows is spread over as many tasks as it has buckets; the sums of the buckets are added up apart, one row each.
    ``per_group`` is a table with one row per group whose other columns are added too, by way of the sums.
    """
    # NULL is a group of its own. Plain keys let the window and the join share one shuffle.
    def keyed(table):
        table = table.withColumns({f"_none{i}": F.col(g).isNull() for i, g in enumerate(groups)})
        return table.withColumns({f"_group{i}": F.coalesce(F.col(g).cast("string"), F.lit("")) for i, g in enumerate(groups)})

    same = [f"_{part}{i}" for i in range(len(groups)) for part in ("none", "group")]
    before = (Window.unboundedPreceding, -1)
    df = keyed(df).withColumn("_bucket", bucket).withColumn("_value", value)
    base = df.groupBy(*same, "_bucket").agg(F.sum("_value").alias("_sum"))
    base = base.withColumn("_base", F.coalesce(F.sum("_sum").over(Window.partitionBy(*same).orderBy("_bucket").rowsBetween(*before)), F.lit(0))).drop("_sum")
    if per_group is not None:
        base = base.join(keyed(per_group).drop(*groups), same)
    inside = Window.partitionBy(*same, "_bucket").orderBy(*order).rowsBetween(*before)
    df = df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))).join(base, [*same, "_bucket"])
    return df.withColumn(name, F.col("_base") + F.col("_inside")).drop(*same, "_bucket", "_value", "_inside", "_base")
