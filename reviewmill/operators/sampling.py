"""Samples, splits and class balancing.

The choice is made by hash bucket of a ``key`` that names the row: reproducible, narrow, and stable when a task is run again. Without a
key the row is named by all of its fields and, among equal rows, its place: just as reproducible, at the price of a shuffle of the rows.
"""

from pyspark.sql import functions as F

from ..functions.buckets import in_share, row_text

MAX_CLASSES = 10_000
RUN = 1 << 16


def numbered_rows(df, name):
    """The rows with a key, ``name``: a text that names each row, made of its fields and its place among equal rows.

    Equal rows are counted in the task before they are shuffled and then dealt out again by their places, in runs of ``RUN`` that go to
    different tasks, so a row that is there very often is no hot key. Columns of a map type have no order and cannot be drawn by.
    """
    row = [F.col(f"`{c}`") for c in df.columns]
    counted = df.select(F.struct(*row).alias("row")).groupBy("row").agg(F.count("*").alias("count"))
    runs = counted.select("row", "count", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(RUN).cast("long"))).alias("start"))
    # What is there more than RUN times is spread over the tasks; all else stays where it is.
    often = F.col("count") > RUN
    runs = runs.where(~often).union(runs.where(often).hint("rebalance", "start"))
    places = runs.select("row", F.explode(F.sequence("start", F.least(F.col("start") + RUN, F.col("count")) - 1)).alias("place"))
    fields = [F.col("row").getField(c) for c in df.columns]
    key = F.concat(F.md5(row_text(fields).cast("binary")), F.lit("/"), F.col("place").cast("string"))
    return places.select("row.*", key.alias(name))


def _drawn(df, key):
    """(rows, the name of their key, what to do with chosen rows)."""
    if key is not None:
        return df, key, lambda rows: rows
    name = _free_name(df, "_drawn_by")
    return numbered_rows(df, name), name, lambda rows: rows.drop(name)


def _free_name(df, name):
    while name in df.columns:
        name += "_"
    return name


def sample_about(df, n_rows, seed, key=None):
    """About ``n_rows`` rows: the fraction is ``n_rows`` over the row count."""
    share = F.try_divide(F.lit(float(n_rows)), df.agg(F.count("*")).scalar())
    rows, key, shown = _drawn(df, key)
    return shown(rows.where(in_share(key, seed, share)))


def split(df, weights, seed, key=None):
    """Disjoint parts that cover ``df``, sized by ``weights``."""
    rows, key, shown = _drawn(df, key)
    total, low, parts = float(sum(weights)), None, []
    for i, weight in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else (low or 0.0) + weight / total
        parts.append(shown(rows.where(in_share(key, seed, F.lit(high), None if low is None else F.lit(low)))))
        low = high
    return parts


def stratified_split(df, col, fraction, seed, key=None):
    """(train, test): ``fraction`` of every class of ``col`` against all other rows.

    ``fraction`` is one number or a number per class (0 for classes not named). The test side is the
    complement of a row-level condition, so no set difference is shuffled and duplicates stay.
    """
    if isinstance(fraction, dict):
        share = F.lit(0.0)
        for value, part in fraction.items():
            share = F.when(F.col(col).eqNullSafe(F.lit(value)), F.lit(float(part))).otherwise(share)
    else:
        share = F.lit(float(fraction))
    rows, key, shown = _drawn(df, key)
    chosen = in_share(key, seed, share)
    return shown(rows.where(chosen)), shown(rows.where(~chosen))


def class_ratios(df, col):
    """Rows per class and ``count_ratio`` = rows of the smallest class / rows of this class.

    Rows without a class are left out.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    smallest = counts.agg(F.min("count")).scalar()
    return counts.withColumn("count_ratio", smallest / F.col("count"))


def join_per_class(df, table, col, max_classes=MAX_CLASSES):
    """Join a table with one row per class to ``df``.

    Up to ``max_classes`` rows are broadcast, so that no row of ``df`` moves however large its class is; a
    larger table is joined as it is.
    """
    rows = table.limit(max_classes + 1).collect()
    if len(rows) <= max_classes:
        table = F.broadcast(df.sparkSession.createDataFrame(rows, table.schema))
    return df.join(table, col)


def balance(df, col, seed, key):
    """Sample every class down to about the size of the smallest."""
    ratios = class_ratios(df, col).select(col, "count_ratio")
    weighted = join_per_class(df, ratios, col)
    return weighted.where(in_share(key, seed, F.col("count_ratio"))).select(df.columns)


def overlapping_batches(df, n_rows, key, first_seed=100, second_seed=42, overlap_seed=7):
    """Two batches for an upsert: A = a sample; B = another sample and half of A."""
    first = sample_about(df, n_rows, first_seed, key)
    second = sample_about(df, n_rows, second_seed, key)
    half = first.where(in_share(key, overlap_seed, F.lit(0.5)))
    return first, second.union(half)
