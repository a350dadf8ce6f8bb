"""Hash buckets of a key: the reproducible base of all sampling and splitting.

Spark's own ``sample``, ``sampleBy`` and ``randomSplit`` draw per partition, so a
repartition, another file layout or a recomputed task gives other rows. A bucket depends on the
key and the seed alone: the same row falls on the same side on any cluster, and both
sides of a split are narrow filters. Rows without a key are drawn by their whole content and their place among equal rows.
"""

from pyspark.sql import functions as F

BUCKETS = 2 ** 32


def bucket_of(key, seed):
    """First 32 bits of md5(key || seed) as a bigint in [0, 2^32).

    ``key`` (a name or a column) should name the row: rows that share a key (or have none) share a bucket.
    """
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def row_text(columns):
    """All fields of a row as one text that no other row has: ``-`` for NULL, else the length, a colon and the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def in_share(key, seed, high, low=None):
    """True for keys whose bucket lies in [low, high) of the unit interval (numbers or columns).

    Without ``low`` the share starts at 0, and nothing is compared with it.
    """
    bucket = bucket_of(key, seed)
    below = bucket < high * F.lit(float(BUCKETS))
    return below if low is None else (bucket >= low * F.lit(float(BUCKETS))) & below
