"""Merge a batch of rows into a table by key.

A full outer join would shuffle every target row and could use neither a broadcast nor the skew
split. The merge is therefore put together from three joins that can:

* the target left-joined to the updates: one pass over the target, without a shuffle of it as long as Spark
  measures the updates as small enough to broadcast, and with skewed keys (NULL ones too)
  split over tasks when it does not;
* the keys of the target semi-joined to those of the updates: a pass over the key column alone, with at most as many
  distinct keys left as there are updates;
* the updates anti-joined to these keys: the rows to insert.
"""

from pyspark.sql import functions as F

from ..sources.catalog import (
    BUCKET, append_table, bucket_of_key, create_keyed_table, key_of, overwrite_table, read_rows, replace_buckets, table_exists,
)
from .reuse import staged


class AmbiguousUpdate(ValueError):
    """Two update rows match the same target row."""


def _matched(target, keys, key):
    return target.select(key).join(keys.select(key), key, "left_semi")


def check_unambiguous(target, updates, key):
    """Raise ``AmbiguousUpdate`` if a key occurs twice in the updates and also in the target.

    The first job counts keys (combined before the shuffle) and ends here for a clean batch;
    the target is read only if some key is repeated.
    """
    repeated = updates.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if repeated.isEmpty():
        return
    example = _matched(target, repeated, key).take(1)
    if example:
        raise AmbiguousUpdate(f"several updates for {key} = {example[0][0]!r}")


def _column_lists(target, updates, key, update_cols, insert_cols):
    update_cols = list(target.columns if update_cols is None else update_cols)
    insert_cols = list(target.columns if insert_cols is None else insert_cols)
    for c in {key, *update_cols, *insert_cols}:
        if c not in target.columns or c not in updates.columns:
            raise ValueError(f"column {c!r} must be in the target and in the updates")
    return update_cols, insert_cols


def _kept_rows(target, updates, key, update_cols):
    """All target rows, the matched ones with their new values."""
    changed = [c for c in update_cols if c != key]
    # One struct beside the target's columns, so that none of their names can clash with it.
    new = updates.select(F.struct(key, *changed).alias("row")).alias("new")
    joined = target.alias("old").join(new, F.col(f"old.{key}") == F.col(f"new.row.{key}"), "left")
    return joined.select([
        F.when(F.col("new.row").isNotNull(), F.col(f"new.row.{f.name}").cast(f.dataType)).otherwise(F.col(f"old.{f.name}")).alias(f.name)
        if f.name in changed else F.col(f"old.{f.name}")
        for f in target.schema
    ])


def _inserted_rows(target, updates, insert_cols):
    return updates.select([
        (F.col(f.name) if f.name in insert_cols else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema
    ])


def upsert(target, updates, key, update_cols=None, insert_cols=None):
    """The target after the merge, with the columns and order of the target.

    Matched rows get ``update_cols``, other columns keep their value. Updates without a match are
    inserted with ``insert_cols`` and NULL elsewhere, repeated ones too. Target rows without a match
    stay. NULL keys never match. The default for both lists is every column.
    """
    update_cols, insert_cols = _column_lists(target, updates, key, update_cols, insert_cols)
    check_unambiguous(target, updates, key)
    fresh = updates.join(_matched(target, updates, key).distinct(), key, "left_anti")
    return _kept_rows(target, updates, key, update_cols).union(_inserted_rows(target, fresh, insert_cols))


def upsert_table(spark, name, updates, key, update_cols=None, insert_cols=None, buckets=None):
    """Create the table from ``updates`` if there is none of that name, else merge.

    The batch is computed once and staged, and so are the keys it shares with the table: one join of keys, with one pass over the table's key
    column, serves the check for ambiguous updates, the choice between append and rewrite, and the rows to insert. A batch that
    matches nothing is appended; with matches, which may be in any file, the table is written anew.

    With ``buckets``, a new table is divided by a hash of the key into so many parts (``sources.catalog``). Every later batch, whether it says so or not,
    then reads only the parts that its keys are in and rewrites only those in which it has matches. That is the layout for tables that are
    large beside their batches; some hundred MB a bucket is a good size.
    """
    if not table_exists(spark, name):
        if buckets:
            create_keyed_table(updates, name, key, buckets)
        else:
            overwrite_table(updates, name)
        return
    target = read_rows(spark, name)
    update_cols, insert_cols = _column_lists(target, updates, key, update_cols, insert_cols)
    keyed = key_of(spark, name)
    if keyed and keyed[0] == key:
        _upsert_buckets(spark, name, updates, *keyed, update_cols, insert_cols)
        return
    with staged(updates, "batch") as batch, staged(_matched(target, batch, key).distinct(), "matched") as matched:
        check_unambiguous(matched, batch, key)
        inserted = _inserted_rows(target, batch.join(matched, key, "left_anti"), insert_cols)
        if matched.isEmpty():
            append_table(inserted, name)
        else:
            overwrite_table(_kept_rows(target, batch, key, update_cols).union(inserted), name)


def buckets_with(spark, name, buckets):
    """The rows of a keyed table in the given buckets; no file of another one is listed or read."""
    return spark.read.table(name).where(F.col(BUCKET).isin(buckets)).drop(BUCKET)


def _upsert_buckets(spark, name, updates, key, n, update_cols, insert_cols):
    """The driver sees the numbers of the buckets that the batch touches, at most ``n``.

    Buckets with matches are replaced in one step, their new rows included; new rows of other buckets are appended before. Should
    the job end in between, the same batch can be merged again: what was inserted is then matched, but for rows with a NULL key, which come last.
    """
    target = read_rows(spark, name)
    kind = target.schema[key].dataType  # the hash of a key depends on its type
    updates = updates.withColumn(key, F.col(key).cast(kind))

    def numbers(keys):
        return [r[0] for r in keys.select(bucket_of_key(F.col(key), n).alias("bucket")).distinct().collect()]

    with staged(updates, "batch") as batch:
        touched = [b for b in numbers(batch) if b >= 0]
        with staged(_matched(buckets_with(spark, name, touched), batch, key).distinct(), "matched") as matched:
            check_unambiguous(matched, batch, key)
            hit = numbers(matched)
            inside = F.coalesce(bucket_of_key(F.col(key), n).isin(hit), F.lit(False)) & F.lit(key in insert_cols)
            fresh, keyless = batch.join(matched, key, "left_anti"), F.col(key).isNull()
            for part in (~inside & ~keyless, None, keyless):
                if part is not None:
                    rows = fresh.where(part)
                    if not rows.isEmpty():
                        append_table(_inserted_rows(target, rows, insert_cols), name)
                elif hit:
                    kept = _kept_rows(buckets_with(spark, name, hit), batch, key, update_cols)
                    replace_buckets(kept.union(_inserted_rows(target, fresh.where(inside), insert_cols)), name)
