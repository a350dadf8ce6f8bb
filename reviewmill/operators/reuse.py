"""Keep an intermediate result for several actions."""

from contextlib import contextmanager

from ..session import drop_scratch, scratch_path
from ..sources.tables import read_table, write_parquet


@contextmanager
def reused(df):
    """Persist ``df`` (memory, then disk) for the block and release it at the end.

    For results that fit the executors. A lost executor costs the recomputation of its blocks, nothing else.
    """
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def staged(df, name):
    """Write ``df`` once to the shared scratch folder for the block, and read it from there.

    For large results: later actions read only the columns they need, and lost executors cost nothing.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        write_parquet(df, path)
        yield read_table(spark, path)
    finally:
        drop_scratch(spark, path)
