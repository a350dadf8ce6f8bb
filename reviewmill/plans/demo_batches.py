"""Two small overlapping batches of reviews: write both as text, create a table from one, merge the other."""

from ..operators.sampling import overlapping_batches
from ..operators.upsert import upsert_table
from ..sources.delimited import read_delimited, write_delimited


def demo_batches(spark, reviews, n_rows, folder, table, key="review_id"):
    """Sample, write as text, read back, create ``table`` and merge into it."""
    batches = overlapping_batches(reviews, n_rows, key)
    for name, batch in zip("ab", batches):
        write_delimited(batch, f"{folder}/batch_{name}")
        written = read_delimited(spark, f"{folder}/batch_{name}", reviews.schema)
        # A row drawn for both halves of the second batch would be an ambiguous update.
        upsert_table(spark, table, written.dropDuplicates([key]), key)
