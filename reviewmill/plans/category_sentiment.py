"""The main application: sentiment of the reviews of one business category, checked against the stars."""

from ..operators.relational import category_reviews
from ..operators.reuse import staged
from ..operators.sentiment import accuracy, right_prediction, score_sentiment
from ..operators.upsert import upsert_table

# The columns an upsert of scored reviews sets. ``stars`` keeps its value.
SCORED_COLUMNS = [
    "review_id", "business_id", "text", "date", "categories", "final_sentiment", "right_prediction",
]


def scored_category_reviews(reviews, business, category, model):
    """Joined, filtered and scored reviews with the agreement flag."""
    return right_prediction(score_sentiment(category_reviews(reviews, business, category), model))


def category_sentiment(spark, reviews, business, category, model, table, columns=SCORED_COLUMNS, buckets=None):
    """Score a batch, measure it and upsert it into ``table``; the accuracy row.

    The scored batch is staged, since the measure and the joins of the merge all read it, most of
    them a single column. With ``buckets`` a new table is divided by the key, so that later batches rewrite only the
    parts they touch.
    """
    scored = scored_category_reviews(reviews, business, category, model)
    with staged(scored, "scored_batch") as batch:
        upsert_table(spark, table, batch, "review_id", columns, columns, buckets)
        return accuracy(batch).first()
