"""Joins of reviews and businesses, category and null filters, previews.

The joins carry no hints. Spark broadcasts the business side when its size after filters is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise; a business that holds a large part of
all reviews is then split over many tasks by the adaptive skew join, which handles the
inner, left outer and left semi joins used here (the reviews are always the left side). No result
depends on which way is taken.
"""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from ..functions.text import without_links

def in_category(df, category, col="categories"):
    """Rows whose category list contains ``category`` (case-sensitive substring; NULL drops out)."""
    return df.where(F.col(col).contains(category))


def attach_business(reviews, business, how="left"):
    """Reviews with the id and categories of their business; both NULL where there is none."""
    r, b = reviews.alias("r"), business.alias("b")
    return r.join(b, F.col("r.business_id") == F.col("b.business_id"), how).select(
        "r.review_id", "b.business_id", "r.text", "r.date", "b.categories", "r.stars"
    )


def category_reviews(reviews, business, category, filter_first=False):
    """Reviews of the businesses in a category.

    Both spellings give the same rows and, after optimisation, the same plan: the filter on a
    business column turns the left join into an inner one and moves below it.
    """
    if filter_first:
        return attach_business(reviews, in_category(business, category), "inner")
    return in_category(attach_business(reviews, business), category)


def reviews_in_category(reviews, business, category):
    """Whole review rows, no business column: a semi-join."""
    return reviews.join(in_category(business, category), "business_id", "left_semi").select(reviews.columns)


def broken_rows(df, required):
    """Rows with a NULL in any required column."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in required]))


def mispredicted(df):
    return df.where(F.col("right_prediction") == 0)


def strip_links(df, col="text"):
    return df.withColumn(col, without_links(F.col(col)))


def stars_to_double(df, col="stars"):
    """Text to number; text that is no number becomes NULL instead of failing the job."""
    return df.withColumn(col, F.col(col).try_cast("double"))


def preview(df, order_by, n=20):
    """First n rows by ``order_by``: each task keeps its own n, no full sort."""
    return df.orderBy(*order_by).limit(n)


def set_difference(left, right):
    """Distinct rows of ``left`` that are not in ``right``.

    Both sides are made distinct first: repeated rows are dropped by each task before anything is shuffled.
    """
    return left.distinct().subtract(right.distinct())
