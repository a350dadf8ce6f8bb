"""Declared schemas of the two dumps. They are never inferred from data.

File sources make every column nullable whatever is declared, so rows with missing
keys are found afterwards with ``operators.quality.broken_rows``.
"""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Column names, order and types of the two dumps.
REVIEW_SCHEMA = StructType([
    StructField("review_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("business_id", StringType(), False),
    StructField("stars", StringType(), False),
    StructField("useful", IntegerType(), False),
    StructField("funny", IntegerType(), False),
    StructField("cool", IntegerType(), False),
    StructField("text", StringType(), False),
    StructField("date", StringType(), False),
])

BUSINESS_SCHEMA = StructType([
    StructField("business_id", StringType(), False),
    StructField("name", StringType()),
    StructField("address", StringType()),
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("postal_code", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("stars", DoubleType()),
    StructField("review_count", IntegerType()),
    StructField("is_open", IntegerType()),
    StructField("attributes", StringType()),
    StructField("categories", StringType()),
    StructField("hours", StringType()),
])

REVIEW_FIELDS = REVIEW_SCHEMA.names
BUSINESS_FIELDS = BUSINESS_SCHEMA.names

# The sentiment labels, the star ratings each of them agrees with, and those it is trained on.
POSITIVE, NEGATIVE, UNKNOWN = "positive", "negative", "na"
AGREEING_STARS = {POSITIVE: ["3.0", "4.0", "5.0"], NEGATIVE: ["1.0", "2.0", "3.0"]}
TRAINING_STARS = {POSITIVE: ["4.0", "5.0"], NEGATIVE: ["1.0", "2.0"]}
NEUTRAL_STARS = "3.0"
