"""Every registered query of the library against its SQL; those of the training data have tests of their own."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry
from reviewmill.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "review_id", "business_id", "text", "date", "categories", "stars", "final_sentiment", "right_prediction",
    ]
    assert result.count() > 0
