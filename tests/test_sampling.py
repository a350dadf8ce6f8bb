import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill.operators.sampling import join_per_class

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def reviews(spark, n=2000):
    stars = F.when(F.col("id") % 10 < 7, "5.0").when(F.col("id") % 10 < 9, "2.0").otherwise("1.0")
    return spark.range(n).select(F.col("id").cast("string").alias("review_id"), stars.alias("stars"))


def ids(df):
    return {r.review_id for r in df.select("review_id").collect()}


def test_sample_size_and_independence_of_partitions(spark):
    df = reviews(spark)
    sample = op.sample_about(df, 500, 42, "review_id")
    assert 420 < sample.count() < 580
    assert ids(sample) == ids(op.sample_about(df.repartition(13), 500, 42, "review_id"))
    assert ids(sample) != ids(op.sample_about(df, 500, 43, "review_id"))
    assert op.sample_about(df, 10 ** 9, 42, "review_id").count() == 2000
    assert op.sample_about(df.where("false"), 5, 42, "review_id").count() == 0
    assert op.sample_about(df.where("false"), 5, 42).count() == 0


@RELAXED
@given(weights=st.lists(st.floats(0.05, 3), min_size=1, max_size=4), seed=st.integers(0, 10 ** 6))
def test_split_parts_are_disjoint_and_cover(spark, weights, seed):
    df = reviews(spark, 300)
    parts = [ids(part) for part in op.split(df, weights, seed, "review_id")]
    assert sum(map(len, parts)) == 300 and set().union(*parts) == ids(df)


def test_stratified_split_keeps_duplicates_and_rows_without_class(spark):
    df = spark.createDataFrame([("1", "5.0"), ("1", "5.0"), ("2", None), ("3", "1.0"), (None, "1.0")], "review_id string, stars string")
    train, test = op.stratified_split(df, "stars", 0.5, 3, "review_id")
    assert rows(train.union(test)) == rows(df)
    train, test = op.stratified_split(df, "stars", {None: 1.0, "1.0": 0.0}, 3, "review_id")
    assert rows(train) == [("2", None)] and test.count() == 4


def test_stratified_split_shares(spark):
    train, _ = op.stratified_split(reviews(spark), "stars", 0.8, 1, "review_id")
    counts = {r.stars: r["count"] for r in train.groupBy("stars").count().collect()}
    assert abs(counts["5.0"] - 1120) < 60 and abs(counts["2.0"] - 320) < 40 and abs(counts["1.0"] - 160) < 30


def test_balance(spark):
    df = reviews(spark)
    assert {r.stars: (r["count"], round(r.count_ratio, 4)) for r in op.class_ratios(df, "stars").collect()} == {
        "5.0": (1400, 0.1429), "2.0": (400, 0.5), "1.0": (200, 1.0),
    }
    counts = {r.stars: r["count"] for r in op.balance(df, "stars", 1, "review_id").groupBy("stars").count().collect()}
    assert counts["1.0"] == 200
    assert all(abs(n - 200) < 5 * 200 ** 0.5 for n in counts.values())


def test_balance_of_one_class_a_single_row_and_no_class(spark):
    one = reviews(spark, 5)
    assert op.balance(one, "stars", 1, "review_id").count() == 5
    df = one.union(spark.createDataFrame([("x", "1.0"), ("y", None)], "review_id string, stars string"))
    kept = op.balance(df, "stars", 1, "review_id")
    assert kept.where("stars = '1.0'").count() == 1 and kept.where("stars IS NULL").count() == 0


@pytest.mark.parametrize("max_classes", [2, 10])
def test_class_table_beyond_the_bound_gives_the_same_rows(spark, max_classes):
    df = reviews(spark, 100)
    ratios = op.class_ratios(df, "stars").select("stars", "count_ratio")
    joined = join_per_class(df, ratios, "stars", max_classes)
    assert joined.count() == 100
    assert joined.where("count_ratio = 1").count() == 10
    assert ("ResolvedHint" in str(joined._jdf.queryExecution().analyzed())) == (max_classes == 10)


def test_overlapping_batches(spark):
    df = reviews(spark)
    first, second = op.overlapping_batches(df, 400, "review_id")
    half = op.sample_about(df, 400, 42, "review_id")
    assert ids(half) <= ids(second)
    assert 0.3 < len(ids(second) & ids(first)) / len(ids(first)) < 0.8
    assert second.count() >= half.count()
