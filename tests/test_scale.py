"""Shapes of the plans, and hot keys."""

import pytest
from conftest import executed, plan, rows
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill import sources as src
from reviewmill.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Sort-merge joins, and a skew split that starts at small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_reviews(spark, n=60_000):
    """A third of the rows belongs to one business, another part to none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("b"), (F.col("id") % 500).cast("string")))
    return spark.range(0, n, 1, 16).select(
        F.col("id").cast("string").alias("review_id"), key.alias("business_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.lit("d").alias("date"), F.lit("5.0").alias("stars"),
    )


def some_business(spark):
    names = spark.range(500).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("business_id"))
    return names.union(spark.createDataFrame([("hot",)], "business_id string")).withColumn("categories", F.lit("Restaurants, Bars"))


@pytest.mark.parametrize("join", [
    lambda r, b: op.attach_business(r, b),
    lambda r, b: op.category_reviews(r, b, "Restaurants"),
    lambda r, b: op.reviews_in_category(r, b, "Restaurants"),
])
def test_a_hot_business_is_split_over_tasks(spark, no_broadcast, join):
    joined = join(hot_reviews(spark), some_business(spark))
    assert "skew=true" in executed(joined)
    keyed = hot_reviews(spark).where("business_id IS NOT NULL").count()
    assert joined.where("business_id IS NOT NULL").count() == keyed


def test_hot_and_null_keys_of_an_upsert_are_split_over_tasks(spark, no_broadcast):
    target = hot_reviews(spark)
    updates = some_business(spark).select("business_id", F.lit("new").alias("text"))
    merged = op.upsert(target, updates, "business_id", ["text"], ["business_id", "text"])
    assert "skew=true" in executed(merged)
    assert merged.count() == target.count()
    assert merged.where("text = 'new'").count() == target.where("business_id IS NOT NULL").count()


def test_results_do_not_depend_on_the_join_strategy(spark, no_broadcast):
    shuffled = {name: rows(QUERIES[name](spark, FOLDER)) for name in ("join_then_filter", "upsert_all_columns", "join_semi")}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name, expected in shuffled.items():
        assert rows(QUERIES[name](spark, FOLDER)) == expected


def test_filters_and_columns_reach_the_scan(spark):
    text = executed(QUERIES["join_then_filter"](spark, FOLDER))
    assert "StringContains(p_type,PROMO)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text
    assert "l_tax" not in text


def test_counting_reads_no_text(spark):
    assert "text" not in executed(QUERIES["class_ratios"](spark, FOLDER)).replace("context", "")


def test_word_counts_are_combined_before_the_shuffle(spark):
    text = executed(QUERIES["word_class_counts"](spark, FOLDER))
    assert "partial_sum" in text or "partial_count" in text


@pytest.mark.parametrize("name", ["split_by_key", "stratified_split_per_class", "sample_by_key", "tokenize_texts", "strip_links", "clean_lines"])
def test_narrow_operators_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in executed(QUERIES[name](spark, FOLDER))


def test_a_hot_word_is_split_over_tasks(spark, no_broadcast):
    texts = spark.range(0, 60_000, 1, 16).select(F.concat(F.lit("hot "), F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789", "ghijklmnop")).alias("text"))
    weights = texts.limit(2000).select(F.substring_index("text", " ", -1).alias("word")).union(spark.createDataFrame([("hot",)], "word string"))
    model = op.SentimentModel(weights.withColumn("weight", F.lit(1).cast("long")), 0)
    scored = op.score_sentiment(texts, model)
    assert "skew=true" in executed(scored)
    assert scored.where("final_sentiment[0] = 'positive'").count() == 60_000


def test_no_query_deals_rows_out_anew(spark):
    for name in ("tokenize_texts", "sentiment_scores", "ml_words", "document_frequencies", "tfidf_features", "scan_rows", "embedding_predictions"):
        assert "REPARTITION_BY_NUM" not in executed(QUERIES[name](spark, FOLDER))


def test_term_counts_stay_in_their_rows(spark):
    assert "Exchange" not in executed(QUERIES["term_counts"](spark, FOLDER))


def test_balance_moves_no_row_by_class(spark, tmp_path):
    src.write_parquet(hot_reviews(spark, 3000), str(tmp_path / "r"))
    reviews = src.read_table(spark, str(tmp_path / "r"))
    balanced = op.balance(reviews, "business_id", 1, "review_id")
    assert "BroadcastHashJoin" in executed(balanced) and "Exchange hashpartitioning" not in executed(balanced)


def test_no_full_outer_or_cross_join_anywhere(spark):
    for name in ("upsert_by_path", "upsert_all_columns", "class_ratios", "balanced_classes", "sample_by_key", "class_metrics"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "FullOuter" not in text and "Join Cross" not in text


def test_text_buckets_grow_with_the_text(spark, monkeypatch):
    from reviewmill.queries import classify
    texts = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "doc_id long, text string")
    assert classify.text_buckets(texts) == 16
    monkeypatch.setattr(classify, "BUCKET_TEXT_BYTES", 100)
    assert classify.text_buckets(texts) == 50
