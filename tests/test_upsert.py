import uuid

import pytest
from conftest import executed, rows

from reviewmill import sources as src
from reviewmill.operators import AmbiguousUpdate, upsert, upsert_table

SCHEMA = "id string, a string, b int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_matched_new_and_untouched_rows(spark):
    target = frame(spark, ("1", "old", 1), ("2", "old", 2), ("3", "old", 3))
    updates = frame(spark, ("2", "new", 20), ("4", "new", 40))
    assert rows(upsert(target, updates, "id")) == [("1", "old", 1), ("2", "new", 20), ("3", "old", 3), ("4", "new", 40)]


def test_columns_left_out(spark):
    target = frame(spark, ("1", "old", 1), ("2", "old", 2))
    updates = frame(spark, ("2", "new", 20), ("3", "new", 30))
    assert rows(upsert(target, updates, "id", ["id", "a"], ["id", "a"])) == [("1", "old", 1), ("2", "new", 2), ("3", "new", None)]
    assert rows(upsert(target, updates, "id", ["b"], ["id"])) == [("1", "old", 1), ("2", "old", 20), ("3", None, None)]


def test_a_null_in_the_updates_replaces_a_value(spark):
    assert rows(upsert(frame(spark, ("1", "old", 1)), frame(spark, ("1", None, None)), "id")) == [("1", None, None)]


def test_null_keys_never_match(spark):
    target = frame(spark, (None, "old", 1), (None, "old", 2))
    updates = frame(spark, (None, "new", 10), (None, "new", 10))
    assert rows(upsert(target, updates, "id")) == [(None, "new", 10), (None, "new", 10), (None, "old", 1), (None, "old", 2)]


def test_repeated_updates(spark):
    target = frame(spark, ("1", "old", 1))
    assert rows(upsert(target, frame(spark, ("9", "x", 1), ("9", "y", 2)), "id")) == [("1", "old", 1), ("9", "x", 1), ("9", "y", 2)]
    with pytest.raises(AmbiguousUpdate, match="'1'"):
        upsert(target, frame(spark, ("1", "x", 1), ("1", "y", 2), ("9", "x", 1), ("9", "y", 2)), "id")


def test_repeated_target_keys_are_all_updated(spark):
    target = frame(spark, ("1", "old", 1), ("1", "older", 0), ("2", "old", 2))
    assert rows(upsert(target, frame(spark, ("1", "new", 7)), "id")) == [("1", "new", 7), ("1", "new", 7), ("2", "old", 2)]


def test_types_and_order_are_those_of_the_target(spark):
    target = frame(spark, ("1", "old", 1))
    updates = spark.createDataFrame([(2, "1", 5.0), (3, "2", 6.0)], "b bigint, id string, extra double").selectExpr("b", "id", "'n' AS a", "extra")
    merged = upsert(target, updates, "id")
    assert merged.dtypes == target.dtypes
    assert rows(merged) == [("1", "n", 2), ("2", "n", 3)]


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="'b'"):
        upsert(frame(spark, ("1", "x", 1)), frame(spark, ("1", "y"), schema="id string, a string"), "id")


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_table_is_created_then_merged(spark, name):
    upsert_table(spark, name, frame(spark, ("1", "a", 1), ("2", "a", 2)), "id")
    upsert_table(spark, name, frame(spark, ("2", "b", 3), ("3", "b", 4)), "id")
    once = rows(spark.read.table(name))
    assert once == [("1", "a", 1), ("2", "b", 3), ("3", "b", 4)]
    upsert_table(spark, name, frame(spark, ("2", "b", 3), ("3", "b", 4)), "id")
    assert rows(spark.read.table(name)) == once
    with pytest.raises(AmbiguousUpdate):
        upsert_table(spark, name, frame(spark, ("2", "x", 3), ("2", "y", 4)), "id")
    assert rows(spark.read.table(name)) == once


def test_a_batch_without_matches_is_appended(spark, name):
    upsert_table(spark, name, frame(spark, ("1", "a", 1), (None, "a", 0)), "id")
    first = spark.read.table(name).inputFiles()
    upsert_table(spark, name, frame(spark, ("2", "b", 2), ("2", "c", 2), (None, "b", 3)), "id", ["id", "a"], ["id", "a"])
    assert set(first) <= set(spark.read.table(name).inputFiles())
    assert rows(spark.read.table(name)) == [
        ("1", "a", 1), ("2", "b", None), ("2", "c", None), (None, "a", 0), (None, "b", None),
    ]
    upsert_table(spark, name, frame(spark, ("1", "z", 9)), "id")
    assert not set(first) & set(spark.read.table(name).inputFiles())
    assert spark.read.table(name).where("a = 'z'").count() == 1 and spark.read.table(name).count() == 5


def test_a_batch_is_computed_once(spark, name):
    upsert_table(spark, name, frame(spark, ("1", "a", 1), ("2", "a", 2)), "id")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = frame(spark, ("2", "b", 3), ("3", "b", 4)).mapInArrow(count, SCHEMA)
    upsert_table(spark, name, batch, "id")
    assert seen.value == 2 and spark.read.table(name).count() == 3


def test_empty_sides(spark):
    some, none = frame(spark, ("1", "a", 1)), frame(spark, ("1", "a", 1)).where("false")
    assert rows(upsert(some, none, "id")) == rows(some)
    assert rows(upsert(none, some, "id")) == rows(some)


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    """The wide target rows stay in their tasks; only keys are exchanged, after being made distinct."""
    target, updates = str(tmp_path / "target"), str(tmp_path / "updates")
    spark.range(10_000).selectExpr("cast(id AS string) AS id", "repeat('x', 50) AS a", "cast(id AS int) AS b").write.parquet(target)
    spark.range(9_990, 10_010).selectExpr("cast(id AS string) AS id", "'new' AS a", "0 AS b").write.parquet(updates)
    merged = upsert(src.read_table(spark, target), src.read_table(spark, updates), "id")
    text = executed(merged)
    assert merged.count() == 10_010
    kept = text.split("LeftAnti")[0]
    assert "LeftOuter, BuildRight" in kept and "Exchange hashpartitioning" not in kept.split("LeftOuter")[1].split("Project [id")[0]
    assert "FullOuter" not in text
