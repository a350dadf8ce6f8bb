"""The life of a catalog table: its folder, overwrites, and merges by bucket."""

import os
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reviewmill import sources as src
from reviewmill.operators import AmbiguousUpdate, upsert, upsert_table
from reviewmill.operators.upsert import buckets_with

SCHEMA = "id string, a string, b int"


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    src.drop_table(spark, name)


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def folder(spark, name):
    return src.location(spark, name).removeprefix("file:")


def folders(spark, name):
    root = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    return [f for f in os.listdir(root) if f.startswith(name)]


def files(spark, name):
    """Path -> time of change and size, below the table's folder."""
    found = {}
    for at, _, names in os.walk(folder(spark, name)):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(at, n)
                found[os.path.relpath(path, folder(spark, name))] = (os.stat(path).st_mtime_ns, os.stat(path).st_size)
    return found


def test_tables_live_in_the_warehouse(spark, name):
    src.overwrite_table(spark.range(3), name)
    assert os.path.dirname(folder(spark, name)) == spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    assert spark.conf.get("spark.checkpoint.dir") not in folder(spark, name)


@pytest.mark.parametrize("buckets", [None, 4])
def test_one_folder_is_left_after_many_overwrites(spark, name, buckets):
    if buckets:
        src.create_keyed_table(spark.range(3), name, "id", buckets)
    for n in range(10):
        src.overwrite_table(src.read_rows(spark, name).union(spark.range(1000, 1001)) if n else spark.range(5), name)
    assert len(folders(spark, name)) == 1 and src.read_rows(spark, name).count() == 14
    assert src.key_of(spark, name) == (("id", 4) if buckets else None)
    src.drop_table(spark, name)
    assert not folders(spark, name) and not src.table_exists(spark, name)


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_failed_overwrite_leaves_the_old_folder(spark, name, buckets):
    if buckets:
        src.create_keyed_table(spark.range(3), name, "id", buckets)
    else:
        src.overwrite_table(spark.range(3), name)
    before = folder(spark, name)
    with pytest.raises(Exception, match="lost"):
        src.overwrite_table(spark.range(5).selectExpr("if(id < 4, id, raise_error('lost')) AS id"), name)
    assert folder(spark, name) == before and rows(src.read_rows(spark, name)) == [(0,), (1,), (2,)]
    assert len(folders(spark, name)) == 1


def test_dropping_an_adopted_table_leaves_the_files(spark, name, tmp_path):
    src.write_parquet(spark.range(3), str(tmp_path / "origin"))
    src.adopt_parquet(spark, str(tmp_path / "origin"), name)
    src.overwrite_table(spark.range(9), name)
    assert src.read_table(spark, str(tmp_path / "origin")).count() == 3
    src.drop_table(spark, name)
    src.adopt_parquet(spark, str(tmp_path / "origin"), name)
    src.drop_table(spark, name)
    assert src.read_table(spark, str(tmp_path / "origin")).count() == 3


def test_new_columns_of_a_keyed_table(spark, name):
    src.create_keyed_table(frame(spark, ("1", "x", 1), (None, "y", 2)), name, "id", 8)
    src.overwrite_table(frame(spark, ("2", True), schema="id string, c boolean"), name, new_columns=True)
    assert rows(src.read_rows(spark, name)) == [("2", None, None, True)]
    upsert_table(spark, name, spark.createDataFrame([("2", "z", 5, False)], "id string, a string, b int, c boolean"), "id")
    assert rows(src.read_rows(spark, name)) == [("2", "z", 5, False)]


def test_a_batch_in_one_bucket_leaves_the_other_files(spark, name):
    target = spark.range(2000).selectExpr("cast(id AS string) AS id", "'old' AS a", "cast(id AS int) AS b")
    upsert_table(spark, name, target, "id", buckets=64)
    assert len({f.split("/")[0] for f in files(spark, name)}) == 64
    before = files(spark, name)
    number = src.bucket_of_key(F.col("id"), 64)
    batch = target.where(number == 7).limit(5).withColumn("a", F.lit("new"))
    more = spark.range(2000, 9000).selectExpr("cast(id AS string) AS id", "'added' AS a", "0 AS b").where(number == 7).limit(3)
    batch = spark.createDataFrame(batch.union(more).collect(), SCHEMA)
    want = rows(upsert(target, batch, "id"))
    upsert_table(spark, name, batch, "id")
    after = files(spark, name)
    changed = {f.split("/")[0] for f, _ in set(before.items()) ^ set(after.items())}
    assert changed == {"key_bucket=7"} and rows(src.read_rows(spark, name)) == want


def test_new_keys_alone_are_appended(spark, name):
    upsert_table(spark, name, frame(spark, ("1", "a", 1), (None, "a", 0)), "id", buckets=4)
    before = files(spark, name)
    upsert_table(spark, name, frame(spark, ("2", "b", 2), ("2", "c", 2), (None, "b", 3)), "id", ["id", "a"], ["id", "a"])
    assert before.items() <= files(spark, name).items()
    assert rows(src.read_rows(spark, name)) == [("1", "a", 1), ("2", "b", None), ("2", "c", None), (None, "a", 0), (None, "b", None)]


def test_only_touched_buckets_are_read(spark, name):
    upsert_table(spark, name, spark.range(500).selectExpr("cast(id AS string) AS id", "'x' AS a", "1 AS b"), "id", buckets=16)
    part = buckets_with(spark, name, [3, 5])
    assert "PartitionFilters: [key_bucket" in part._jdf.queryExecution().executedPlan().toString()
    assert {f.split("key_bucket=")[1].split("/")[0] for f in part.inputFiles()} == {"3", "5"}


@pytest.mark.parametrize("columns", [(None, None), (["id", "a"], ["id", "a"]), (["b"], ["id"]), (["a"], ["a", "b"])])
def test_a_merge_by_bucket_is_the_merge(spark, name, columns):
    target = spark.range(300).selectExpr("if(id % 10 = 0, NULL, cast(id % 250 AS string)) AS id", "'old' AS a", "cast(id AS int) AS b")
    batch = spark.range(200, 420).where("id % 3 = 0").selectExpr("if(id % 7 = 0, NULL, cast(id AS string)) AS id", "'new' AS a", "-1 AS b")
    upsert_table(spark, name, target, "id", buckets=8)
    want = rows(upsert(target, batch, "id", *columns))
    upsert_table(spark, name, batch, "id", *columns)
    assert rows(src.read_rows(spark, name)) == want


def test_merged_twice_is_merged_once(spark, name):
    upsert_table(spark, name, frame(spark, *[(str(i), "old", i) for i in range(50)]), "id", buckets=8)
    batch = frame(spark, *[(str(i), "new", i) for i in range(40, 60)])
    upsert_table(spark, name, batch, "id")
    once = rows(src.read_rows(spark, name))
    upsert_table(spark, name, batch, "id")
    assert rows(src.read_rows(spark, name)) == once and len(once) == 60


def test_ambiguous_batches_and_failing_ones_change_nothing(spark, name):
    upsert_table(spark, name, frame(spark, *[(str(i), "old", i) for i in range(50)]), "id", buckets=8)
    before = files(spark, name)
    with pytest.raises(AmbiguousUpdate, match="'7'"):
        upsert_table(spark, name, frame(spark, ("7", "x", 1), ("7", "y", 2), ("99", "n", 0)), "id")
    failing = frame(spark, ("7", "x", 1), ("8", "y", 2)).selectExpr("id", "if(id = '7', a, raise_error('lost')) AS a", "b")
    with pytest.raises(Exception, match="lost"):
        upsert_table(spark, name, failing, "id")
    assert files(spark, name) == before


def test_keys_of_another_type_and_another_key(spark, name):
    upsert_table(spark, name, spark.range(20).selectExpr("id", "'old' AS a", "cast(id AS int) AS b"), "id", buckets=4)
    upsert_table(spark, name, spark.createDataFrame([(3, "new", 3), (40, "new", 41)], "id int, a string, b int"), "id")
    assert src.read_rows(spark, name).where("a = 'new'").count() == 2 and src.read_rows(spark, name).count() == 21
    upsert_table(spark, name, spark.createDataFrame([(5, "by b", 41)], "id long, a string, b int"), "b")
    assert rows(src.read_rows(spark, name).where("a = 'by b'")) == [(5, "by b", 41)] and src.key_of(spark, name) == ("id", 4)


def test_columns_that_clash(spark, name):
    schema = "id string, row string, new string, old string, _matched int"
    target = spark.createDataFrame([("1", "r", "n", "o", 5), ("2", "r", "n", "o", 6)], schema)
    updates = spark.createDataFrame([("2", "R", "N", "O", 7), ("3", "R", "N", "O", 8)], schema)
    want = [("1", "r", "n", "o", 5), ("2", "R", "N", "O", 7), ("3", "R", "N", "O", 8)]
    assert rows(upsert(target, updates, "id")) == want
    upsert_table(spark, name, target, "id", buckets=2)
    upsert_table(spark, name, updates, "id")
    assert rows(src.read_rows(spark, name)) == want
    with pytest.raises(ValueError, match="key_bucket"):
        src.create_keyed_table(target.withColumn("key_bucket", F.lit(1)), f"{name}_other", "id", 2)


def test_a_hot_bucket_is_written_by_several_tasks(spark, name):
    """A third of the rows has no key and another third one key; the rebalance splits what is large."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200KB")
    try:
        hot = spark.range(0, 30_000, 1, 8).selectExpr("CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'hot' ELSE cast(id AS string) END AS id", "sha2(cast(id AS string), 256) AS a", "1 AS b")
        upsert_table(spark, name, hot, "id", buckets=4)
    finally:
        spark.conf.set(size, before)
    parts = [f.split("/")[0] for f in files(spark, name)]
    assert parts.count("key_bucket=-1") > 1 and src.read_rows(spark, name).count() == 30_000
