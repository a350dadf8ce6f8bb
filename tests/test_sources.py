import uuid

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from reviewmill import sources as src
from reviewmill.schemas import BUSINESS_SCHEMA, REVIEW_SCHEMA
from reviewmill.session import scratch_path
from reviewmill.sources.tables import BAD_RECORD


def test_delimited_edge_rows(spark, path):
    lines = [
        'r1|u1|b1|5.0|1|0|2|good|2020-01-01',
        'r2|u2|b2|4.0|many|0|0|bad number|2020-01-01',
        'r3|u3|b3',
        'r4|u4|b4|3.0|1|1|1|one too many|2020-01-01|extra',
        '"r5"|"u5"|"b5"|"2.0"|"1"|"1"|"1"|"say ""hi"" | here"|"2020-01-01"',
        'r6|u6||1.0|0|0|0|no business|2020-01-01',
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    found = {r.review_id: r for r in src.read_delimited(spark, path, REVIEW_SCHEMA).collect()}
    assert found["r1"].useful == 1 and found["r1"].stars == "5.0"
    assert found["r2"].useful is None and found["r2"].text == "bad number"
    assert found["r3"].stars is None and found["r3"].text is None
    assert found["r4"].date == "2020-01-01"
    assert found["r5"].text == 'say "hi" | here' and found["r5"].cool == 1
    assert found["r6"].business_id is None


def test_nested_json_with_plain_inner_quotes_keeps_its_outer_quotes(spark, path):
    line = "|".join(['"b1"', '"A"', '"{"a": "x", "b": "y"}"'])
    spark.createDataFrame([(line,)], "value string").write.text(path)
    assert src.read_delimited(spark, path, "id string, name string, attributes string").first().attributes == '"{"a": "x", "b": "y"}"'


def test_null_word(spark, path):
    spark.createDataFrame([('"b1"|"null"|"x"',), ('"b2"|null|"null x"',)], "value string").write.text(path)
    assert rows(src.read_delimited(spark, path, "a string, b string, c string", null_text="null")) == [
        ("b1", None, "x"), ("b2", None, "null x"),
    ]


def test_delimited_round_trip_keeps_texts_whole(spark, path):
    texts = ["plain", "", None, "  blanks  ", 'quo"te', "pi|pe", "line\nend\r\n", "back\\slash", "\\n", "\\\\s\\", 'tail\\"', "é x", "null"]
    df = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "id string, text string, n int")
    src.write_delimited(df, path)
    assert rows(src.read_delimited(spark, path, df.schema)) == rows(df)


def test_scans_are_nullable(spark, path):
    spark.createDataFrame([("x",)], "value string").write.text(path)
    assert all(f.nullable for f in src.read_delimited(spark, path, BUSINESS_SCHEMA).schema)


def test_parquet_write_fails_on_an_existing_path(spark, path):
    src.write_parquet(spark.range(3), path)
    with pytest.raises(AnalysisException):
        src.write_parquet(spark.range(4), path)
    src.write_parquet(spark.range(4), path, "overwrite")
    assert src.read_table(spark, path).count() == 4


def test_json_records_are_exact(spark, path):
    lines = [
        r'{"a":1.10,"b":{"x":"brace } \" quote","y":[1, 2]},"c":"say \"hi\"\n","d":null}',
        r'{"a":7.50000000000000000250,"b":null,"c":"https:\/\/x.y","d":"z"}',
        '{"a":1,"b"',
        "{'a':1}",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    records = src.read_json_records(spark, path, ["a", "b", "c", "d"])
    assert rows(records.where(f"{BAD_RECORD} is null").select("a", "b", "c", "d")) == [
        ("1.10", r'{"x":"brace } \" quote","y":[1, 2]}', 'say "hi"\n', None),
        ("7.50000000000000000250", None, "https://x.y", "z"),
    ]
    assert sorted(r[BAD_RECORD] for r in records.where(f"{BAD_RECORD} is not null").collect()) == sorted(lines[2:])


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_table_can_be_overwritten_from_itself(spark, name):
    assert not src.table_exists(spark, name)
    src.overwrite_table(spark.range(3), name)
    src.overwrite_table(spark.read.table(name).where("id > 0"), name)
    assert rows(spark.read.table(name)) == [(1,), (2,)]


def test_a_failed_write_leaves_the_old_rows(spark, name):
    src.overwrite_table(spark.range(3), name)
    failing = spark.range(5).selectExpr("if(id < 4, id, raise_error('lost')) AS id")
    with pytest.raises(Exception, match="lost"):
        src.overwrite_table(failing, name)
    assert spark.read.table(name).count() == 3
    src.overwrite_table(spark.range(7), name)
    assert spark.read.table(name).count() == 7


def test_new_columns(spark, name):
    src.overwrite_table(spark.createDataFrame([(1, "x")], "id int, a string"), name)
    wider = spark.createDataFrame([(2, True)], "id int, b boolean")
    with pytest.raises(ValueError, match="new_columns"):
        src.overwrite_table(wider, name)
    src.overwrite_table(wider, name, new_columns=True)
    assert spark.read.table(name).columns == ["id", "a", "b"]
    assert rows(spark.read.table(name)) == [(2, None, True)]
    src.overwrite_table(spark.createDataFrame([(3,)], "id int"), name)
    assert rows(spark.read.table(name)) == [(3, None, None)]


def test_adopt_parquet_copies_nothing_and_leaves_the_source_alone(spark, name, tmp_path):
    origin = str(tmp_path / "origin")
    src.write_parquet(spark.range(3), origin)
    src.adopt_parquet(spark, origin, name)
    assert spark.read.table(name).inputFiles() == src.read_table(spark, origin).inputFiles()
    src.append_table(spark.range(5), name)
    assert spark.read.table(name).count() == 8 and src.read_table(spark, origin).count() == 3
    src.append_table(spark.range(2), name)
    assert spark.read.table(name).count() == 10
    with pytest.raises(AnalysisException):
        src.adopt_parquet(spark, origin, name)


def test_scratch_is_in_the_shared_folder_of_the_session(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir")) and first != second
