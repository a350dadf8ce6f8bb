import json

from conftest import rows
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill import sources as src
from reviewmill.functions import clean_line, decode_lines, encode_lines, extract_between
from reviewmill.plans import ingest_dump
from reviewmill.schemas import REVIEW_SCHEMA

REVIEW = {
    "review_id": "AbCd-fGh_234567890xyzw", "user_id": "u1", "business_id": "b1", "stars": 3.0, "useful": 1, "funny": 0, "cool": 2,
    "text": 'He said "go", so:\nwe | went\\home', "date": "2018-07-07 22:09:11",
}
BUSINESS = (
    '{"business_id":"b1","name":"Fern, Moss","address":"12 Quay","city":"Orla","state":"ZQ","postal_code":"Q4 7","latitude":61.25,'
    '"longitude":8.125,"stars":2.5,"review_count":310,"is_open":1,"attributes":{"Parking":"{garage: 2}"},'
    '"categories":"Florists, Plant Care","hours":null}'
)


def lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v, separators=(",", ":")),) for v in values], "value string")


def column(spark, text, change):
    return spark.createDataFrame([(text,)], "value string").select(change(F.col("value"))).first()[0]


def test_values_follow_json(spark):
    found = op.json_values(lines(spark, r'{"a":"q\"x","b":{"k":"v } w"},"c":null}'), ["a", "b", "c", "missing"]).first()
    assert tuple(found) == ('q"x', '{"k":"v } w"}', None, None)


def test_values_in_document_order(spark):
    assert op.json_values(lines(spark, '{"z":1,"a":"x","m":{"k":[1]},"l":null}')).first()["values"] == ["1", "x", '{"k":[1]}', None]


def test_to_delimited(spark):
    df = spark.createDataFrame([('say "a"', None, 3), ("two\nlines", "", 4)], "a string, b string, c int")
    assert rows(op.to_delimited(df)) == [('"say ""a"""|"null"|"3"',), ('"two\\nlines"|""|"4"',)]
    assert rows(op.to_delimited(df, ["b", "c"], ";", None)) == [('"";"4"',), (';"3"',)]


def test_bad_records(spark):
    cut = '{"review_id":"ABCDEFGHIJ","stars":'
    good, bad = op.split_bad_records(lines(spark, REVIEW, cut, "no json at all, null"), ["review_id", "stars"])
    assert rows(good) == [("AbCd-fGh_234567890xyzw", "3.0")]
    assert rows(bad) == [(", null++++failed",), ("ABCDEFGH++++failed",)]


def test_clean_line(spark):
    assert column(spark, '{"a":null,"b":"x\\ny\\rz"}', clean_line) == '{"a":"null","b":"xyz"}'


def test_extract_between(spark):
    line = '{"name":"A: B","city":"X"}'
    assert column(spark, line, lambda c: extract_between(c, "name", "city")) == "A B,"
    assert column(spark, line, lambda c: extract_between(c, "city", "name")) == ""
    assert column(spark, line, lambda c: extract_between(c, "name", "state")) is None
    assert column(spark, '{"note":"city","city":"X"}', lambda c: extract_between(c, "note", "city")) == ""


def test_codes_for_line_ends_are_lossless(spark):
    for text in ["", "a\nb", "a\\nb", "\\", "\\\\n\n\r", "\\s", "\r\n"]:
        encoded = column(spark, text, encode_lines)
        assert "\n" not in encoded and "\r" not in encoded
        assert column(spark, encoded, decode_lines) == text


def test_business_key_values(spark):
    row = op.business_key_values(lines(spark, BUSINESS)).first()
    assert row.business_id == "b1"
    assert row["values"] == [
        "Fern, Moss", "12 Quay", "Orla", "ZQ", "Q4 7", "61.25", "8.125", "2.5", "310", "1", '{"Parking":"{garage: 2}"}',
        "", "Florists, Plant Care", "null",
    ]


def test_reviews_to_lines(spark):
    assert op.reviews_to_lines(lines(spark, {**REVIEW, "text": "a, b", "cool": None})).first().value == (
        "AbCd-fGh_234567890xyzw,u1,b1,3.0,1,0,null,a, b,2018-07-07 22:09:11"
    )


def test_dump_becomes_a_table(spark, tmp_path):
    dump, text, table = (str(tmp_path / name) for name in ("dump", "text", "table"))
    lines(spark, REVIEW, {**REVIEW, "review_id": "r2", "text": None, "useful": None, "date": None}, '{"review_id":"BROKENID0').write.text(dump)
    report = ingest_dump(spark, dump, text, table, REVIEW_SCHEMA, ["review_id", "business_id"]).first()
    assert (report.total, report.broken, report.null_review_id, report.null_business_id) == (3, 1, 0, 1)
    found = {r.review_id: r.asDict() for r in src.read_table(spark, table).collect()}
    assert found["AbCd-fGh_234567890xyzw"] == {**REVIEW, "stars": "3.0"}
    assert found["r2"]["text"] is None and found["r2"]["useful"] is None and found["r2"]["date"] is None
    assert "BROKENID++++failed" in found
