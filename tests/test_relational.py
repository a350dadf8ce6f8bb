from conftest import plan, rows

from reviewmill import operators as op

JOINED = ["review_id", "business_id", "text", "date", "categories", "stars"]


def reviews(spark):
    return spark.createDataFrame([
        ("r1", "b1", "t1", "d1", "5.0"), ("r2", "b1", "t2", "d2", "1.0"), ("r3", "b2", "t3", "d3", "3.0"),
        ("r4", "gone", "t4", "d4", "4.0"), ("r5", None, "t5", "d5", None), ("r6", "b3", "t6", "d6", "2.0"),
    ], "review_id string, business_id string, text string, date string, stars string")


def business(spark):
    return spark.createDataFrame([
        ("b1", "Bars, Restaurants, Food", 4.0), ("b2", None, 3.0), ("b3", "restaurants", 2.0), (None, "Restaurants", 1.0),
    ], "business_id string, categories string, stars double")


def test_category_is_a_case_sensitive_substring(spark):
    assert rows(op.in_category(business(spark), "Restaurants").select("stars")) == [(1.0,), (4.0,)]


def test_left_join_keeps_all_reviews_and_never_matches_null_keys(spark):
    joined = op.attach_business(reviews(spark), business(spark))
    assert joined.columns == JOINED
    assert rows(joined.select("review_id", "business_id")) == [
        ("r1", "b1"), ("r2", "b1"), ("r3", "b2"), ("r4", None), ("r5", None), ("r6", "b3"),
    ]


def test_category_reviews_and_its_two_spellings(spark):
    late = op.category_reviews(reviews(spark), business(spark), "Restaurants")
    early = op.category_reviews(reviews(spark), business(spark), "Restaurants", filter_first=True)
    assert rows(late.select("review_id")) == [("r1",), ("r2",)]
    assert rows(late) == rows(early)


def test_filter_before_a_left_join_keeps_the_other_reviews(spark):
    kept = op.attach_business(reviews(spark), op.in_category(business(spark), "Restaurants"))
    assert kept.count() == 6
    assert kept.where("business_id IS NOT NULL").count() == 2


def test_late_filter_turns_the_left_join_into_an_inner_one(spark):
    text = plan(op.category_reviews(reviews(spark), business(spark), "Restaurants"))
    assert "Join Inner" in text and "LeftOuter" not in text
    assert "Join LeftOuter" in plan(op.attach_business(reviews(spark), op.in_category(business(spark), "Restaurants")))


def test_semi_join_gives_whole_reviews_once(spark):
    twice = business(spark).union(business(spark))
    found = op.reviews_in_category(reviews(spark), twice, "Restaurants")
    assert found.columns == reviews(spark).columns
    assert rows(found.select("review_id")) == [("r1",), ("r2",)]


def test_broken_rows(spark):
    assert rows(op.broken_rows(business(spark), ["business_id"]).select("stars")) == [(1.0,)]
    assert rows(op.broken_rows(business(spark), ["business_id", "categories"]).select("stars")) == [(1.0,), (3.0,)]


def test_links(spark):
    texts = ["see http://a.b/c now", "https:\\/\\/www.y.com\\/w?v=9", "at www.x.org, ok", "the https protocol", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.text for r in op.strip_links(df).collect()] == ["see  now", "", "at  ok", "the https protocol", None]


def test_stars_to_double(spark):
    df = spark.createDataFrame([("5.0",), ("x",), (None,)], "stars string")
    assert [r.stars for r in op.stars_to_double(df).collect()] == [5.0, None, None]


def test_preview_is_ordered(spark):
    assert [r.id for r in op.preview(spark.range(100).repartition(7), ["id"], 3).collect()] == [0, 1, 2]


def test_set_difference_drops_duplicates(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    assert rows(op.set_difference(left, spark.createDataFrame([(2,)], "x int"))) == [(1,), (None,)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "10"), (3, None), (4, "30")], "n int, s string")
    found = {r.column: r for r in op.profile(df).collect()}
    n, s = found["n"], found["s"]
    assert (n["count"], n["mean"], n["min"], n.p25, n.p50, n.p75, n["max"]) == (4, 2.5, "1", 1.0, 2.0, 3.0, "4")
    assert (s["count"], s["mean"], s["min"], s["max"]) == (3, 20.0, "10", "a")
    summary = {r.summary: r for r in df.summary().collect()}
    assert float(summary["stddev"].n) == n["stddev"]
    assert [float(summary[q].n) for q in ("25%", "50%", "75%")] == [n.p25, n.p50, n.p75]


def test_quality_report_and_distribution(spark):
    report = op.quality_report(business(spark), ["business_id", "categories"]).first()
    assert tuple(report) == (4, 2, 1, 1)
    counts = op.distribution(reviews(spark), "stars").collect()
    assert [(r.stars, r["count"]) for r in counts] == [(None, 1), ("1.0", 1), ("2.0", 1), ("3.0", 1), ("4.0", 1), ("5.0", 1)]


def test_reused_releases_and_staged_drops(spark, tmp_path):
    import os
    with op.reused(spark.range(5)) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached
    with op.staged(spark.range(5), "stage") as written:
        folder = written.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert written.count() == 5 and os.path.isdir(folder)
    assert not os.path.exists(folder)
