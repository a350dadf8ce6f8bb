"""Exact quartiles, TF-IDF values, the proof of a fit, the closed-form classifier, draws without a key, malformed lines."""

import math
import random
import statistics

import numpy as np
import pytest
from conftest import executed, rows
from pyspark.sql import functions as F

from reviewmill import operators as op
from reviewmill import sources as src
from reviewmill.functions import extract_between
from reviewmill.operators import sampling
from reviewmill.operators.quality import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def at_rank(values, share):
    """The least value that at least the share of the values does not exceed; NaN is the greatest."""
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    return ordered[max(1, math.ceil(share * len(ordered))) - 1]


draw = random.Random(4)
COLUMNS = {
    "one value on half of the rows": [7.0] * 500 + [draw.uniform(-1e6, 1e6) for _ in range(500)],
    "orders of magnitude": [draw.choice([-1, 1]) * 10.0 ** draw.randint(-300, 300) for _ in range(1000)],
    "neighbours": [math.nextafter(1e6, 2e6) if i % 3 else 1e6 for i in range(1000)],
    "small": [i * 1e-310 for i in range(1000)],
    "ties": [float(i // 100) for i in range(1000)],
    "one": [-0.5] * 1000,
    "the ends": [float("inf")] * 200 + [float("-inf")] * 300 + [float("nan")] * 100 + [1.5] * 400,
    "extremes": [1.7e308, -1.7e308] * 500,
}


@pytest.mark.parametrize("bins", [3, 1024])
def test_quantiles_are_exact(spark, bins):
    data = list(zip(*[draw.sample(v, len(v)) for v in COLUMNS.values()]))
    names = [f"c{i}" for i in range(len(COLUMNS))]
    frame = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))
    chosen = range(len(COLUMNS)) if bins > 3 else [0, 2, 4, 5, 6]
    found = exact_quantiles(frame.repartition(7), {names[i]: F.col(names[i]) for i in chosen}, SHARES, bins)
    for i in chosen:
        want = [at_rank(list(COLUMNS.values())[i], s) for s in SHARES]
        assert all(a == b or (math.isnan(a) and math.isnan(b)) for a, b in zip(found[names[i]], want)), list(COLUMNS)[i]


def test_quantiles_of_nothing(spark):
    frame = spark.createDataFrame([(None, "x"), (None, None)], "a double, b string")
    assert exact_quantiles(frame, {"a": F.col("a")}, [0.5]) == {"a": [None]}
    assert exact_quantiles(frame.limit(0), {"a": F.col("a")}, [0.5]) == {"a": [None]}
    found = {r.column: r for r in op.profile(frame).collect()}
    assert found["a"].p50 is None and found["b"].p25 is None and found["b"]["count"] == 1


def test_profile_of_long_columns(spark):
    frame = spark.range(0, 20_001, 1, 9).selectExpr("if(id % 2 = 0, 5, id) AS n", "cast(id AS string) AS s")
    found = {r.column: r for r in op.profile(frame).collect()}
    values = sorted(5 if i % 2 == 0 else i for i in range(20_001))
    assert (found["n"].p25, found["n"].p50, found["n"].p75) == tuple(float(values[math.ceil(q * 20_001) - 1]) for q in (0.25, 0.5, 0.75))
    assert found["s"].p50 == 10_000.0 and found["n"].mean == pytest.approx(statistics.fmean(values))


# Words

def texts(spark):
    return spark.createDataFrame([(i, f"all {'red' if i % 2 else 'blue'} {'rare' if i < 3 else 'word'} number{i} red") for i in range(40)] + [(40, None), (41, "")], "id long, text string")


def test_bucketed_words_are_counted_without_an_exchange(spark):
    name = "bucketed_words"
    src.create_bucketed_table(texts(spark).select("id", "text"), name, "id", 4)
    try:
        counts = op.term_counts(spark.read.table(name), "id")
        assert "Exchange" not in executed(counts)
        assert rows(counts) == rows(op.term_counts(texts(spark), "id"))
    finally:
        src.drop_table(spark, name)
    assert "partial_count" in executed(op.term_counts(texts(spark), "id"))


def test_tfidf_values_are_those_of_the_stages(spark):
    """No two of the words share one of the 65,536 buckets, so the hashed vectors hold the same values."""
    frame = texts(spark).na.fill("", "text").withColumn("stars", F.lit("5.0"))
    stages = op.tfidf_stages(stop_words=False).fit(frame)
    hashed = {r.id: sorted(round(v, 9) for v in r.features.values if v) for r in stages.transform(frame).collect()}
    own = {}
    for r in op.tfidf_weights(frame, "id").collect():
        if r.weight:
            own.setdefault(r.id, []).append(round(r.weight, 9))
    assert {i: sorted(v) for i, v in own.items()} == {i: v for i, v in hashed.items() if v}
    found = {(r.id, r.term): r for r in op.tfidf_weights(frame, "id").collect()}
    assert found[1, "red"]["count"] == 2 and math.isclose(found[0, "blue"].weight, math.log(43 / 21)) and found[1, "rare"].weight == 0


# Fits

def test_a_finished_fit_is_flat_and_an_unfinished_one_is_not(spark):
    random_ = np.random.default_rng(1)
    data = []
    for i in range(400):
        x = random_.normal(size=3)
        data.append((float(random_.integers(0, 3) if i % 4 else int(x[0] > 0)), float(x[0]), float(x[1]), 0.0 if i % 2 else float(x[2]), 1.0 + i % 3))
    frame = op.assemble(spark.createDataFrame(data, "label double, a double, b double, c double, weight double"), ["a", "b", "c"])

    def steepest(iterations):
        model = op.fit_stars(frame, balanced=False, max_iter=iterations)
        return op.loss_gradient(model, frame).agg(F.max(F.abs("gradient"))).first()[0]

    assert steepest(200) < 1e-5 < 1e-3 < steepest(1)
    weights = op.class_weights(frame).select("label", "weight")
    weighted = frame.drop("weight").join(weights, "label")
    model = op.fit_stars(frame.drop("weight"), max_iter=200)
    parts = op.loss_gradient(model, weighted, weight_col="weight").collect()
    assert {(r["class"], r.feature) for r in parts} == {(c, f) for c in range(3) for f in (-1, 0, 1, 2)} and max(abs(r.gradient) for r in parts) < 1e-5


def vectors(spark, n=300):
    random_ = np.random.default_rng(7)
    centres = random_.normal(size=(3, 8))
    return [(i, [float(v) for v in centres[i % 3] + random_.normal(scale=0.3, size=8)], i % 3) for i in range(n)]


def test_vector_classes_are_told_apart_and_the_fit_does_not_depend_on_the_layout(spark):
    frame = spark.createDataFrame(vectors(spark), "id long, embedding array<double>, label int")
    first = op.fit_embeddings(frame.where("id < 200"))
    again = op.fit_embeddings(frame.where("id < 200").repartition(13, F.rand(5)))
    assert (first.weights == again.weights).all() and first.classes == [0, 1, 2]
    found = first.transform(frame.where("id >= 200"))
    assert found.where("prediction = label").count() >= 98


def test_the_fit_is_the_least_squares_solution(spark):
    data = vectors(spark, 120)
    model = op.fit_embeddings(spark.createDataFrame(data, "id long, embedding array<double>, label int"), ridge=0.0)
    step = max(abs(v) for _, x, _ in data for v in x) / (1 << 12)
    x = np.array([[*(np.round(np.array(v) / step) * step), 1.0] for _, v, _ in data])
    want, *_ = np.linalg.lstsq(x, np.eye(3)[[c for _, _, c in data]], rcond=None)
    assert np.allclose(model.weights, want, atol=1e-8)


def test_odd_vectors(spark):
    odd = [(1000, None, 1), (1001, [1.0] * 7 + [None], 1), (1002, [float("nan")] * 8, 2), (1003, [0.5] * 8, None)]
    schema = "id long, embedding array<double>, label int"
    clean, all_ = spark.createDataFrame(vectors(spark), schema), spark.createDataFrame(vectors(spark) + odd, schema)
    model = op.fit_embeddings(all_)
    assert (model.weights == op.fit_embeddings(clean).weights).all()
    found = {r.id: r.prediction for r in model.transform(all_).where("id >= 1000").collect()}
    assert found[1000] is found[1001] is found[1002] is None and found[1003] in (0.0, 1.0, 2.0)
    with pytest.raises(ValueError, match="no row"):
        op.fit_embeddings(clean.where("false"))
    with pytest.raises(ValueError, match="lengths"):
        op.fit_embeddings(clean.union(spark.createDataFrame([(1, [1.0], 1)], schema)))


# Draws without a key

def many(spark):
    return spark.range(0, 3000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS a", "if(id % 5 = 0, NULL, id % 4) AS b", "1.5 AS `odd.name`")


def test_draws_do_not_depend_on_the_layout(spark):
    df = many(spark)
    sample = rows(op.sample_about(df, 600, 42))
    assert 500 < len(sample) < 700 and sample == rows(op.sample_about(df.repartition(17), 600, 42)) != rows(op.sample_about(df, 600, 43))
    hot = [r for r in sample if r[0] == "hot"]
    assert 120 < len(hot) < 280  # equal rows are drawn one by one
    assert op.sample_about(df, 10**9, 42).count() == 3000


def test_drawn_parts_cover_the_rows(spark):
    df = many(spark)
    parts = op.split(df, [3, 1, 1], 7)
    assert sorted(sum((rows(p) for p in parts), []), key=repr) == rows(df) and parts[0].columns == df.columns
    train, test = op.stratified_split(df, "b", {0: 0.5, None: 1.0}, 7)
    assert rows(train.union(test)) == rows(df) and test.where("b IS NULL").count() == 0 and train.where("b = 1").count() == 0
    assert 0 < train.where("b = 0").count() < df.where("b = 0").count()


def test_runs_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RUN", 100)
    df = many(spark)
    found = sampling.numbered_rows(df, "key")
    assert rows(found.drop("key")) == rows(df) and found.select("key").distinct().count() == 3000


def test_a_column_named_like_the_key(spark):
    df = spark.range(50).withColumnRenamed("id", "_drawn_by")
    assert op.sample_about(df, 100, 1).columns == ["_drawn_by"] and op.sample_about(df, 100, 1).count() == 50


# Lines

def test_kinds_of_malformed_lines(spark, path):
    lines = ['"a"|1|x', "b|2", "c|3|y|z", "d|many|x", '"e | f"|5|"say ""|"""', "g|6", '"h|7', "i||", "j|8|"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    found = src.read_delimited_checked(spark, path, "id string, n int, t string")
    kinds = {r.id: r.bad_kind for r in found.collect()}
    assert kinds == {"a": None, "b": "short", "c": "long", "d": "bad value", "e | f": None, "g": "short", "h|7": "short", "i": None, "j": None}
    assert found.where("bad_kind = 'long'").first().bad_row == "c|3|y|z"
    assert {r.kind: r.rows for r in src.malformed_counts(found).collect()} == {"good": 4, "short": 3, "long": 1, "bad value": 1}
    plain = src.read_delimited(spark, path, "id string, n int, t string")
    assert rows(found.select("id", "n", "t")) == rows(plain)


def test_a_count_sees_the_faults_of_columns_it_does_not_use(spark, path):
    spark.createDataFrame([("a|x|1",), ("b|2|y",), ("c|3|4",)], "value string").write.text(path)
    found = src.read_delimited_checked(spark, path, "id string, n int, m int")
    assert found.where("bad_kind = 'bad value'").count() == 2 and found.groupBy("bad_kind").count().count() == 2


def test_between_missing_and_turned_names(spark):
    df = spark.createDataFrame([('{"a":"x","b":1}',), ('{"b":1,"a":"x"}',), ('{"b":1}',), (None,)], "line string")
    assert [r[0] for r in df.select(extract_between(F.col("line"), '"a', '"b')).collect()] == ["x,", "", None, None]
