"""Exact top-k search by inner product as a Voronoi kNN join.

Inner products become distances by one more coordinate: a data vector x gets sqrt(M - |x|^2), M being the largest squared length, a
query q gets 0, and then |q - x|^2 = |q|^2 + M - 2 q.x. Data vectors belong to the nearest of up to ``PIVOTS`` pivots, a sample of the data;
queries to the nearest of the first few, so that a group has about ``QUERIES`` queries. From the groups' and cells' summaries
(counts and radii) follows what can be left out:

1. Each group first gets the cells nearest to it, until they hold some thousand vectors. The k-th best distance of its queries, the
   largest over the group, is the group's bound.
2. A data vector is then copied to a group only if, by the triangle inequality over both pivots, it can be within the bound.

Groups are solved in blocks: a group's queries in chunks, its data in splits by hash of the id, every chunk against every split,
with the best k of each split merged at the end. So neither a group with many queries nor a cell with a third of all rows, copies of one
vector say, meets in one task. Bounds are floating-point and widened; scores are exact.

The driver sees the pivots and one summary per cell and group, at most ``PIVOTS`` of each, and the table of which cell goes to which group,
at most ``PIVOTS`` squared small rows.

Components are floor(256 * x). Scores are exact while 2 ** 53 bounds them, as sums of doubles.

Edge cases: a vector that is NULL or holds NULL, NaN or an infinity takes no part, as query or candidate, nor does one with a NULL
id; an empty vector has score 0 with every other, and shorter vectors count as filled up with zeros; repeated rows of one id count once, the best score of each pair; fewer than k candidates give
all of them; ties go to the smaller id; empty tables give an empty table; other columns are left out.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored

PIVOTS = 512
QUERIES = 4096
SPLIT_ROWS = 16384
SPLITS = 16
FIRST_ROWS = 4096


def _usable(vector):
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong


def _matrix(column, width):
    """Packed vectors as rows, filled up with zeros."""
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    parts = [np.frombuffer(v.as_buffer(), "<f8") for v in raw]
    if all(len(p) == width for p in parts):
        return np.concatenate(parts).reshape(-1, width) if parts else np.zeros((0, width))
    out = np.zeros((len(parts), width))
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def _pack(batches):
    for batch in batches:
        lists = batch.column(2)
        values = np.floor(256 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        parts = np.split(values, ends[:-1]) if batch.num_rows else []
        packed = pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary())
        lengths = pa.array([float(p @ p) for p in parts], pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, lengths, pa.array([len(p) for p in parts], pa.int32())], names=["id", "asks", "vector", "square", "width"])


def _nearest(points, pivots, extra, pivot_extra):
    """Nearest pivot and the distance to it, in blocks."""
    cell, distance = np.zeros(len(points), np.int64), np.zeros(len(points))
    pivot_square = (pivots**2).sum(1) + pivot_extra**2
    for at in range(0, len(points), 2048):
        x, e = points[at : at + 2048], extra[at : at + 2048]
        square = np.maximum(0, ((x**2).sum(1) + e**2)[:, None] + pivot_square - 2 * (x @ pivots.T + e[:, None] * pivot_extra))
        cell[at : at + 2048] = square.argmin(1)
        distance[at : at + 2048] = np.sqrt(square.min(1))
    return cell, distance


def _place(pivots, extra, largest, groups, width):
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(2), width)
            own = np.sqrt(np.maximum(0, largest - batch.column(3).to_numpy()))
            cell, far = _nearest(x, pivots, own, extra)
            group, query_far = _nearest(x, pivots[:groups], np.zeros(len(x)), extra[:groups])
            columns = [*batch.columns[:3], pa.array(cell), pa.array(far), pa.array(group), pa.array(query_far)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "asks", "vector", "cell", "far", "grp", "query_far"])

    return run


def best(queries, query_ids, data, data_ids, k):
    """(query row, data row, score) of each query's k best ids, ties to the smaller id; ``data_ids`` must ascend, and rows of one id count as
    the best of them."""
    rows, found, scores = [], [], []
    starts = np.flatnonzero(np.append(True, data_ids[1:] != data_ids[:-1]))
    for at in range(0, len(queries), 256):
        score = queries[at : at + 256] @ data.T
        if len(starts) < len(data_ids):
            score = np.maximum.reduceat(score, starts, axis=1)
        score[query_ids[at : at + 256, None] == data_ids[starts][None, :]] = -np.inf
        least = np.partition(score, max(0, score.shape[1] - k), axis=1)[:, max(0, score.shape[1] - k)]
        for i, line in enumerate(score):
            over = np.flatnonzero(line > least[i])
            same = np.flatnonzero(line == least[i])[: k - len(over)] if np.isfinite(least[i]) else over[:0]
            hit = np.concatenate([over, same])
            rows.append(np.full(len(hit), at + i))
            found.append(starts[hit])
            scores.append(line[hit])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, found, scores))


def _solve(k, width):
    def run(data, queries):
        data = data.sort_by("id")
        ids, query_ids = data.column("id").to_numpy(), queries.column("asker").to_numpy()
        row, hit, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if len(ids) and len(query_ids):
            row, hit, score = best(_matrix(queries.column("query"), width), query_ids, _matrix(data.column("vector"), width), ids, k)
        columns = [pa.array(query_ids[row].astype(np.int64)), pa.array(ids[hit].astype(np.int64)), pa.array(score.astype(np.int64))]
        return pa.Table.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def _meet(placed, plan, sizes, k, width):
    """Solve the groups with the data that ``plan`` (cell, grp, low, high) sends them; sizes: grp -> (chunks, splits)."""
    spark = placed.sparkSession
    shape = spark.createDataFrame([(g, *s) for g, s in sizes.items()], "grp long, chunks int, splits int")
    keys = ["grp", "chunk", "split"]
    data = placed.select("id", "vector", "cell", "far").join(plan, "cell").where("far BETWEEN low AND high").join(F.broadcast(shape), "grp")
    data = data.select(
        "id", "vector", "grp", F.pmod(F.xxhash64("id"), F.col("splits")).cast("int").alias("split"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    queries = placed.where("asks").select(F.col("id").alias("asker"), F.col("vector").alias("query"), "grp").join(F.broadcast(shape), "grp")
    queries = queries.select(
        "asker", "query", F.col("grp").alias("grp"), F.pmod(F.xxhash64("asker", F.lit(7)), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"),
    )
    return data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_solve(k, width), "query_id long, vec_id long, score long")


def _ranked(found, k):
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows, asks, k, key="vec_id", vector="embedding"):
    """query_id, rank, vec_id and score of the k best for each row where ``asks`` holds."""
    spark = rows.sparkSession
    usable = rows.where(F.col(key).isNotNull() & _usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("v"))
    packed = usable.mapInArrow(_pack, "id long, asks boolean, vector binary, square double, width int")
    # Repeated rows are one; different vectors of an id stay and are told apart in ``best``.
    packed = stored(packed.groupBy("id", "vector", "square", "width").agg(F.max("asks").alias("asks")).select("id", "asks", "vector", "square", "width"), "vectors")
    whole = packed.agg(F.count("*").alias("n"), F.count_if("asks").alias("asked"), F.max("square").alias("largest"), F.max("width").alias("width")).first()
    if not whole.n or not whole.asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    drawn = packed.orderBy(F.xxhash64("id"), "id").select("vector", "square").limit(PIVOTS).toArrow()
    pivots = _matrix(drawn.column("vector"), whole.width)
    extra = np.sqrt(np.maximum(0, whole.largest - drawn.column("square").to_numpy()))
    groups = min(len(pivots), -(-whole.asked // QUERIES))
    placed = stored(packed.mapInArrow(_place(pivots, extra, whole.largest, groups, whole.width), "id long, asks boolean, vector binary, cell long, far double, grp long, query_far double"), "placed")
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    asked = placed.where("asks").groupBy("grp").agg(F.count("*").alias("n"), F.max("query_far").alias("radius")).collect()
    square = (pivots**2).sum(1) + extra**2
    between = np.sqrt(np.maximum(0, square[:, None] + square - 2 * (pivots @ pivots.T + extra[:, None] * extra)))
    counts = {c.cell: c.n for c in cells}

    def sizes(sent):
        out = {}
        for g in asked:
            n = sum(counts[c] for c in sent[g.grp])
            if n:
                out[g.grp] = (-(-g.n // QUERIES), max(-(-n // SPLIT_ROWS), min(SPLITS, -(-n // 512))))
        return out

    schema = "cell long, grp long, low double, high double"
    first, near = {}, []
    for g in asked:
        first[g.grp], n = [], 0
        for c in sorted(cells, key=lambda c: between[g.grp, c.cell]):
            if n >= FIRST_ROWS:
                break
            first[g.grp].append(c.cell)
            near.append((c.cell, g.grp, 0.0, float("inf")))
            n += c.n
    start = stored(_meet(placed, spark.createDataFrame(near, schema), sizes(first), k, whole.width), "start")

    # The k-th best score so far, as a distance; without k candidates there is no bound.
    lengths = packed.where("asks").select("id", "square").distinct()
    groups_of = placed.where("asks").select("id", "grp").distinct()
    kth = _ranked(start, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    bound = groups_of.join(lengths, "id").join(kth, "id", "left")
    reach = F.max(F.coalesce(F.sqrt(F.greatest(F.lit(0.0), F.col("square") + whole.largest - 2 * F.col("score"))), F.lit(float("inf"))))
    bounds = {r.grp: r.reach for r in bound.groupBy("grp").agg(reach.alias("reach")).collect()}
    rest, sent = [], {}
    for g in asked:
        limit = bounds[g.grp] * (1 + 1e-9) + 1e-3
        sent[g.grp] = []
        for c in cells:
            apart = float(between[g.grp, c.cell])
            low, high = apart - g.radius - limit, apart + g.radius + limit
            if c.cell not in first[g.grp] and c.radius >= low:
                rest.append((c.cell, g.grp, low, high))
                sent[g.grp].append(c.cell)
    found = start
    if rest:
        found = start.union(_meet(placed, spark.createDataFrame(rest, schema), sizes(sent), k, whole.width))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
