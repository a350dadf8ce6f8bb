"""Hard negatives from vectors with labels, by a secondary-sort shuffle.

An anchor's positives are its best rows of the same label; a negative of a positive is a row of another label whose score is between two shares of the
positive's. Scores are integer inner products of vectors whose components are floor(256 * x).

1. Anchors in chunks meet the rows in splits, each row of a table once per chunk. From each block go its best positives per anchor, and
   the best of them over all blocks are the anchor's.
2. The blocks meet again, now with the windows of scores that the positives open. From each block go, per anchor and window, the
   first negatives inside; nothing else can be among the first of all.
3. Positives and negatives are keys of 25 bytes: anchor, score (descending), kind (positives before negatives of the same score) and id, whose order as bytes is the one
   wanted. ``repartitionAndSortWithinPartitions`` brings together and sorts those of an anchor. An iterator reads them in this order: a
   positive opens its window, a negative goes to the open windows that it is in and that are not full. It holds the windows of
   one anchor and no list of its rows.

So what is shuffled is at most (positives * negatives) keys an anchor and block, not all pairs. Blocks are of bounded size, by hash of the id, so a label or a
group of copies that holds a third of all rows is spread like any other.

Edge cases: rows with a NULL id, label or vector, or any NULL, NaN or infinite component take no part; an empty vector has score 0
with every other, shorter vectors count as filled up with zeros; repeated rows count once, and of rows of one id that differ the one with the least (label,
vector) stands; an anchor without positives and a positive without negatives give no row; a positive of negative score opens no window, one of
score 0 a window of score 0; an empty table gives an empty one; other columns are left out. Scores are exact below 2 ** 53.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored

CHUNK_ROWS = 4096
SPLIT_ROWS = 16384
SPLITS = 16
KEY = np.dtype([("anchor", ">u8"), ("falling", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1


def _pack(batches):
    for batch in batches:
        lists = batch.column(2)
        values = np.floor(256 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype("<f8")
        ends = (8 * np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(values)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["id", "label", "vector"])


def _matrix(column, width):
    parts = [np.frombuffer(v, "<f8") for v in column.to_pylist()]
    out = np.zeros((len(parts), width))
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out


def _first(scores, rows, k):
    """The k of ``rows`` (ascending) with the highest scores, ties to the earlier."""
    if len(rows) <= k:
        return rows
    values = scores[rows]
    least = np.partition(values, len(rows) - k)[len(rows) - k]
    over = rows[values > least]
    return np.concatenate([over, rows[values == least][: k - len(over)]])


def _blocks(data, anchors, width):
    """Scores of a block, some hundred anchors at a time."""
    data = data.sort_by("id")
    ids, labels, x = data.column("id").to_numpy(), data.column("label").to_numpy(), _matrix(data.column("vector"), width)
    for at in range(0, anchors.num_rows, 256):
        part = anchors.slice(at, 256)
        scores = (_matrix(part.column("query"), width) @ x.T).astype(np.int64)
        yield part, ids, labels, scores


def _positives(k, width):
    def run(data, anchors):
        found = []
        for part, ids, labels, scores in _blocks(data, anchors, width):
            for own, label, line in zip(part.column("anchor").to_numpy(), part.column("anchor_label").to_numpy(), scores):
                rows = _first(line, np.flatnonzero((labels == label) & (ids != own)), k)
                found.append((np.full(len(rows), own), ids[rows], line[rows]))
        columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else ((), (), ()))]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "id", "score"])

    return run


def _keys(anchor, score, kind, ids):
    """Packed keys as an Arrow array; signed numbers become unsigned ones of the same order."""
    out = np.empty(len(ids), KEY)
    low = np.uint64(1 << 63)
    out["anchor"], out["id"] = anchor.astype(np.int64).view(np.uint64) ^ low, ids.astype(np.int64).view(np.uint64) ^ low
    out["falling"], out["kind"] = ~(score.astype(np.int64).view(np.uint64) ^ low), kind
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(ids), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def unpacked(key):
    """(anchor, score, kind, id) of a packed key."""
    low = 1 << 63
    number = [int.from_bytes(key[a : a + 8], "big") for a in (0, 8, 17)]
    return number[0] - low, (~number[1] & (1 << 64) - 1) - low, key[16], number[2] - low


def _negatives(k, low, high, width):
    def run(data, anchors):
        found = []
        for part, ids, labels, scores in _blocks(data, anchors, width):
            for own, label, windows, line in zip(part.column("anchor").to_pylist(), part.column("anchor_label").to_numpy(), part.column("windows").to_pylist(), scores):
                other = np.flatnonzero(labels != label)
                hundred = 100 * line[other]
                rows = [_first(line, other[(low * w <= hundred) & (hundred <= high * w)], k) for w in windows]
                rows = np.unique(np.concatenate(rows))
                found.append(_keys(np.full(len(rows), own), line[rows], NEGATIVE, ids[rows]))
        keys = pa.concat_arrays(found) if found else pa.array([], pa.binary())
        return pa.Table.from_arrays([keys], names=["key"])

    return run


def _positive_keys(batches):
    for batch in batches:
        anchor, ids, score = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
        yield pa.RecordBatch.from_arrays([_keys(anchor, score, POSITIVE, ids)], names=["key"])


def _emit(k, low, high):
    def run(keys):
        now, windows = None, []
        for key, _ in keys:
            anchor, score, kind, row = unpacked(key)
            if anchor != now:
                now, windows = anchor, []
            if kind == POSITIVE:
                windows.append([row, score, 0])
                continue
            for window in windows:
                positive, best, count = window
                if count < k and low * best <= 100 * score <= high * best:
                    window[2] = count + 1
                    yield anchor, positive, count + 1, row, best, score

    return run


def _anchor_of(key):
    """A partition number (before the remainder) that spreads neighbouring ids."""
    return int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 32 & 0x7FFFFFFF


def hard_negatives(rows, asks, positives=5, negatives=3, low=50, high=95, key="vec_id", vector="embedding", label="label"):
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the rows where ``asks``, a condition on ``id``, holds.

    ``low`` and ``high`` are the least and greatest share, in percent, of the positive's score.
    """
    spark = rows.sparkSession
    wrong = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~wrong)
    packed = usable.mapInArrow(_pack, "id long, label long, vector binary").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    packed = stored(packed.select("id", "row.*"), "vectors")
    whole = packed.agg(F.count("*").alias("n"), F.count_if(asks).alias("asked"), F.max(F.octet_length("vector")).alias("bytes")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not whole.asked:
        return spark.createDataFrame([], schema)
    width, chunks = whole.bytes // 8, -(-whole.asked // CHUNK_ROWS)
    splits = max(-(-whole.n // SPLIT_ROWS), min(SPLITS, -(-whole.n // 512)))

    def number(column, n):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def copies(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def meet(anchors, solve, out):
        data = packed.withColumn("split", number("id", splits)).withColumn("chunk", copies(chunks))
        anchors = anchors.withColumn("chunk", number("anchor", chunks)).withColumn("split", copies(splits))
        return data.groupBy("chunk", "split").cogroup(anchors.groupBy("chunk", "split")).applyInArrow(solve, out)

    anchors = packed.where(asks).select(F.col("id").alias("anchor"), F.col("label").alias("anchor_label"), F.col("vector").alias("query"))
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    found = meet(anchors, _positives(positives, width), "anchor long, id long, score long")
    found = stored(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).drop("rank"), "positives")

    windows = found.groupBy("anchor").agg(F.collect_set("score").alias("windows"))  # at most ``positives`` of each
    close = meet(anchors.join(windows, "anchor"), _negatives(negatives, low, high, width), "key binary")
    keys = stored(close.union(found.mapInArrow(_positive_keys, "key binary")), "keys")
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mined = pairs.repartitionAndSortWithinPartitions(parts, _anchor_of).mapPartitions(_emit(negatives, low, high))
    return spark.createDataFrame(mined, schema, verifySchema=False)
