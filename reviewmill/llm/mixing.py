"""Mix sources to target weights by a curriculum whose weights change over the training time.

Every source has a schedule: knots (time, weight), linear in between, over the times 0 to 1. The integral of its schedule is
a source's weight in the whole mix. Targets are the budget shared by weight, none above ``max_repeats`` times the words of
its source; what is cut off there goes to the others, by weight again. The words that a source has given by time t
follow its integrated schedule; this is inverted, so that the n-th word of a source gets the time at which it is asked
for. Documents then get the time of their middle word, and a range sort by it makes the training order.

Inside a source the order is that of md5(doc_id), the same on any cluster. A source whose target is more than its words is passed over
several times; in its last pass the document at the border of the target counts with the words before the border.

Scale: two passes over the texts, words are counted on the JVM. Running sums are taken in 4,096 buckets a source, so no source, however
large, meets in one task. Only the table of sources (one row each) is ordered as a whole.

Edge cases: a NULL or blank text has size 0 and takes 0 words; a NULL source is a source of its own, the last one; a source
without words has target 0; repeated rows each count; an empty table gives an empty table; extra columns are kept, in
``row``, whatever their names.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import prefix_sums, stored, text_size

# Weights of 5, 2 and 1 in the whole mix: the first fades, the second grows, the third has its time in the middle.
CURRICULUM = [
    [(0.0, 6.0), (1.0, 4.0)],
    [(0.0, 1.5), (1.0, 2.5)],
    [(0.0, 0.5), (0.5, 1.5), (1.0, 0.5)],
]
MAX_REPEATS = 3
BUCKET_DIGITS = 3


def integral(knots):
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def segments(knots):
    """(time, weight, slope, demand before, demand after) of each linear piece, for a demand that reaches 1."""
    total, done, out = integral(knots), 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2 / total
        out.append((t0, w0 / total, (w1 - w0) / (t1 - t0) / total, done, done + area))
        done += area
    return out


def _literal(rows):
    names = ("time", "weight", "slope", "before", "after")
    return F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, row)]) for row in rows])


def time_of(share, pieces):
    """The time at which ``share`` of a source's words has been asked for."""
    inside = F.filter(pieces, lambda p: share < p["after"])
    piece = F.coalesce(F.try_element_at(inside, F.lit(1)), F.element_at(pieces, -1))
    rest = share - piece["before"]
    root = F.sqrt(piece["weight"] * piece["weight"] + F.lit(2.0) * piece["slope"] * rest)
    return piece["time"] + F.lit(2.0) * rest / (piece["weight"] + root)


def source_targets(sizes, curriculum=CURRICULUM, max_repeats=MAX_REPEATS, budget=None):
    """(source, source_size) -> also the index of the schedule and the target.

    Sources go by code point, NULL last, and take the schedules in turn. Sorted by the multiple of their weight at which
    they reach their limit, the limited sources come first, so one pass of running sums finds the level.
    """
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(float(integral(k))) for k in curriculum])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = sizes.withColumn("schedule", (rank % len(curriculum)).cast("int"))
    table = table.withColumn("weight", F.element_at(weights, F.col("schedule") + 1))
    table = table.withColumn("limit", F.lit(max_repeats) * F.col("source_size"))
    total = F.lit(budget).cast("long") if budget is not None else F.sum("source_size").over(everything)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    spent = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    table = table.withColumn("level", (total - spent) / open_weight).withColumn("place", F.row_number().over(order))
    free = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    table = table.withColumn("level", F.min(free).over(everything)["level"])
    limit = F.col("limit").cast("double")
    target = F.when(F.col("level").isNull(), limit).otherwise(F.least(F.col("level") * F.col("weight"), limit))
    return table.select("source", "source_size", "schedule", target.alias("target"))


def curriculum_mix(docs, curriculum=CURRICULUM, max_repeats=MAX_REPEATS, budget=None, keep=None):
    """Each document with its place in the mix.

    Returns ``row`` (all columns of the document, or those in ``keep``), size, source_size, target, taken (words, repeats counted), copies (how often the
    whole document appears) and ``times``, the training time of each copy. ``budget`` is in words, by default those of
    all documents.
    """
    code = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        F.struct(*(keep or ["*"])).alias("row"), F.col("source").alias("source"), F.col("doc_id").alias("_id"), text_size(F.col("text")).alias("size"), code.alias("_code"),
    )
    bucket = F.conv(F.substring("_code", 1, BUCKET_DIGITS), 16, 10).cast("int")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = source_targets(sizes, curriculum, max_repeats, budget)
    rows = prefix_sums(rows, ["source"], bucket, ["_code", "_id", "size"], F.col("size"), "_before", targets)
    size, before, whole = F.col("size"), F.col("_before"), F.col("source_size")
    passes = F.when(whole > 0, F.floor(F.col("target") / whole)).otherwise(F.lit(0))
    rest = F.when(whole > 0, F.floor(F.col("target")) - F.col("_passes") * whole).otherwise(F.lit(0))
    rows = rows.withColumn("_passes", passes).withColumn("_rest", rest)
    taken = F.col("_passes") * size + F.greatest(F.lit(0), F.least(size, F.col("_rest") - before))
    again = (F.col("_rest") > 0) & (2 * before + size <= 2 * F.col("_rest"))
    rows = rows.withColumn("taken", taken.cast("long")).withColumn("copies", (F.col("_passes") + F.when(again, 1).otherwise(0)).cast("int"))
    pieces = F.element_at(F.array(*[_literal(segments(k)) for k in curriculum]), F.col("schedule") + 1)
    times = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda n: time_of(F.least(F.lit(1.0), (n * whole + before + size / 2) / F.col("target")), F.col("_pieces")),
    )
    return rows.withColumn("_pieces", pieces).select("row", "size", "source_size", "target", "taken", "copies", times.alias("times"))


def training_order(mixed):
    """One row per copy, range-sorted by its training time; ties by doc_id."""
    copies = mixed.select("row", F.posexplode("times").alias("copy", "time"))
    return copies.orderBy("time", F.col("row.doc_id"), "copy")
