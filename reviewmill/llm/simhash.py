"""Near duplicates by SimHash, linked through the anchor points of a covering code.

Fingerprint: bit j is set if it is set in more than half of the XXH64 hashes (seed 42) of a text's word shingles, repeats included.

Anchors: the 64 bits are the direct sum of four perfect codes, of 23, 23, 15 and 3 bits, with covering radii 3, 3, 1 and 1, so that
every point has exactly one anchor (codeword) within those radii. Two fingerprints that differ in at most two bits have a
point between them, at most one bit from either; the anchor of that point is within the covering radius plus one bit, the
threshold's share of each side, of both. So each fingerprint is copied to all anchors within that reach, 17 on average (counted), where
reaching the other side's own anchor would take 165 (counted). Anchors with one fingerprint are dropped. At the others, fingerprints meet at the points between them that belong to the anchor: at most 65 can share such
a point, and any two that do differ in at most two bits. So no anchor, however crowded, compares all its pairs, and no link is lost.

Links join distinct fingerprints; copies of a text have the same one and are counted once. Components come from stars (``graph``).

``first_of_each`` keeps one row of each component, with the same shingles and distance.

Scale: one pass over the texts, in Arrow batches; 17 rows of 16 bytes per distinct fingerprint are shuffled. A fingerprint that a
third of all documents share is one row until the last join, which Spark splits.

Edge cases: NULL or blank text has fingerprint zero, linked like any other; fewer words than a shingle are one shingle; repeated rows are
copies; a NULL doc_id takes part, and never is the smallest unless all are NULL; an empty table gives an empty table.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import stored
from .graph import components

SHINGLE = 3
SEED = 42
THRESHOLD = 2

# Fixed values: (bits, generator polynomial, covering radius) of the perfect cyclic codes, from the lowest bit up.
CODES = [(23, 0b101011100011, 3), (23, 0b101011100011, 3), (15, 0b10011, 1), (3, 0b111, 1)]

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _shingles(text, size):
    """The lower-cased words of a text with one blank between, and the hash of each shingle."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return b"", np.zeros(0, "<u8")
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - size] + 1).tolist()] if len(words) > size else [0]
    stops = ends[size - 1 :].tolist() if len(words) >= size else [len(whole)]
    digest = xxhash.xxh64_intdigest
    return whole, np.array([digest(whole[a:b], SEED) for a, b in zip(starts, stops)], "<u8")


def fingerprint(text, size=SHINGLE):
    """The fingerprint of a text as an unsigned integer."""
    hashes = _shingles(text, size)[1]
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs, text="text", size=SHINGLE, keep=()):
    """``fp`` (long) of each row next to the columns in ``keep``."""
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, size) for t in batch.column(len(keep)).to_pylist()]
            fps = pa.array(np.array(values, "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], fps], names=[*keep, "fp"])

    return docs.select(*keep, F.col(text)).mapInArrow(run, schema)


def _remainder(value, bits, poly):
    top = poly.bit_length() - 1
    for i in range(bits - 1, top - 1, -1):
        if value >> i & 1:
            value ^= poly << (i - top)
    return value


def _tables():
    """Per code: first bit, remainder of each single bit, and the error of least weight for each remainder."""
    out, first = [], 0
    for bits, poly, radius in CODES:
        single = [_remainder(1 << i, bits, poly) for i in range(bits)]
        leader = np.zeros(1 << (poly.bit_length() - 1), np.uint64)
        for weight in range(1, radius + 1):
            for places in combinations(range(bits), weight):
                at = 0
                for i in places:
                    at ^= single[i]
                leader[at] = sum(1 << i for i in places) << first
        out.append((first, single, leader))
        first += bits
    return out


TABLES = _tables()


def _remainders(points):
    out = []
    for first, single, _ in TABLES:
        total = np.zeros(points.shape, np.int64)
        for i, s in enumerate(single):
            total ^= np.where(points >> np.uint64(first + i) & np.uint64(1), s, 0)
        out.append(total)
    return out


def reach(fps):
    """The points within one bit of each fingerprint and their anchors: two arrays of 65 columns."""
    fps = np.asarray(fps, np.uint64)
    rest = _remainders(fps)
    errors = [leader[r] for (_, _, leader), r in zip(TABLES, rest)]
    home = fps.copy()
    for e in errors:
        home ^= e
    points, anchors = [fps], [home]
    for (first, single, leader), r, e in zip(TABLES, rest, errors):
        for i, s in enumerate(single):
            flip = np.uint64(1 << (first + i))
            points.append(fps ^ flip)
            anchors.append(home ^ flip ^ e ^ leader[r ^ s])
    return np.stack(points, 1), np.stack(anchors, 1)


def _pairs(first, second, names):
    columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (first, second)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _to_anchors(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 16384):
            fps = batch.column(0)[start : start + 16384].to_numpy(zero_copy_only=False).view(np.uint64)
            anchors = np.sort(reach(fps)[1], 1)
            new = np.ones(anchors.shape, bool)
            new[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
            yield _pairs(anchors[new], np.repeat(fps, new.sum(1)), ["anchor", "fp"])


def _to_points(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 16384):
            part = [batch.column(i)[start : start + 16384].to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)]
            points, anchors = reach(part[1])
            here = anchors == part[0][:, None]
            yield _pairs(points[here], np.repeat(part[1], here.sum(1)), ["point", "fp"])


def links(fps):
    """Distinct fingerprints (fp) -> links (u, v) that connect all that differ in at most two bits."""
    copies = stored(fps.select("fp").mapInArrow(_to_anchors, "anchor long, fp long"), "anchors")
    crowded = copies.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    met = copies.join(crowded, "anchor").select("anchor", "fp").mapInArrow(_to_points, "point long, fp long")
    groups = met.groupBy("point").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)  # 65 at most
    found = groups.select(F.array_min("all").alias("v"), F.explode("all").alias("u")).where("u != v")
    return found.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= THRESHOLD).distinct()


def near_duplicates(prints, key="doc_id"):
    """Stored (.., key, fp) -> also root, a fingerprint that stands for the component, and component_id, the smallest key that can
    be reached over links."""
    fps = stored(prints.groupBy("fp").agg(F.min(key).alias("first")), "fingerprints")
    roots = components(links(fps))
    known = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = stored(known, "known")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(known.join(least, "root").select("fp", "root", "component_id"), "fp")


def first_of_each(docs, key="doc_id"):
    """One row of each component: that with the smallest key, NULL last; all columns of ``docs``, whatever their names."""
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), F.col(key).alias("key"), F.struct("*").alias("row"), F.col("text").alias("text"))
    prints = stored(fingerprints(numbered, keep=["number", "key", "row"]), "prints")
    found = near_duplicates(prints.select("number", "key", "fp"), "key")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "number")
    kept = found.groupBy("root").agg(F.min(order)["number"].alias("number"))
    return prints.join(kept, "number", "left_semi").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
