"""Connected components of a link table."""

from pyspark.sql import functions as F

from .common import discard, stored


def _lower(edges):
    """Each link once, (u, v) with u > v."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()


def _hang(edges, both):
    """Hang the neighbours of each node on the least of them: large stars hang the larger ones, small stars the smaller ones."""
    if both:
        edges = edges.union(edges.select("v", "u"))
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("low")).select("w", F.least("w", "low").alias("low"))
    near = edges.join(least, edges.u == least.w)
    if both:
        return _lower(near.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")))
    return _lower(near.select(F.col("v").alias("u"), F.col("low").alias("v")).union(least.select(F.col("w").alias("u"), F.col("low").alias("v"))))


def components(links):
    """(u, v) links of long ids -> (node, root) for every linked node, the root being the least node of its component.

    Alternates large stars and small stars until nothing changes, in about the square of the logarithm of the nodes as rounds.
    Each round is a written table, which takes the place of the one before. A hub is a hot key of plain joins, which Spark splits.
    """
    edges, mark = stored(_lower(links), "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == mark or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        mark, before = tuple(now), edges
        edges = stored(_hang(_hang(edges, True), False), "edges")
        discard(before)
