"""Merkle manifest of a dataset with a witness for every row, by incremental witnesses.

A tree per source has the digests of its rows as leaves, in the order of doc_id; while several nodes remain, every 16 consecutive
ones (the last run: fewer, even one) become the SHA-256 of their hexadecimal digests. The subroots, in the order of the sources, make
the root in the same way.

Leaves are appended one by one to a frontier, which holds the open run of each level. A node waits in its run with the partial witnesses of
all leaves below it; when the last sibling completes the run, each of these is extended by its place in the run and the run's nodes.
Appends are aligned: ``BLOCK`` leaves fill a subtree of three levels, so a task can append a block by itself, and the roots of the blocks
are further appends, in blocks again, until a tree has one node. What a block's root gains as its witness is then attached to the
witnesses of its leaves.

Places come from a range sort of the digests by (source, doc_id, digest) and the counts of its partitions, so no source meets in one task;
a block is 4,096 digests. The texts are read once. A table with one row per partition and source, and one per block, is all that is
joined. The driver sees none of it.

Edge cases: a NULL source is a source of its own, the first one, and '' the second; NULL doc_ids come first; repeated rows
are leaves of their own, rows of one doc_id go by their digests; a lone leaf is its subroot and a lone subroot the root, both with an empty
witness; an empty table has no rows; extra columns are not part of the digests, and may be kept whatever their names.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import stored

FANOUT = 16
LEVELS = 3
BLOCK = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns):
    """SHA-256 (hexadecimal) of the fields: ``-`` for NULL, else the number of bytes, a colon and the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def digest(nodes):
    """The parent of a run of digests."""
    return hashlib.sha256(nodes.hex().encode()).digest()


def height(n):
    """Levels above ``n`` leaves, within a block."""
    levels = 0
    while n > 1 and levels < LEVELS:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


class Frontier:
    """The open runs of a growing tree of known height, and the witnesses of its leaves so far: (place, run) level by level."""

    def __init__(self, levels):
        self.open, self.witnesses, self.root = [[] for _ in range(levels)], [], None

    def append(self, leaf):
        self.witnesses.append([])
        self._push(0, leaf, range(len(self.witnesses) - 1, len(self.witnesses)))

    def _push(self, level, node, leaves):
        if level == len(self.open):
            self.root = node
            return
        self.open[level].append((node, leaves))
        if len(self.open[level]) == FANOUT:
            self._close(level)

    def _close(self, level):
        waiting, self.open[level] = self.open[level], []
        run = b"".join([node for node, _ in waiting])
        for place, (_, leaves) in enumerate(waiting):
            for leaf in leaves:
                self.witnesses[leaf].append((place, run))
        self._push(level + 1, digest(run), range(waiting[0][1].start, waiting[-1][1].stop))

    def finish(self):
        """Close the runs that no sibling will complete."""
        for level, run in enumerate(self.open):
            if run:
                self._close(level)
        return self.root


def grown(leaves, n):
    """A finished frontier over the packed digests of a block, of a tree with ``n`` leaves."""
    frontier = Frontier(height(n))
    for at in range(0, len(leaves), 32):
        frontier.append(leaves[at : at + 32])
    frontier.finish()
    return frontier


def _nth(batches):
    """Number the rows of a sorted partition within their trees."""
    last, count = None, 0
    for batch in batches:
        tree = batch.column(0)
        if not len(tree):
            continue
        codes = tree.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        nth = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        first = starts[1] if len(starts) > 1 else len(codes)
        if tree[0].as_py() == last:
            nth[:first] += count
        last, count = tree[-1].as_py(), int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=[*batch.schema.names, "nth"])


def placed(nodes, order):
    """(tree, digest, row) -> also place, the number within the tree in the given order, and n, the nodes of the tree."""
    rows = nodes.select("tree", "digest", "row", *[c.alias(f"_{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("_last"))
    keys = ["tree", *[f"_{i}" for i in range(len(order))], "_last"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("tree", "digest", "row")
    rows = rows.mapInArrow(_nth, StructType([*rows.schema, StructField("nth", _parse_datatype_string("long"))]))
    rows = stored(rows.withColumn("part", F.spark_partition_id()), "sorted")
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("_count"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_count").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("tree", "part", before.alias("_base"), F.sum("_count").over(tree).alias("n"))
    return rows.join(bases, ["tree", "part"]).select("tree", "digest", "row", (F.col("_base") + F.col("nth")).alias("place"), "n")


def _append(key, table):
    """One row for a block: its leaves in order, their rows and the root."""
    table = table.sort_by("place").combine_chunks()
    leaves = b"".join(table.column("digest").to_pylist())
    n, rows = table.column("n")[0].as_py(), table.column("row").combine_chunks()
    root = grown(leaves, n).root
    rows = pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), rows)
    columns = [pa.array([key[0].as_py()]), pa.array([key[1].as_py()]), pa.array([n]), pa.array([root], pa.binary()), pa.array([leaves], pa.binary()), rows]
    return pa.Table.from_arrays(columns, names=["tree", "block", "n", "root", "leaves", "rows"])


def _witness(batches):
    """One row per leaf of each block, its witness extended by that of the block's root."""
    for batch in batches:
        for i in range(batch.num_rows):
            tree, n, leaves, above_places, above_widths, above = (batch.column(c)[i].as_py() for c in ("tree", "n", "leaves", "places", "widths", "siblings"))
            rows = batch.column("rows")[i].values
            witnesses = grown(leaves, n).witnesses
            places = [[place for place, _ in w] + above_places for w in witnesses]
            widths = [[len(run) // 32 for _, run in w] + above_widths for w in witnesses]
            siblings = [b"".join([run[: 32 * place] + run[32 * place + 32 :] for place, run in w]) + above for w in witnesses]
            columns = [
                pa.array([tree] * len(rows)), rows, pa.array([leaves[at : at + 32] for at in range(0, len(leaves), 32)], pa.binary()),
                pa.array(places, pa.list_(pa.int32())), pa.array(widths, pa.list_(pa.int32())), pa.array(siblings, pa.binary()),
            ]
            whole = pa.RecordBatch.from_arrays(columns, names=["tree", "row", "digest", "places", "widths", "siblings"])
            for at in range(0, len(rows), 1024):
                yield whole.slice(at, 1024)



def _blocks(nodes):
    row = nodes.schema["row"].dataType.simpleString()
    schema = f"tree string, block long, n long, root binary, leaves binary, rows array<{row}>"
    return stored(nodes.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("tree", "block").applyInArrow(_append, schema), "blocks")


def _joined(below, above):
    """Append the witness columns of ``above`` to those of ``below``."""
    return [F.concat(F.col(f"{below}.{c}"), F.col(f"{above}.{c}")).alias(c) for c in ("places", "widths", "siblings")]


def grow(nodes):
    """(tree, place, n, digest, row) -> blocks with the witness of each block's root up to that of its tree, and (tree, root)."""
    blocks = _blocks(nodes)
    if blocks.where(F.col("n") > BLOCK).isEmpty():
        none = [F.array().cast("array<int>").alias("places"), F.array().cast("array<int>").alias("widths"), F.lit(b"").alias("siblings")]
        return blocks.select("*", *none), blocks.select("tree", "root")
    roots = blocks.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("digest"), F.struct("block").alias("row"))
    above, top = grow(roots)
    above = witnesses_of(above).select("tree", F.col("row.block").alias("block"), "places", "widths", "siblings")
    return blocks.join(above, ["tree", "block"]), top


def witnesses_of(blocks):
    row = blocks.schema["rows"].dataType.elementType.simpleString()
    schema = f"tree string, row {row}, digest binary, places array<int>, widths array<int>, siblings binary"
    return blocks.select("tree", "n", "leaves", "rows", "places", "widths", "siblings").mapInArrow(_witness, schema)


def manifest(docs, keep=("doc_id",), fields=FIELDS):
    """Row by row its leaf, subroot, root (binary) and witness.

    Returns ``row`` (a struct of the columns ``keep``, names or columns), leaf, subroot, root, and the witness: ``places`` (of the path in the run of each level),
    ``widths`` (of the runs) and ``siblings`` (the others of each run, level by level, as 32 bytes each).
    """
    # '' is the tree of NULL; the order of the others is that of their sources.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"), F.col("doc_id").alias("key"), F.unhex(leaf_digest([F.col(f) for f in fields])).alias("digest"), F.struct(*keep).alias("row"),
    )
    leaves = stored(leaves, "leaves")
    blocks, subroots = grow(placed(leaves, [F.col("key"), F.col("digest")]))
    sources = subroots.select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.struct("tree").alias("row"))
    tops, root = grow(placed(sources, [F.col("row.tree")]))
    tops = witnesses_of(tops).select(F.col("row.tree").alias("tree"), F.col("digest").alias("subroot"), "places", "widths", "siblings")
    tops = stored(tops.crossJoin(F.broadcast(root.select("root"))), "tops")  # the root is one row
    blocks, tops = blocks.alias("below"), tops.alias("above")
    full = blocks.join(tops, F.col("below.tree") == F.col("above.tree"))
    full = full.select("below.tree", "n", "leaves", "rows", *_joined("below", "above"))
    found = witnesses_of(full)
    return found.join(tops.select("tree", "subroot", "root"), "tree").select("row", F.col("digest").alias("leaf"), "subroot", "root", "places", "widths", "siblings")


def hexed(column):
    return F.lower(F.hex(column))


def folded(leaf, places, widths, siblings):
    """The root that a leaf (hexadecimal) and a witness lead to."""
    def cut(start, count):
        return hexed(siblings.substr((32 * start + 1).cast("int"), (32 * count).cast("int")))

    def step(state, level):
        place, others = level["places"], level["widths"] - 1
        node = F.concat(cut(state["at"], place), state["node"], cut(state["at"] + place, others - place))
        return F.struct(F.sha2(node.cast("binary"), 256).alias("node"), (state["at"] + others).alias("at"))

    start = F.struct(leaf.alias("node"), F.lit(0).alias("at"))
    return F.aggregate(F.arrays_zip(places.alias("places"), widths.alias("widths")), start, step, lambda state: state["node"])
