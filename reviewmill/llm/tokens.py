"""Token ids of a corpus in binary blocks, coded by a range asymmetric numeral system (``rans``).

A corpus folder holds ``table``, the shared frequencies of all ids, and ``blocks``: Parquet rows of one block each with the ids and
lengths of its documents, in ascending order of doc_id. A block holds whole documents, about 2 ** 18 ids.

Steps: documents are range-sorted by doc_id and tokenized in one pass, in tasks that write blocks of plain ids; a second pass counts
the ids (summed in each task), a third codes the blocks. Reading back decodes each block by itself. What the driver sees is the
table, at most one row per id of the vocabulary, and nothing else.

Texts become ids as ``words`` has it, some megabytes at a time.

Edge cases: a NULL or empty text has only the end id; a NULL doc_id comes first; repeated rows each have their place; an empty table
gives an empty corpus; other columns than doc_id and text are left out.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rans
from .common import stored
from .words import Words, slices, with_end

END_ID = 1
BLOCK_IDS = 1 << 18


def _tokenize(path, end_id, block_ids):
    def run(batches):
        words, part = Words(path), TaskContext.get().partitionId()
        number, before = 0, 0
        keys, lengths, data, held = [], [], [], 0

        def block():
            nonlocal number, before, keys, lengths, data, held
            sizes = np.concatenate(lengths)
            row = {
                "part": [part], "block": [number], "before": [before], "n_ids": [held],
                "doc_id": pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(keys)),
                "lengths": pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.array(sizes)), "ids": [np.concatenate(data).tobytes()],
            }
            number, before = number + 1, before + held
            keys, lengths, data, held = [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=_BLOCK)

        for batch in batches:
            for slice_ in slices(batch, 1):
                ids, sizes = with_end(*words.ids(slice_.column(1)), end_id)
                ends = np.append(0, np.cumsum(sizes))
                # Blocks end behind the first document that fills them.
                full = np.flatnonzero(np.diff((held + ends) // block_ids)) + 1
                for n, (a, b) in enumerate(zip(np.append(0, full), np.append(full, len(sizes)))):
                    if a < b:
                        keys.append(slice_.column(0).slice(a, b - a))
                        lengths.append(sizes[a:b])
                        data.append(ids[ends[a] : ends[b]])
                        held += int(ends[b] - ends[a])
                    if n < len(full):
                        yield block()
        if keys:
            yield block()

    return run


_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
    ("doc_id", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()),
])
_PLACE = "part int, block int, before long, n_ids long, doc_id array<long>, lengths array<long>"


def _count(batches):
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for value in batch.column(0):
            got = np.bincount(np.frombuffer(value.as_buffer(), "<u4"))
            if len(got) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(got) - len(counts), np.int64)])
            counts[: len(got)] += got
    ids = np.nonzero(counts)[0]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names=["id", "n"])


def _encode(ids, scaled):
    def run(batches):
        table = rans.Table(ids, scaled)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                data = rans.encode(np.frombuffer(row.column(6)[0].as_buffer(), "<u4"), table)
                yield pa.RecordBatch.from_arrays([*row.columns[:6], pa.array([data], pa.binary())], names=[*row.schema.names[:6], "data"])

    return run


def write_corpus(docs, path, tokenizer, end_id=END_ID, block_ids=BLOCK_IDS):
    """Write the ids of all texts to the folder ``path``. ``tokenizer`` is a file of the tokenizers library."""
    spark = docs.sparkSession
    # The number of a row only splits rows of one id and text, so that these need not meet in one task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    plain = texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tokenize(tokenizer, end_id, block_ids), f"{_PLACE}, ids binary")
    plain = stored(plain, "ids", compression="zstd")
    counts = plain.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = rans.Table.of_counts([r.id for r in counts], [r.n for r in counts])
    rows = list(zip(table.ids.tolist(), table.scaled.tolist()))
    spark.createDataFrame(rows, "id long, scaled long").coalesce(1).write.parquet(f"{path}/table")
    plain.mapInArrow(_encode(table.ids, table.scaled), f"{_PLACE}, data binary").write.parquet(f"{path}/blocks", compression="none")


def _decode(ids, scaled, with_ids):
    def run(batches):
        table = rans.Table(ids, scaled)
        lookup = table.lookup()
        for batch in batches:
            for i in range(batch.num_rows):
                keys, lengths, data, first = (batch.column(c)[i] for c in range(4))
                got = rans.decode(data.as_buffer(), table, lookup).astype("<u4")
                lengths = np.asarray(lengths.values)
                ends = np.cumsum(lengths)
                bytes_ = memoryview(got).cast("B")
                parts = [bytes_[4 * a : 4 * b] for a, b in zip(ends - lengths, ends)]
                columns = [keys.values, pa.array(first.as_py() + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(ends - lengths, ends[-1:]), pa.int32()), pa.array(got.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_corpus(spark, path, with_ids=False):
    """One row per document: doc_id, start (ids before it), n_tokens, ids_crc32 and, if asked for, its ids."""
    table = spark.read.parquet(f"{path}/table").orderBy("id").collect()  # at most one row per id of the vocabulary
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = blocks.join(parts.select("part", before.alias("base")), "part").select("doc_id", "lengths", "data", (F.col("base") + F.col("before")).alias("first"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return placed.mapInArrow(_decode([r.id for r in table], [r.scaled for r in table], with_ids), schema)


def token_table(docs, tokenizer):
    """Write and read back: the documents as they are found in the files."""
    path = scratch_path(docs.sparkSession, "corpus")
    write_corpus(docs, path, tokenizer)
    return read_corpus(docs.sparkSession, path)
