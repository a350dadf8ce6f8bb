"""Pack token ids into sequences of bounded length by an order-preserving dynamic programme.

The ids of the documents, each with its end id, are one stream in the order of the table. A cut between two sequences may lie behind a
document (free), behind a sentence (``SENTENCE`` tokens of penalty), or, where no such place is near, inside a sentence (``INSIDE``): every
``STEP`` ids in stretches without a better place, and anywhere in the last ``size`` ids of a segment. A sequence is padded to ``size`` ids unless its
length is a power of two. The programme finds the cuts with the least sum of padding and penalties:

    best[j] = penalty[j] + min(size - pos[j] + min over pos[i] >= pos[j] - size of (best[i] + pos[i]),  best[i] where pos[j] - pos[i] is a power of two)

The inner minimum slides over the places; a queue whose values ascend holds all that can still become it, so a place costs a
constant number of steps. Ties take the longer sequence.

Each task packs the stream of its own partition, in segments of about ``SEGMENT`` ids that end behind a document, so nothing is shuffled and a
task holds one segment. The result is one row per sequence with its ids and pieces; its number is that of the partition in the upper bits and a
count in the lower, so it is the same when a task is run again. Another division of the table into partitions gives another, equally
valid packing.

Edge cases: a NULL or empty text is its end id alone; a NULL doc_id stays NULL; a text longer than a segment is a segment; repeated
rows are packed each; an empty table gives no sequences; other columns than doc_id and text are left out.
"""

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .words import Words, slices, with_end

SIZE = 2048
END_ID = 1
SENTENCE, INSIDE = 2, 16
STEP = 32
SEGMENT = 1 << 20
STOPS = ".!?"
END_MARK = "</w>"

SCHEMA = (
    "sequence_id long, ids binary, n_ids int, padded_to int, "
    "pieces array<struct<doc_id: long, start: long, length: long, doc_tokens: long, offset: long>>"
)


def places(is_stop, lengths, size, step=STEP, sentence=SENTENCE, inside=INSIDE):
    """(positions, penalties) where the stream may be cut, 0 and its end included.

    ``is_stop`` marks ids that end a sentence, ``lengths`` are the documents' (end ids included).
    """
    ends, total = np.cumsum(lengths), len(is_stop)
    penalty = np.full(total + 1, -1, np.int64)
    penalty[1:][is_stop] = sentence
    penalty[ends - 1] = -1  # only the end id would be left behind
    penalty[0] = penalty[ends] = 0
    better = np.flatnonzero(penalty >= 0)
    more = (np.diff(better) - 1) // step
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    penalty[np.repeat(better[:-1], more) + step * nth] = inside
    tail = penalty[max(0, total - size):]
    tail[tail < 0] = inside
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def _exact(at, size):
    """For each place the places before it at a distance of a power of two below ``size``, nearest last: (edges, places)."""
    starts, ends = [], []
    for power in range(int(size).bit_length()):
        if 1 << power < size:
            before = np.searchsorted(at, at - (1 << power))
            hit = np.flatnonzero(at[before] == at - (1 << power))
            starts.append(before[hit])
            ends.append(hit)
    start, end = np.concatenate(starts), np.concatenate(ends)
    order = np.lexsort((start, end))
    return np.searchsorted(end[order], np.arange(len(at) + 1)).tolist(), start[order].tolist()


def cuts(at, penalty, size):
    """The positions of the cheapest cuts, both ends included, and their cost."""
    edges, exact = _exact(at, size)
    at, penalty = at.tolist(), penalty.tolist()
    best, back = [0] * len(at), [0] * len(at)
    queue, keys = deque(), deque()
    for j in range(1, len(at)):
        position = at[j]
        key = best[j - 1] + at[j - 1]
        while keys and keys[-1] > key:
            keys.pop()
            queue.pop()
        keys.append(key)
        queue.append(j - 1)
        while at[queue[0]] < position - size:
            queue.popleft()
            keys.popleft()
        cost, source = keys[0] + size - position, queue[0]
        for i in exact[edges[j] : edges[j + 1]]:
            if best[i] < cost:
                cost, source = best[i], i
        best[j], back[j] = cost + penalty[j], source
    path = [len(at) - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return np.array([at[i] for i in reversed(path)], np.int64), best[-1]


def _sequences(keys, ids, lengths, stops, size, first):
    """The rows of one segment."""
    edges, _ = cuts(*places(stops[ids], lengths, size), size)
    ends = np.cumsum(lengths)
    begins = np.union1d(edges[:-1], ends - lengths)
    stop = np.append(begins[1:], len(ids))
    doc, place = np.searchsorted(ends, begins, "right"), np.searchsorted(edges, begins, "right") - 1
    pieces = pa.StructArray.from_arrays(
        [keys.take(pa.array(doc)), pa.array(begins - (ends - lengths)[doc]), pa.array(stop - begins), pa.array(lengths[doc]), pa.array(begins - edges[place])],
        names=["doc_id", "start", "length", "doc_tokens", "offset"],
    )
    n, sizes = len(edges) - 1, np.diff(edges)
    parts = np.searchsorted(begins, edges[:-1])
    data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(ids)])
    padded = np.where(sizes & (sizes - 1) == 0, sizes, size).astype(np.int32)
    columns = [
        pa.array(first + np.arange(n)), data, pa.array(sizes.astype(np.int32)), pa.array(padded),
        pa.ListArray.from_arrays(pa.array(np.append(parts, len(begins)).astype(np.int32)), pieces),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["sequence_id", "ids", "n_ids", "padded_to", "pieces"])


def stop_ids(vocabulary):
    """Marks the ids at which a sentence ends: words of punctuation with a stop as their last character."""
    stops = np.zeros(max(vocabulary.values()) + 1, bool)
    stops[[i for word, i in vocabulary.items() if word.removesuffix(END_MARK)[-1:] in STOPS and word.removesuffix(END_MARK)]] = True
    return stops


def _pack(tokenizer, size, end_id, segment):
    def run(batches):
        words = Words(tokenizer)
        stops, first = stop_ids(words.tokenizer.get_vocab()), TaskContext.get().partitionId() << 32
        stops = np.append(stops, np.zeros(max(0, end_id + 1 - len(stops)), bool))
        keys, ids, lengths, held = [], [], [], 0

        def solved():
            nonlocal first, keys, ids, lengths, held
            rows = _sequences(pa.concat_arrays(keys), np.concatenate(ids), np.concatenate(lengths), stops, size, first)
            first, keys, ids, lengths, held = first + rows.num_rows, [], [], [], 0
            for at in range(0, rows.num_rows, 256):
                yield rows.slice(at, 256)

        for batch in batches:
            for part in slices(batch, 1):
                found, counts = with_end(*words.ids(part.column(1)), end_id)
                keys.append(part.column(0))
                ids.append(found)
                lengths.append(counts)
                held += len(found)
                if held >= segment:
                    yield from solved()
        if keys:
            yield from solved()

    return run


def pack(docs, tokenizer, size=SIZE, end_id=END_ID, segment=SEGMENT):
    """One row per sequence: sequence_id, its ids (little-endian 32-bit, without padding), n_ids, padded_to and its pieces in order.

    ``tokenizer`` is a file of the tokenizers library.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_pack(tokenizer, size, end_id, segment), SCHEMA)


def pieces(packed):
    """One row per piece with its own ids."""
    rows = packed.select("sequence_id", "padded_to", "ids", F.explode("pieces").alias("piece"))
    cut = F.col("ids").substr((4 * F.col("piece.offset") + 1).cast("int"), (4 * F.col("piece.length")).cast("int"))
    return rows.select("piece.*", "sequence_id", "padded_to", cut.alias("ids"))
