"""Benchmark decontamination with an FM-index for each training shard.

A window is ten consecutive words of a benchmark item, or all words of a shorter one. A shard is what a task holds of its documents
at a time, about a million symbols. Its word sequences are indexed (``fmindex``); all windows are searched backwards through the
ranks of a wavelet matrix, their occurrences located by sampled suffix positions, and overlapping ones merged into spans.

The alphabet of the index are the words of the benchmark: any other word cannot be in an occurrence and ends a segment, and segments
shorter than the shortest window are left out. That loses no occurrence.

Scale: one narrow pass over the documents, nothing is shuffled. The benchmark is the stated query set; it is taken in blocks of about
``BLOCK_BYTES`` of text (or one item), one after another: a block's texts are broadcast, the tasks make its windows, and the pass over the
documents is written before the next block is read. So neither the driver nor a task ever holds more than one block, whose windows take about
85 times its text, and a larger benchmark costs more passes.

Edge cases: a NULL or blank text has no words and no spans; a NULL or blank item has no windows; an item with NULL as its id marks words but is not
listed; repeated items are listed once; repeated rows are each searched; an empty table on either side gives no spans;
the columns in ``keep`` may have any names.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import stored
from .fmindex import FMIndex

WINDOW = 10
BLOCK_BYTES = 1 << 20
SHARD_SYMBOLS = 1 << 20

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPANS = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def words(text):
    """Words as bytes: digits, letters and everything beyond ASCII, with A to Z lowered."""
    return text.encode("utf-8").translate(_WORDS).split() if text else []


class Windows:
    """The windows of some items: an alphabet and, per length, arrays of patterns with their items."""

    def __init__(self, items, window=WINDOW):
        self.alphabet, self.ids, found = {}, [], {}
        for item_id, text in items:
            symbols = [self.alphabet.setdefault(w, len(self.alphabet) + 1) for w in words(text)]
            self.ids.append(None if item_id is None else str(item_id))
            size = min(window, len(symbols))
            for i in range(len(symbols) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(symbols[i : i + size]), set()).add(len(self.ids) - 1)
        self.size = len(self.alphabet) + 1
        self.shortest = min(found, default=0)
        self.patterns = {size: (np.array(list(p), np.int64), [sorted(v) for v in p.values()]) for size, p in found.items()}

    def symbols(self, text):
        """(symbols of the text's words, 0 for a word of no item)."""
        found = words(text)
        get = self.alphabet.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))


def segments(symbols, shortest):
    """(start, end) of the runs of known words that could hold a window."""
    known = np.zeros(len(symbols) + 2, np.int8)
    known[1:-1] = symbols > 0
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    return starts[long], ends[long]


def occurrences(texts, windows):
    """Index the texts and find all windows: a list of (words, merged spans, items) per text."""
    out, pieces, owners, offsets = [], [], [], []
    for number, text in enumerate(texts):
        symbols = windows.symbols(text) if windows.shortest else np.zeros(len(words(text)), np.int64)
        out.append([len(symbols), [], []])
        if windows.shortest:
            for a, b in zip(*segments(symbols, windows.shortest)):
                pieces.append(symbols[a:b])
                owners.append(number)
                offsets.append(a)
    if not pieces:
        return out
    index = FMIndex(pieces, windows.size)
    owners, offsets = np.array(owners), np.array(offsets)
    texts_hit, begins, ends, listed = [], [], [], set()
    for size, (patterns, items) in windows.patterns.items():
        low, high = index.search(patterns)
        counts = high - low
        which = np.repeat(np.arange(len(patterns)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        segment, offset = index.places(index.locate(rows))
        texts_hit.append(owners[segment])
        begins.append(offsets[segment] + offset)
        ends.append(begins[-1] + size)
        pairs = np.unique(np.stack([owners[segment], which]), axis=1)
        listed.update((text, i) for text, p in pairs.T.tolist() for i in items[p])
    texts_hit, begins, ends = map(np.concatenate, (texts_hit, begins, ends))
    order = np.lexsort((begins, texts_hit))
    for text, a, b in zip(texts_hit[order].tolist(), begins[order].tolist(), ends[order].tolist()):
        spans = out[text][1]
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    for text, i in sorted(listed):
        if windows.ids[i] is not None:
            out[text][2].append(windows.ids[i])
    return out


def _shards(batches, texts, windows):
    """Slices of the batches, each with about a shard of symbols."""
    for batch in batches:
        start, held = 0, 0
        sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(texts)]
        for i, size in enumerate(sizes):
            held += size // 6
            if held >= SHARD_SYMBOLS or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0


def _merge(old, new):
    spans = []
    for a, b in sorted(old + new):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    return spans


_SPAN = pa.list_(pa.list_(pa.int32()))


def _find(items, window, kept):
    def run(batches):
        windows = Windows(items.value, window)
        for shard in _shards(batches, kept, windows):
            found = occurrences(shard.column(kept).to_pylist(), windows)
            before = list(zip(shard.column(kept + 2).to_pylist(), shard.column(kept + 3).to_pylist()))
            yield pa.RecordBatch.from_arrays([
                *shard.columns[: kept + 1],
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([_merge(s, f[1]) for (s, _), f in zip(before, found)], _SPAN),
                pa.array([sorted({*i, *f[2]}) for (_, i), f in zip(before, found)], pa.list_(pa.string())),
            ], names=shard.schema.names)

    return run


class Blocks:
    """A benchmark in blocks of bounded text, read one at a time."""

    def __init__(self, benchmark, window):
        self.items, self.window = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct(), window
        self.count = -(-(self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES)

    def passed(self, rows, step):
        """``rows`` after ``step(items, window, 1)`` for each block. With several blocks each pass is written."""
        for block in range(self.count):
            part = self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count)) == block)
            items = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])  # a block of bounded size
            rows = rows.mapInArrow(step(items, self.window, 1), rows.schema)
            if self.count > 1:
                rows = stored(rows, "pass")
                items.destroy()
        return rows


def find_windows(docs, benchmark, keep=("doc_id",), window=WINDOW):
    """``row`` (the columns in ``keep``), text, n_words, spans ([begin, end) in words, merged) and items."""
    rows = docs.select(
        F.struct(*keep).alias("row"), F.col("text").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<int>>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    blocks = Blocks(benchmark, window)
    if not blocks.count:
        return rows.mapInArrow(_find(docs.sparkSession.sparkContext.broadcast([]), window, 1), rows.schema)
    return blocks.passed(rows, _find)


def cut(text, spans):
    """The text without the words of the spans and what is between them."""
    places = [m.span() for m in _SPANS.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]].rstrip())
        at = places[b - 1][1]
    return "\n".join(p for p in (x.strip() for x in [*out, text[at:]]) if p)


def _cut(items, window, kept):
    def run(batches):
        windows = Windows(items.value, window)
        for shard in _shards(batches, kept, windows):
            texts = shard.column(kept).to_pylist()
            left, changed = list(range(len(texts))), set()
            while left:  # what a cut brings together may be a window again
                found = occurrences([texts[i] for i in left], windows)
                left = [i for i, f in zip(left, found) if f[1]]
                for i, f in zip(left, [f for f in found if f[1]]):
                    texts[i] = cut(texts[i], f[1])
                changed.update(left)
            before = shard.column(kept + 1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                *shard.columns[:kept], pa.array(texts, pa.string()), pa.array([b or i in changed for i, b in enumerate(before)], pa.bool_()),
            ], names=shard.schema.names)

    return run


def remove_windows(docs, benchmark, window=WINDOW):
    """``row`` (all columns), the text without any window of the benchmark, and whether it was cut."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), F.lit(False).alias("was_cut"))
    blocks = Blocks(benchmark, window)
    rows = blocks.passed(rows, _cut)
    while blocks.count > 1:  # a cut for one block may bring a window of another together
        again = rows.select(F.struct("row", "was_cut").alias("row"), "text", F.lit(False).alias("was_cut"))
        again = blocks.passed(again, _cut)
        rows = again.select(F.col("row.row").alias("row"), "text", (F.col("row.was_cut") | F.col("was_cut")).alias("was_cut"))
        if again.where("was_cut").isEmpty():
            break
    return rows
