"""Language identification with language-bitmask n-gram filters.

Model: a bit-sliced Bloom filter. Each of its ``SLOTS`` slots holds one bit per language; an n-gram sets its languages' bits in
``HASHES`` slots. The AND of an n-gram's slots is the mask of all languages that hold it, false positives
included. A language holds an n-gram that is not much rarer in it than in any other language.

Prediction: masks of all n-grams of the whole text are counted per language, and each count is corrected for the language's false
positives, whose rate is the share of its bits that are set, to the power of the hashes: of n n-grams, c found, the
expected number of true ones is (c - n * rate) / (1 - rate). The language with the highest corrected count wins; the score is
its share of all corrected counts.

N-grams are four characters of the lower-cased text, all but letters made one blank, whose second character is a letter: one for
each letter, so short words count too.

Training takes at most ``MAX_ROWS`` rows per language, those with the least hash of their id. Counts are summed in each task and per n-gram after a
shuffle; the driver gets the slots, ``SLOTS`` at most. A pass over the texts with numpy predicts; nothing is shuffled.

Edge cases: a NULL text and one without a letter are ``und`` with score 0; a text whose n-grams are all unknown gets the most
frequent language with score 0; without a row to learn from all texts are ``und``; repeated rows count as often in training;
an empty table gives an empty table; columns in ``keep`` may have any names.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored

SIZE = 4
SLOTS = 1 << 21
HASHES = 3
MAX_ROWS = 4000
RARER = 8  # a language does not hold an n-gram that is this many times rarer than in another one
UNKNOWN = "und"

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _letters():
    """For each code point: 1 for a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], np.bool_)


def ngrams(texts, letters):
    """64-bit codes of the n-grams of all texts and how many each text has."""
    points = np.frombuffer("\n ".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower case may lengthen a text, so texts are told apart by line ends, of which a text has none of its own. These and the
    # blank after them are kept, so no n-gram reaches into another text.
    is_letter, border = letters[points], points == 10
    keep = is_letter | border
    keep[1:] |= is_letter[:-1] | border[:-1]
    text_of = np.cumsum(border)[keep] - 1
    symbols = np.where(is_letter, points, 0)[keep].astype(np.uint64)
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    padded = np.zeros(n + SIZE, np.uint64)
    padded[1 : n + 1] = symbols
    code = np.zeros(n, np.uint64)
    for i in range(SIZE):
        code += padded[i : i + n] * _MIX[i]
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    code ^= code >> np.uint64(32)
    whole = symbols > 0
    return code[whole], np.bincount(text_of[whole], minlength=len(texts))


def _clean(text):
    return text.replace("\n", " ") if text else ""


def slots_of(code):
    """The slots of each code, one array per hash."""
    step = code >> np.uint64(40) | np.uint64(1)
    return [((code + np.uint64(i) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


def _count(batches):
    letters = _letters()
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
        for start in range(0, len(texts), 1024):
            part = [_clean(t) for t in texts[start : start + 1024]]
            codes, sizes = ngrams(part, letters)
            owner = np.repeat(langs[start : start + 1024], sizes)
            for lang in np.unique(owner):
                found, n = np.unique(codes[owner == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), lang, np.int32)), pa.array(n)], names=["code", "number", "n"])


def _slots(batches):
    for batch in batches:
        codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for slots in slots_of(codes):
            yield pa.RecordBatch.from_arrays([pa.array(slots), *batch.columns[1:]], names=["slot", *batch.schema.names[1:]])


class Filter:
    """``words``: arrays of one 64-bit word of language bits per slot; ``rates``: false positives of each language."""

    def __init__(self, names, words):
        self.names, self.words = names, words
        bits = [words[i // 64] >> np.uint64(i % 64) & np.uint64(1) for i in range(len(names))]
        self.rates = np.array([(b.mean()) ** HASHES for b in bits])

    def predict(self, texts, letters):
        """(names, scores)"""
        codes, sizes = ngrams(texts, letters)
        slots, ends = slots_of(codes), np.cumsum(sizes)
        counts = np.zeros((len(texts), len(self.names)))
        for w, words in enumerate(self.words):
            mask = words[slots[0]]
            for s in slots[1:]:
                mask &= words[s]
            for i in range(64 * w, min(64 * w + 64, len(self.names))):
                total = np.concatenate([[0], np.cumsum(mask >> np.uint64(i - 64 * w) & np.uint64(1))])
                counts[:, i] = total[ends] - total[ends - sizes]
        true = np.maximum(0.0, (counts - sizes[:, None] * self.rates) / np.maximum(1e-9, 1 - self.rates))
        all_ = true.sum(1)
        best = true.argmax(1)
        scores = np.where(all_ > 0, true[np.arange(len(texts)), best] / np.where(all_ > 0, all_, 1), 0.0)
        return [self.names[b] if n else UNKNOWN for b, n in zip(best, sizes)], np.where(sizes > 0, scores, 0.0)


def train(docs, lang="lang", text="text", key="doc_id", max_rows=MAX_ROWS):
    """A filter from the labelled rows of ``docs``, or None if there are none."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = rows.groupBy(F.col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").collect()
    if not sizes:
        return None
    names = [r.lang for r in sizes]
    numbers = docs.sparkSession.createDataFrame([(r.lang, i, min(1.0, max_rows / r["count"])) for i, r in enumerate(sizes)], "lang string, number int, share double")
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("draw")), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    numbers = F.broadcast(numbers)  # one row per language
    sample = rows.select(key, F.col(text).alias("text"), F.col(lang).alias("lang")).join(numbers, "lang").where(drawn)
    counts = sample.select("text", "number").mapInArrow(_count, "code long, number int, n long").groupBy("code", "number").agg(F.sum("n").alias("n"))
    counts = stored(counts, "ngrams")
    total = counts.groupBy("number").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(total), "number").withColumn("share", F.col("n") / F.col("total"))
    most = F.max("share").over(Window.partitionBy("code"))  # at most one row per language
    held = share.withColumn("most", most).where(F.col("share") * RARER >= F.col("most"))
    word, bit = F.expr("int(number div 64)"), F.expr("shiftleft(1L, number % 64)")
    masks = held.groupBy("code", word.alias("word")).agg(F.bit_or(bit).alias("mask"))
    slots = masks.mapInArrow(_slots, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    words = [np.zeros(SLOTS, np.uint64) for _ in range(-(-len(names) // 64))]
    found = slots.toArrow()  # at most SLOTS rows per 64 languages
    at, which, masks = (found.column(c).to_numpy() for c in ("slot", "word", "mask"))
    for w, out in enumerate(words):
        out[at[which == w]] = masks[which == w].view(np.uint64)
    return Filter(names, words)


def _predict(model, kept):
    def run(batches):
        filter_, letters = Filter(*model.value) if model.value else None, _letters()
        for batch in batches:
            names, scores, texts, start = [], [], batch.column(kept).to_pylist(), 0
            while start < len(texts):
                end, held = start, 0
                while end < len(texts) and (held < 1 << 21 or end == start):
                    held += len(texts[end] or "")
                    end += 1
                part = [_clean(t) for t in texts[start:end]]
                got = filter_.predict(part, letters) if filter_ else ([UNKNOWN] * len(part), np.zeros(len(part)))
                names += got[0]
                scores.append(got[1])
                start = end
            columns = [*batch.columns[:kept], pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], "lang_pred", "score"])

    return run


def predict(docs, model, keep=("doc_id",), text="text"):
    """``row`` (the columns in ``keep``), lang_pred and score of each document."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    schema = rows.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.words) if model else None)  # 8 * SLOTS bytes per 64 languages
    return rows.mapInArrow(_predict(shared, 1), schema)
