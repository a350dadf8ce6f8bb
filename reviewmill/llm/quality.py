"""A quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

Random indexing: every bucket of words has a fixed sparse vector of a few +1 and -1, drawn from its number. The vector of a
word is the sum of those of its neighbours (two on each side) over the training texts, scaled to length 1, plus its own; a word never
seen in training has only its own. Words are lower-cased; next to each word stands its shape (cases, digits, signs at its end,
length, whether it repeats the word before), which has vectors of the same kind. A document is the mean of its words' vectors, the mean of its shapes' vectors and four
plain figures (length, share of different words, mean length of words, share of different pairs of words).

The network has one hidden layer and is trained with Adam; a temperature, fitted on a fifth of the training rows that the network did
not see, makes its outputs probabilities.

Training takes at most ``MAX_ROWS`` labelled rows, those with the least hash of their id, and their whole texts. The sums of the vectors come from
``FIT_TASKS`` tasks as one array each; the driver gets these and one feature vector per training row. Scoring is a narrow pass over all texts.

Edge cases: a NULL or blank text has zero means and gets a score like any other; a NULL label is not learned from; repeated rows
count as often; without both labels to learn from every score is the share of label 1, or 0.5; an empty table gives an
empty table; columns in ``keep`` may have any names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 1 << 14
WIDTH = 64
NONZERO = 4
NEAR = 2
FIGURES = 4
MAX_ROWS = 20_000
FIT_TASKS = 8
HIDDEN = 32
ACCEPT = 0.3
SLICE_BYTES = 1 << 19

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_BLANK = np.array([c in b" \t\n\r\x0b\x0c" for c in range(256)])
# Kinds of bytes: 1 capital, 2 small letter, 3 digit, 4 beyond ASCII, 0 any other sign.
_KIND = np.array([1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 if 48 <= c <= 57 else 4 if c > 127 else 0 for c in range(256)], np.uint8)
_FACTOR = 0x9E3779B97F4A7C15


def index_vectors():
    """The fixed vector of each bucket."""
    draw = np.random.default_rng(5)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for _ in range(NONZERO):
        out[np.arange(BUCKETS), draw.integers(0, WIDTH, BUCKETS)] += draw.choice([-1.0, 1.0], BUCKETS)
    return out


def _powers(n):
    """Powers of the factor and of its inverse modulo 2 ** 64."""
    def series(base):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return series(_FACTOR), series(pow(_FACTOR, -1, 1 << 64))


def _spread(code):
    code = code ^ code >> np.uint64(31)
    code = code * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ code >> np.uint64(29)


class Words:
    """Hashed words and shapes of a slice of documents."""

    def __init__(self, texts, powers):
        data = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        raw = np.frombuffer(b"".join(x for d in data for x in (b" ", d)) + b" ", np.uint8)
        blank = _BLANK[raw]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        borders = np.cumsum([len(d) + 1 for d in data])
        self.sizes = np.diff(np.searchsorted(starts, borders), prepend=0)
        power, inverse = (p[: len(raw)] for p in powers(len(raw)))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power)])
        self.code = _spread((sums[ends] - sums[starts]) * inverse[starts])
        self.length = ends - starts
        counts = []
        for kind in range(4):
            total = np.concatenate([[0], np.cumsum(_KIND[raw] == kind)])
            counts.append(total[ends] - total[starts])
        signs, capitals, small, digits = counts
        shape = np.minimum(signs, 3)
        shape = shape * 3 + np.where(capitals == 0, 0, np.where(small == 0, 2, 1))
        shape = shape * 2 + (digits > 0)
        shape = shape * 6 + np.minimum(self.length, 23) // 4
        again = np.zeros(len(starts), np.int64)
        again[1:] = (self.code[1:] == self.code[:-1]) & (self.length[1:] == self.length[:-1])
        firsts = np.cumsum(self.sizes)[:-1]
        again[firsts[firsts < len(starts)]] = 0
        shape = shape * 2 + again
        shape = shape * 256 + np.where(_KIND[raw[ends - 1]] == 0, raw[ends - 1], 0)
        self.word = (self.code & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.shape = (_spread(shape.astype(np.uint64) + np.uint64(0x51ED27)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)


def _powers_up_to():
    """Powers that grow as longer slices come."""
    held = _powers(1024)

    def get(n):
        nonlocal held
        if n > len(held[0]):
            held = _powers(1 << int(n - 1).bit_length())
        return held

    return get


def _slices(texts):
    """Slices of about ``SLICE_BYTES``; a longer text is a slice by itself."""
    start = 0
    while start < len(texts):
        end, held = start, 0
        while end < len(texts) and (end == start or held + len(texts[end] or "") <= SLICE_BYTES):
            held += len(texts[end] or "")
            end += 1
        yield texts[start:end]
        start = end


def _sum_rows(values, groups, size):
    """Sums of the rows of each group as a (size, columns) array; groups ascend."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(groups):
        first = np.flatnonzero(np.diff(groups, prepend=-1))
        out[groups[first]] = np.add.reduceat(values, first, axis=0)
    return out


def neighbour_sums(batches):
    """One array for the task: per bucket, the sum of the fixed vectors of its neighbours."""
    fixed, powers = index_vectors(), _powers_up_to()
    sums = np.zeros((BUCKETS, WIDTH), np.float64)
    for batch in batches:
        for texts in _slices(batch.column(0).to_pylist()):
            words = Words(texts, powers)
            for buckets in (words.word, words.shape):
                near = np.zeros((len(buckets), WIDTH), np.float32)
                for step in range(1, NEAR + 1):
                    same = (words.owner[step:] == words.owner[:-step])[:, None]
                    near[step:] += fixed[buckets[:-step]] * same
                    near[:-step] += fixed[buckets[step:]] * same
                order = np.argsort(buckets, kind="stable")
                sums += _sum_rows(near[order], buckets[order], BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array([sums.astype("<f4").tobytes()], pa.binary())], names=["sums"])


def _scaled(rows):
    return rows / np.maximum(1e-9, np.linalg.norm(rows, axis=1, keepdims=True))


def word_vectors(sums):
    return (_scaled(sums) + _scaled(index_vectors())).astype(np.float32)


def features(texts, vectors, powers):
    """One row per text."""
    words = Words(texts, powers)
    count, n = np.maximum(1, words.sizes), len(texts)
    out = np.zeros((n, 2 * WIDTH + FIGURES), np.float32)
    out[:, :WIDTH] = _sum_rows(vectors[words.word], words.owner, n) / count[:, None]
    out[:, WIDTH : 2 * WIDTH] = _sum_rows(vectors[words.shape], words.owner, n) / count[:, None]
    pairs = words.code + np.append(words.code[1:], np.uint64(0)) * np.uint64(_FACTOR)
    for column, codes in ((2 * WIDTH + 1, words.code), (2 * WIDTH + 3, pairs)):
        # A code differs from one document to another, so that equal ones are repeats inside a document.
        own = np.sort(codes + _spread(words.owner.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(codes + _spread(words.owner.astype(np.uint64) + np.uint64(1)), kind="stable")
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        out[:, column] = np.bincount(words.owner[order][new], minlength=n) / count
    out[:, 2 * WIDTH] = np.log1p(words.sizes)
    out[:, 2 * WIDTH + 2] = np.bincount(words.owner, words.length, minlength=n) / count
    return out


class Network:
    """Standardised inputs, one hidden layer of rectified units, one output divided by the temperature."""

    def __init__(self, mean, scale, weights, temperature=1.0):
        self.mean, self.scale, self.weights, self.temperature = mean, scale, weights, temperature

    def logits(self, rows):
        w1, b1, w2, b2 = self.weights
        return np.maximum(0, ((rows - self.mean) / self.scale) @ w1 + b1) @ w2 + b2

    def scores(self, rows):
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.temperature, -50, 50)))

    def state(self):
        return self.mean, self.scale, self.weights, self.temperature


def fit_network(rows, labels, hidden=HIDDEN, epochs=40, batch=256, rate=5e-3, decay=1e-4, seed=11):
    """Train on four fifths of the rows, fit the temperature on the rest."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(rows))
    cut = max(1, len(rows) * 4 // 5)
    train, rest = order[:cut], order[cut:] if cut < len(rows) else order
    mean, scale = rows[train].mean(0), np.maximum(1e-6, rows[train].std(0))
    x, y = ((rows[train] - mean) / scale).astype(np.float32), labels[train].astype(np.float32)
    weights = [
        (draw.standard_normal((x.shape[1], hidden)) * (2 / x.shape[1]) ** 0.5).astype(np.float32), np.zeros(hidden, np.float32),
        (draw.standard_normal(hidden) * (1 / hidden) ** 0.5).astype(np.float32), np.zeros(1, np.float32),
    ]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        turn = draw.permutation(len(x))
        pace = rate * (1 + np.cos(np.pi * epoch / epochs)) / 2
        for at in range(0, len(x), batch):
            part = turn[at : at + batch]
            inner = np.maximum(0, x[part] @ weights[0] + weights[1])
            slope = (1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3], -50, 50))) - y[part]) / len(part)
            back = slope[:, None] * weights[2] * (inner > 0)
            slopes = [x[part].T @ back + decay * weights[0], back.sum(0), inner.T @ slope + decay * weights[2], slope.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    network = Network(mean, scale, weights)
    network.temperature = fit_temperature(network.logits(rows[rest]), labels[rest])
    return network


def fit_temperature(logits, labels):
    """The divisor of the logits, 1 to 20, with the least log loss, by golden section over its logarithm."""
    def loss(t):
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    low, high, golden = 0.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _features(vectors):
    def run(batches):
        own, powers = word_vectors(vectors.value), _powers_up_to()
        for batch in batches:
            rows = np.concatenate([features(t, own, powers) for t in _slices(batch.column(0).to_pylist())]) if batch.num_rows else np.zeros((0, 1), "f4")
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary()), *batch.columns[1:]], names=["features", *batch.schema.names[1:]])

    return run


class Model:
    """Sums of the neighbours' vectors and the state of the network; without a network, a constant score."""

    def __init__(self, sums, network, constant=0.5):
        self.sums, self.network, self.constant = sums, network, constant


def train(docs, labels, label="quality", text="text", key="doc_id", max_rows=MAX_ROWS):
    """Fit on the labelled rows of ``docs``; ``labels`` has the key and the label."""
    spark = docs.sparkSession
    known = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("label"))
    count = known.count()
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("draw")), F.lit(1 << 20)) < int(min(1.0, max_rows / max(1, count)) * (1 << 20))
    chosen = F.broadcast(known.where(drawn))  # about max_rows rows of two numbers
    code = F.xxhash64(F.col(key), F.lit("order"))
    sample = stored(docs.select(key, F.coalesce(text, F.lit("")).alias("text")).join(chosen, key).select("text", "label", code.alias("code")), "sample")
    sums = np.zeros((BUCKETS, WIDTH))
    for row in sample.select("text").repartition(FIT_TASKS).mapInArrow(neighbour_sums, "sums binary").toLocalIterator():
        sums += np.frombuffer(row.sums, "<f4").reshape(BUCKETS, WIDTH)
    sums = sums.astype(np.float32)
    shared = spark.sparkContext.broadcast(sums)
    found = sample.mapInArrow(_features(shared), "features binary, label int, code long").toArrow()
    if not found.num_rows:
        return Model(sums, None)
    values = np.array(found.column("label").to_pylist(), np.float64)
    rows = np.frombuffer(b"".join(found.column("features").to_pylist()), "<f4").reshape(len(values), -1)
    order = np.lexsort((rows[:, 0], found.column("code").to_numpy()))
    if len(set(values)) < 2:
        return Model(sums, None, float(values.mean()))
    return Model(sums, fit_network(rows[order], values[order]).state())


def _score(shared, constant, kept):
    def run(batches):
        sums, state = shared.value
        own, powers = word_vectors(sums), _powers_up_to()
        network = Network(*state) if state else None
        for batch in batches:
            scores = [np.zeros(0)]
            for texts in _slices(batch.column(kept).to_pylist()):
                scores.append(network.scores(features(texts, own, powers)) if network else np.full(len(texts), constant))
            columns = [*batch.columns[:kept], pa.array(np.round(np.concatenate(scores).astype(np.float64), 6))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], "score"])

    return run


def score(docs, model, keep=("doc_id",), text="text", accept=ACCEPT):
    """``row`` (the columns in ``keep``), score and predicted (1 from ``accept`` on) of each document."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast((model.sums, model.network))  # of fixed size
    scored = rows.mapInArrow(_score(shared, model.constant, 1), schema)
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))
