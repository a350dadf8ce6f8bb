"""An FM-index over integer symbols, with a wavelet matrix for ranks and sampled suffix positions; all queries work on arrays."""

import numpy as np

SAMPLE = 16


class Ranks:
    """Ones among the first i bits."""

    def __init__(self, bits):
        n = len(bits) // 64 + 1
        padded = np.zeros(64 * n, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(n + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def __call__(self, i):
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, i):
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Rank and access for an array of symbols below ``size``."""

    def __init__(self, symbols, size):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level & 1).astype(np.uint8)
            self.levels.append(Ranks(bits))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol, i):
        """How often each symbol occurs among the first i."""
        begin, i = np.zeros(len(i), np.int64), np.asarray(i, np.int64)
        for level, ranks, zeros in zip(range(self.depth - 1, -1, -1), self.levels, self.zeros):
            one = (symbol >> level & 1).astype(bool)
            ones_begin, ones_i = ranks(begin), ranks(i)
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
            i = np.where(one, zeros + ones_i, i - ones_i)
        return i - begin

    def access(self, i):
        symbol = np.zeros(len(i), np.int64)
        for ranks, zeros in zip(self.levels, self.zeros):
            bit = ranks.get(i)
            symbol = symbol << 1 | bit
            ones = ranks(i)
            i = np.where(bit == 1, zeros + ones, i - ones)
        return symbol


def suffix_array(keys):
    """By doubling; ``keys`` are compared as integers, and a shorter suffix comes first."""
    order = np.argsort(keys, kind="stable")
    rank, n, step = np.empty(len(keys), np.int64), len(keys), 1
    changed = np.empty(n, np.int64)

    def ranked(values):
        changed[:1] = 0
        changed[1:] = values[order[1:]] != values[order[:-1]]
        rank[order] = np.cumsum(changed)
        return n == 0 or rank[order[-1]] == n - 1

    done = ranked(keys)
    while not done:
        pair = rank * (n + 1)
        pair[: n - step] += rank[step:] + 1
        order = np.argsort(pair, kind="stable")
        done = ranked(pair)
        step *= 2
    return order


class FMIndex:
    """Over segments of symbols from 1 up. Patterns are found inside segments only."""

    def __init__(self, segments, size):
        lengths = np.array([len(s) for s in segments], np.int64)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        n = int(lengths.sum()) + len(lengths)
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.starts + lengths] = False
        if len(segments):
            text[inside] = np.concatenate(segments)
        # Every separator is a key of its own, below all symbols, so that no comparison runs past a segment.
        keys = text + len(lengths)
        keys[~inside] = np.arange(len(lengths))
        order = suffix_array(keys)
        last = np.where(order > 0, text[order - 1], 0)
        self.length, self.size = n, size
        self.last = WaveletMatrix(last, size)
        self.first = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=size)[:size], out=self.first[1:])
        kept = order % SAMPLE == 0
        begins = np.zeros(n, bool)
        begins[self.starts] = True
        kept |= begins[order]
        self.sampled, self.samples = Ranks(kept.astype(np.uint8)), order[kept]

    def search(self, patterns):
        """Rows [low, high) of the suffixes that begin with each row of ``patterns``, read backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.length, np.int64)
        live = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, column]
            low[live] = self.first[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.last.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        found = np.zeros(len(patterns), bool)
        found[live] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows):
        """Text positions of suffixes: walk back to a sampled one."""
        position, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, rows = np.arange(len(rows)), rows.copy()
        while len(live):
            here = rows[live]
            hit = self.sampled.get(here) == 1
            position[live[hit]] = self.samples[self.sampled(here[hit])] + steps[live[hit]]
            live, here = live[~hit], here[~hit]
            symbol = self.last.access(here)
            rows[live] = self.first[symbol] + self.last.rank(symbol, here)
            steps[live] += 1
        return position

    def places(self, positions):
        """(segment, offset in it) of text positions."""
        segment = np.searchsorted(self.starts, positions, "right") - 1
        return segment, positions - self.starts[segment]
