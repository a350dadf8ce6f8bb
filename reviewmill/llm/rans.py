"""A static range asymmetric numeral system for token ids, with numpy over many interleaved lanes.

Symbol i of a block belongs to lane i mod lanes; a row is one symbol of every lane. States are 64 bits wide and give off
32 bits at a time. A block stands alone: it holds the start state and, at every checkpoint, the states and the place in
the word stream from which decoding can begin as well, with a checksum of the ids up to the next checkpoint.

Layout, little-endian: header (``HEADER``), per checkpoint (first word, crc32 of its ids), states of all checkpoints, words.
"""

import struct
import zlib

import numpy as np

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES = 1024
CHECKPOINT_ROWS = 128
# Magic, lanes, rows between checkpoints, checkpoints, ids, words, crc32 of the table, crc32 of what follows the header.
HEADER = "<4sIIIQQII"
MAGIC = b"RNS1"


class Table:
    """Frequencies of the ids, scaled to add up to 2 ** SCALE_BITS, every id that occurs having one at least."""

    def __init__(self, ids, scaled):
        self.ids = np.asarray(ids, np.int64)
        self.scaled = np.asarray(scaled, np.uint64)
        self.crc = zlib.crc32(self.ids.astype("<i8").tobytes() + self.scaled.astype("<u8").tobytes())
        size = int(self.ids.max()) + 1 if len(self.ids) else 0
        ends = np.cumsum(self.scaled)
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[self.ids], self.start[self.ids] = self.scaled, ends - self.scaled

    def lookup(self):
        """The id of each of the 2 ** SCALE_BITS slots."""
        return np.repeat(self.ids, self.scaled.astype(np.int64)).astype(np.uint32)

    @classmethod
    def of_counts(cls, ids, counts):
        order = np.argsort(np.asarray(ids, np.int64))
        ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.float64)[order]
        whole = 1 << SCALE_BITS
        if len(ids) > whole:
            raise ValueError(f"more than {whole} different ids")
        scaled = np.maximum(1, np.floor(counts / counts.sum() * whole)).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
        left = whole - int(scaled.sum()) if len(ids) else 0
        if left > 0:
            scaled[np.argmax(scaled)] += left
        while left < 0:
            largest = np.argsort(-scaled, kind="stable")
            cut = np.minimum(scaled[largest] - 1, np.maximum(1, scaled[largest] * -left // whole))
            cut = np.minimum(cut, np.maximum(0, -left - (np.cumsum(cut) - cut)))
            scaled[largest] -= cut
            left += int(cut.sum())
        return cls(ids, scaled)


def encode(ids, table, lanes=LANES, checkpoint_rows=CHECKPOINT_ROWS):
    """A block as bytes."""
    ids = np.asarray(ids, np.int64)
    lanes = max(1, min(lanes, len(ids)))
    rows = -(-len(ids) // lanes)
    freq, start = table.freq[ids], table.start[ids]
    state = np.full(lanes, LOW, np.uint64)
    words, states, places, count = [], [], [], 0
    bits, shift, low = np.uint64(32), np.uint64(SCALE_BITS), np.uint64(0xFFFFFFFF)
    room = np.uint64(31 - SCALE_BITS + 32)
    for row in range(rows - 1, -1, -1):
        f, c = freq[row * lanes : (row + 1) * lanes], start[row * lanes : (row + 1) * lanes]
        x = state[: len(f)]
        full = x >= f << room
        if full.any():
            words.append((x[full] & low).astype("<u4"))
            count += len(words[-1])
            x[full] >>= bits
        whole = x // f
        x[:] = (whole << shift) + (x - whole * f) + c
        if row % checkpoint_rows == 0:
            states.append(state.astype("<u8").tobytes())
            places.append(count)
    states.reverse()
    first = [count - p for p in reversed(places)]
    marks = b"".join(
        struct.pack("<II", p, zlib.crc32(ids[i * checkpoint_rows * lanes : (i + 1) * checkpoint_rows * lanes].astype("<u4").tobytes()))
        for i, p in enumerate(first)
    )
    body = marks + b"".join(states) + b"".join(w.tobytes() for w in reversed(words))
    return struct.pack(HEADER, MAGIC, lanes, checkpoint_rows, len(first), len(ids), count, table.crc, zlib.crc32(body)) + body


def decode(data, table, lookup, segments=None):
    """The ids of a block, or of the ``segments`` (a range of checkpoints) of it. Raises if a checksum is wrong."""
    magic, lanes, checkpoint_rows, marks, total, count, crc, body_crc = struct.unpack_from(HEADER, data)
    body = memoryview(data)[struct.calcsize(HEADER) :]
    if magic != MAGIC or crc != table.crc or zlib.crc32(body) != body_crc:
        raise ValueError("not a block of this table, or a damaged one")
    places = np.frombuffer(body, "<u4", 2 * marks).reshape(-1, 2)
    states = np.frombuffer(body, "<u8", marks * lanes, 8 * marks).reshape(marks, lanes)
    words = np.frombuffer(body, "<u4", count, 8 * marks * (1 + lanes)).astype(np.uint64)
    bits, shift, mask = np.uint64(32), np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    out = []
    for segment in segments if segments is not None else range(marks):
        begin = segment * checkpoint_rows * lanes
        end = min(total, begin + checkpoint_rows * lanes)
        ids = np.empty(end - begin, np.uint32)
        state, at = states[segment].astype(np.uint64), int(places[segment, 0])
        for row in range(0, end - begin, lanes):
            x = state[: min(lanes, end - begin - row)]
            slot = x & mask
            symbol = lookup[slot]
            ids[row : row + len(x)] = symbol
            x[:] = table.freq[symbol] * (x >> shift) + slot - table.start[symbol]
            low = x < LOW
            more = int(np.count_nonzero(low))
            if more:
                x[low] = (x[low] << bits) | words[at : at + more]
                at += more
        if zlib.crc32(ids.astype("<u4").tobytes()) != places[segment, 1]:
            raise ValueError("the ids of a segment do not have their checksum")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
