"""Ids of whole batches of texts by a vocabulary that tokenizes every word by itself.

Arrow splits texts at blanks and numbers the pieces; pieces of letters and at most one mark are cut by Arrow too, others by the vocabulary's own
rule. Only the different words of a batch are looked up one by one, and only those not met lately are tokenized, by the
tokenizers library. The ids of the texts are then gathered with numpy.

This holds for a file with the normalizer and the division below: no word reaches over a blank. For any other file, ``Words`` gives whole
texts to the library.
"""

import itertools
import json
import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

KNOWN_WORDS = 400_000
SLICE_BYTES = 1 << 23

# The vocabulary's own division of lower-cased text into words (fixed value); each word has its own tokens.
DIVISION = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = regex.compile(DIVISION)
# Pieces with other characters than these, or with what may be a special token, go through the library as a whole.
UNUSUAL = re.compile("[^!-~\xa0-ӿ]|<[|]")
# Marks that may end a plain piece, and letters that its lower case or normal form is not plain for.
MARKS = ".,;:!?"
RARE_LETTERS = r"[^A-Za-z\x{c0}-\x{12f}\x{131}-\x{373}\x{375}-\x{4ff}]"
# Before a piece that is to be divided; no word has this character.
DIVIDE = "\n"


def by_words(path):
    """Whether the file divides texts as stated above."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    normalizer = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in (rules["normalizer"] or {}).get("normalizers", [])]
    parts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    split = [(p["type"], p.get("pattern", {}).get("Regex"), p.get("behavior"), p.get("invert"), p.get("add_prefix_space")) for p in parts]
    return (
        normalizer == [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)]
        and split == [("Split", DIVISION, "Removed", True, None), ("ByteLevel", None, None, None, False)]
    )


def byte_characters():
    """The character that stands for each byte in a byte-level vocabulary: itself where it can be seen, else the next after 255."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


class Words:
    """Ids of texts by way of a bounded memory of words: word -> number, and the ids of all words one after another."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_words, self.characters = Tokenizer.from_file(path), by_words(path), byte_characters()
        self._forget()

    def _forget(self):
        self.known, self.pool, self.edges = {"": 0}, array("I"), array("q", [0, 0])

    def whole(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word):
        seen = word if word.isascii() else word.encode().decode("latin-1").translate(self.characters)
        return [t.id for t in self.tokenizer.model.tokenize(seen)]

    def _piece(self, piece):
        if UNUSUAL.search(piece):
            return self.whole(piece)
        return [i for word in WORDS.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()) for i in self._word(word)]

    def _numbers(self, names):
        """The number of each name, a word in lower case or ``DIVIDE`` and a piece."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        known = self.known
        for name in names:
            if name not in known:
                self.pool.extend(self._piece(name[1:]) if name[0] == DIVIDE else self._word(name))
                self.edges.append(len(self.pool))
                known[name] = len(known)
        return np.fromiter(map(known.__getitem__, names), np.int64, len(names))

    def ids(self, texts):
        """(all ids, ids per text) of an Arrow array of texts; NULL has none."""
        if not self.by_words:
            found = [self.whole(t) if t else [] for t in texts.to_pylist()]
            return np.fromiter(itertools.chain(*found), "<u4"), np.array([len(f) for f in found], np.int64)
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = split.flatten().dictionary_encode()
        pieces = numbered.dictionary
        # Most pieces are letters and at most one mark behind them; the others are divided one by one.
        letters = pc.utf8_rtrim(pieces, MARKS)
        marks = pc.subtract(pc.binary_length(pieces), pc.binary_length(letters))
        plain = pc.and_(pc.less_equal(marks, 1), pc.and_not(pc.utf8_is_alpha(letters), pc.match_substring_regex(letters, RARE_LETTERS)))
        first = pc.if_else(plain, pc.utf8_lower(letters), pc.binary_join_element_wise(DIVIDE, pieces, ""))
        second = pc.if_else(pc.and_(plain, pc.equal(marks, 1)), pc.utf8_slice_codeunits(pieces, -1), "")
        words = pa.concat_arrays([first, second]).dictionary_encode()
        numbers = self._numbers(words.dictionary.to_pylist())[_numpy(words.indices)]
        # Ids of the words, then of the pieces, then of the texts.
        pool, ends = gather(np.frombuffer(self.pool, "<u4"), np.frombuffer(self.edges, np.int64), numbers.reshape(2, -1).T.ravel())
        out, ends = gather(pool, ends[::2], _numpy(numbered.indices))
        return out, np.diff(ends[np.append(0, np.cumsum(_numpy(split.value_lengths())))])


def _numpy(column):
    return column.to_numpy(zero_copy_only=False)


def gather(pool, edges, order):
    """The runs of ``pool`` between ``edges`` in the given order, and the edges of the result."""
    lengths = np.diff(edges)[order]
    ends = np.append(0, np.cumsum(lengths))
    return pool[np.repeat(edges[:-1][order] - ends[:-1], lengths) + np.arange(ends[-1])], ends


def slices(batch, column):
    """Parts of a batch with some megabytes of text each, or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    edges = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), batch.num_rows] if batch.num_rows else [0]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def with_end(ids, lengths, end_id):
    """The same with ``end_id`` after each text."""
    ends = np.cumsum(lengths + 1)
    out = np.empty(len(ids) + len(lengths), "<u4")
    is_end = np.zeros(len(out), bool)
    is_end[ends - 1] = True
    out[is_end], out[~is_end] = end_id, ids
    return out, lengths + 1
