"""Hard negatives, packing, the Merkle manifest and the ids they rest on, against brute force."""

import hashlib
import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import merkle, negatives, packing, words
from reviewmill.llm.queries import QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", "   \n\t", "one", "One two. Three!", "one two three", "one two three", "é" * 5_000, "word " * 9_000, "ΑΣ <|endoftext|> 日本 😀", "a.\x85b c \xa0d", None]


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


# Ids

def test_ids_are_those_of_the_library():
    texts = [*ODD, *[f"a{chr(c)}b{chr(c)}{chr(c)} {chr(c)}" for c in range(1, 0x600)], *[f"e{chr(c)}x {chr(c)}" for c in range(0x300, 0x370)], "don't 'S 'LL ''t's rex a'd9'm", "a<|startoftext|>b"]
    ids, lengths = words.Words(tokenizer_file()).ids(pa.array(texts, pa.string()))
    want = [library().encode(t or "", add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == list(itertools.chain(*want))


def test_a_small_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(words, "KNOWN_WORDS", 50)
    known, tokenizer = words.Words(tokenizer_file()), library()
    for start in range(0, 400, 40):
        texts = [" ".join(f"word{i % 60} x{i}." for i in range(start, start + 60))]
        assert known.ids(pa.array(texts))[0].tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids


def test_another_vocabulary_goes_through_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Some  text\n with blanks ", None, "é 日本"]
    ids, lengths = words.Words(path).ids(pa.array(texts))
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == list(itertools.chain(*want))


# Packing

def padding(length, size):
    return 0 if length & (length - 1) == 0 else size - length


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(5)
    for _ in range(200):
        size = int(draw.choice([4, 8, 16, 32, 50]))
        lengths = draw.integers(1, 40, draw.integers(1, 8))
        at, penalty = packing.places(draw.random(lengths.sum()) < 0.2, lengths, size, step=int(draw.integers(1, size + 1)))
        best = [0]
        for j in range(1, len(at)):
            best.append(min(best[i] + padding(int(at[j] - at[i]), size) + penalty[j] for i in range(j) if at[j] - at[i] <= size))
        edges, cost = packing.cuts(at, penalty, size)
        own = dict(zip(at.tolist(), penalty.tolist()))
        assert cost == best[-1] and edges[0] == 0 and edges[-1] == lengths.sum() and (np.diff(edges) > 0).all() and (np.diff(edges) <= size).all()
        assert cost == sum(padding(n, size) for n in np.diff(edges).tolist()) + sum(own[e] for e in edges[1:].tolist())


def test_places_prefer_documents_then_sentences():
    stop = np.zeros(300, bool)
    stop[[9, 148, 149]] = True
    at, penalty = packing.places(stop, np.array([150, 150]), size=16, step=32)
    own = dict(zip(at.tolist(), penalty.tolist()))
    assert own[0] == own[150] == own[300] == 0 and own[10] == packing.SENTENCE and own[42] == packing.INSIDE
    assert 149 not in own  # nothing but the end id would follow
    assert all(i in own for i in range(284, 300)) and max(np.diff(at)) <= 32


def check_pieces(rows, texts, size):
    """``texts``: (doc_id, text) of all documents. Every id in one piece, sequences without gaps, nothing but the documents' ids."""
    tokenizer = library()
    want = sorted((d is not None, d or 0, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for d, t in texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and {r.padded_to for r in pieces} == {at + padding(at, size)}
    found = []
    for doc, pieces in by_doc.items():
        open_ = []  # repeated rows of an id interleave, so pieces are chained by where they start
        for r in sorted(pieces, key=lambda r: (r.start, -r.length)):
            if r.start == 0:
                open_.append([r.doc_tokens, bytes(r.ids)])
                continue
            chain = next(o for o in open_ if len(o[1]) == 4 * r.start and o[0] == r.doc_tokens)
            chain[1] += bytes(r.ids)
        assert all(4 * n == len(ids) for n, ids in open_)
        found += [(doc is not None, doc or 0, ids) for _, ids in open_]
    assert sorted(found) == want
    return sum(max(r.padded_to for r in p) for p in by_sequence.values()) / sum(r.length for r in rows) - 1


def test_packed_documents_of_all_kinds(spark):
    data = [(i, t, "en", 7, 1, b"x") for i, t in enumerate(ODD)] + [(None, "no id", "en", 7, 1, b"x")]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, sequence_id long, length long, ids binary")
    rows = packing.pieces(packing.pack(frame.repartition(3), tokenizer_file(), size=64, segment=500)).collect()
    check_pieces(rows, [(d[0], d[1]) for d in data], 64)
    assert packing.pack(frame.limit(0), tokenizer_file()).count() == 0


def test_repeated_rows_are_packed_each(spark):
    frame = spark.createDataFrame([(1, "the same text. " * 30)] * 9, "doc_id long, text string").coalesce(1)
    rows = packing.pieces(packing.pack(frame, tokenizer_file(), size=128)).collect()
    assert sum(r.length for r in rows) == 9 * rows[0].doc_tokens and all(r.doc_id == 1 for r in rows)


def test_packing_query(spark):
    packed = packing.pack(read(spark, "documents"), tokenizer_file())
    rows = packing.pieces(packed).collect()
    docs = read(spark, "documents").collect()
    assert check_pieces(rows, [(d.doc_id, d.text) for d in docs], 2048) < 0.02
    found = {(r.doc_id, r.start): r for r in QUERIES["op12_monotone_queue_packing"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for r in rows:
        q = found[r.doc_id, r.start]
        assert (q.length, q.ids_crc32, q.doc_tokens, q.sequence_id, q.offset) == (r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens, r.sequence_id, r.offset)
    inside = [r for r in rows if r.start + r.length < r.doc_tokens]
    stops = packing.stop_ids(library().get_vocab())
    assert sum(bool(stops[int.from_bytes(r.ids[-4:], "little")]) for r in inside) > 0.5 * len(inside)


# Hard negatives

def mined(rows, asks, positives=5, count=3, low=50, high=95):
    """By brute force over (id, label, vector)."""
    usable = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        own = (label, np.floor(256 * np.array(vector, float)).astype("<f8").tobytes())
        usable[i] = min(usable.get(i, own), own)
    table = {i: (label, [int(x) for x in np.frombuffer(data, "<f8")]) for i, (label, data) in usable.items()}
    out = set()
    for anchor, (label, x) in table.items():
        if not asks(anchor):
            continue
        score = {i: sum(a * b for a, b in zip(x, y)) for i, (_, y) in table.items()}
        ranked = sorted((i for i in table if i != anchor), key=lambda i: (-score[i], i))
        for p in [i for i in ranked if table[i][0] == label][:positives]:
            close = [i for i in ranked if table[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]][:count]
            out |= {(anchor, p, n + 1, i, score[p], score[i]) for n, i in enumerate(close)}
    return out


def test_negatives_query(spark):
    rows = read(spark, "embeddings").collect()
    moved = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in rows]
    want = mined(moved, lambda i: i % 50 == 0)
    found = [tuple(r) for r in QUERIES["op11_secondary_sort_negatives"](spark, FOLDER).collect()]
    assert len(found) == len(set(found)) and set(found) == want and want


def test_negatives_in_small_blocks_and_odd_rows(spark, monkeypatch):
    """Few different scores make ties; chunks and splits are small; one label has a third of the rows."""
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 8)
    monkeypatch.setattr(negatives, "SPLIT_ROWS", 40)
    draw = np.random.default_rng(3)
    rows = [(int(i) - 60, int(draw.integers(0, 3)), [float(x) for x in draw.integers(-2, 4, 3) / 4]) for i in range(240)]
    rows += [(1000 + i, 0, [0.5, 0.5, 0.5]) for i in range(80)]
    rows += [(None, 1, [1.0]), (2000, None, [1.0]), (2005, 1, None), (2010, 1, [1.0, None]), (2015, 1, [float("nan")]), (2020, 1, [float("inf"), 1.0]), (2025, 1, []), (2030, 2, [0.75])]
    rows += [(2035, 1, [0.25, 0.5]), (2035, 2, [0.5, 0.5]), rows[7], rows[7]]
    frame = spark.createDataFrame([(i, label, v, 1, 2) for i, label, v in rows], "vec_id long, label int, embedding array<double>, score int, anchor int")
    want = mined(rows, lambda i: i % 5 == 0)
    found = negatives.hard_negatives(frame, F.col("id") % 5 == 0).collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want) > 500
    assert any(r.positive_score == 0 for r in found)


def test_negatives_of_nothing(spark):
    frame = spark.createDataFrame([(1, 1, [1.0]), (2, 1, [1.0])], "vec_id long, label int, embedding array<double>")
    assert negatives.hard_negatives(frame, F.col("id") == 1).count() == 0
    assert negatives.hard_negatives(frame.limit(0), F.col("id") == 1).count() == 0
    assert negatives.hard_negatives(frame, F.col("id") == 9).count() == 0


def test_keys_sort_as_wanted():
    rows = [(a, s, k, i) for a in (-5, 0, 7) for s in (-(2**40), -1, 0, 1, 2**52) for k in (0, 1) for i in (-9, 0, 3, 2**60)]
    keys = negatives._keys(*[np.array(c) for c in zip(*rows)]).to_pylist()
    assert [negatives.unpacked(k) for k in keys] == rows
    assert [negatives.unpacked(k) for k in sorted(keys)] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


# Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """(root, the siblings of each leaf, level by level)."""
    nodes, members, proofs = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        above, below = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for place in range(len(run)):
                for i in members[at + place]:
                    proofs[i] += run[:place] + run[place + 1 :]
            above.append(sha("".join(run)))
            below.append([i for m in members[at : at + 16] for i in m])
        nodes, members = above, below
    return nodes[0], proofs


def manifest_of(rows):
    """(doc_id, leaf, subroot, root, siblings) of (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    root, above = tree([below[s][0] for s in order])
    return sorted((str(x[3]), x[2], below[s][0], root, "".join(p + above[n])) for n, s in enumerate(order) for x, p in zip(sorted(sources[s], key=lambda x: x[:3]), below[s][1]))


def found_manifest(frame):
    found = merkle.manifest(frame)
    found = found.withColumn("folded", merkle.folded(merkle.hexed("leaf"), F.col("places"), F.col("widths"), F.col("siblings"))).select(
        F.col("row.doc_id").cast("string").alias("doc_id"), "folded", *[merkle.hexed(c).alias(c) for c in ("leaf", "subroot", "root", "siblings")],
    ).collect()
    assert all(r.folded == r.root for r in found)
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.siblings) for r in found)


DOCUMENT = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, n long, row string, digest binary"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "r", b"d") for r in rows], DOCUMENT)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_of_hot_and_small_sources(spark, monkeypatch, levels):
    """Small blocks make several rounds of appends; a source holds most rows, and there are more sources than a run holds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(700)] + [(1000 + i, f"s{i % 40}", None, None, "é" * i) for i in range(120)]
    rows += [(None, None, None, None, None), (5, None, "x", 1, ""), (5, "", "x", 1, "two"), (6, "", "x", 1, "two"), (7, "one", "en", 1, "alone"), (8, "ü", "en", 1, "z"), (8, "Z", "en", 1, "z")]
    assert found_manifest(documents(spark, rows).repartition(7)) == manifest_of(rows)


def test_manifest_of_ties_and_repeated_rows(spark):
    rows = [(1, "s", "en", 1, "same")] * 40 + [(1, "s", "en", 1, f"other {i}") for i in range(30)] + [(None, "s", "en", 1, f"none {i}") for i in range(20)]
    assert found_manifest(documents(spark, rows).repartition(5)) == manifest_of(rows)


def test_manifest_of_one_row_and_of_none(spark):
    row = (3, "s", "en", 1, "alone")
    (found,) = found_manifest(documents(spark, [row]))
    assert found[1] == found[2] == found[3] == leaf_of(row) and found[4] == ""
    assert merkle.manifest(documents(spark, [row]).limit(0)).count() == 0


def test_a_frontier_extends_the_witnesses_of_open_subtrees():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    frontier = merkle.Frontier(2)
    for n, leaf in enumerate(leaves, 1):
        frontier.append(leaf)
        assert [len(w) for w in frontier.witnesses] == [i < n // 16 * 16 for i in range(n)]
    assert frontier.root is None
    root, proofs = tree([x.hex() for x in leaves])
    assert frontier.finish().hex() == root
    for (place, run), proof in ((w[0], p) for w, p in zip(frontier.witnesses, proofs)):
        assert (run[: 32 * place] + run[32 * place + 32 :]).hex() == "".join(proof[: len(run) // 32 - 1])


def test_manifest_query_finds_what_was_altered(spark):
    rows = [tuple(r) for r in read(spark, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = {r[0]: r for r in manifest_of(rows)}
    texts = {str(r[0]): r[4] for r in rows}
    for r in QUERIES["op13_incremental_merkle"](spark, FOLDER).collect():
        _, leaf, subroot, root, siblings = want[str(r.doc_id)]
        altered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[str(r.doc_id)] or "")
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) == (leaf, subroot, root, sha(siblings), not altered)
        assert (r.folded_root == r.root) == r.verified
