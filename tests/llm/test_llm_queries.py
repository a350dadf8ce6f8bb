"""The registered queries and the pipeline on the smallest tables, against brute force."""

import hashlib
import html
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from reviewmill.llm.queries import ORACLES, QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"
BLANK = "\x20\x09-\x0d"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(read(spark, "documents").collect(), key=lambda r: r.doc_id)


def by_id(spark, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, FOLDER).collect()}


def held_out(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


def test_top_k(spark):
    rows = read(spark, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.floor(256 * np.array([r.embedding for r in rows], float)).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        best = [j for j in np.lexsort((ids, -(x @ x[q]))) if j != q][:5]
        want |= {(int(ids[q]), n + 1, int(ids[j]), int(x[j] @ x[q])) for n, j in enumerate(best)}
    assert {tuple(r) for r in QUERIES["op1_voronoi_top_k"](spark, FOLDER).collect()} == want


def windows_of(spark):
    out = {}
    for r in read(spark, "benchmark").collect():
        words = WORDS.findall(lowered(r.text))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            out.setdefault(tuple(words[i : i + size]), set()).add(str(r.item_id))
    return out


def hits(text, windows):
    words, places, items = WORDS.findall(lowered(text)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if found := windows.get(tuple(words[i : i + size])):
                places.update(range(i, i + size))
                items |= found
    return words, places, items


def test_decontamination(spark, docs):
    found, windows = by_id(spark, "op2_fm_index_decontamination"), windows_of(spark)
    for d in docs:
        words, places, items = hits(d.text, windows)
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        r = found[d.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(words), len(places), len(items), digest, bool(places))


def test_language(spark, docs):
    found = by_id(spark, "op3_bitmask_language_id")
    assert all(r.held_out == held_out(i, 4, 2) and 0 <= r.score <= 1 for i, r in found.items())
    tested = [d for d in docs if found[d.doc_id].held_out]
    assert sum(found[d.doc_id].lang_pred == d.lang for d in tested) >= 0.95 * len(tested)


def test_tokens(spark, docs):
    from tokenizers import Tokenizer

    found, library, start = by_id(spark, "op4_rans_tokens"), Tokenizer.from_file(tokenizer_file()), 0
    for d in docs:
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        r = found[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_quality(spark):
    found = by_id(spark, "op5_random_indexing_quality")
    assert all(r.held_out == held_out(i, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    tested = [r for r in read(spark, "labels").collect() if held_out(r.doc_id, 5, 0)]
    assert sum(found[r.doc_id].predicted == r.quality for r in tested) >= 0.85 * len(tested)


def test_shards(spark, docs):
    found = by_id(spark, "op6_label_propagation")
    assert len(found) == len(docs)
    shards = {}
    for d in docs:
        r, text = found[d.doc_id], (d.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) == set(range(24)) and {len(s) for s in shards.values()} <= {8, 9}
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def fingerprint(text):
    words = re.findall(f"[^{BLANK}]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def groups(texts):
    """Least key of the component of each key."""
    keys, fps = list(texts), np.array([fingerprint(t) for t in texts.values()], np.uint64)
    least = {}
    for i in range(len(keys)):
        if i in least:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in np.flatnonzero(np.bitwise_count(fps ^ fps[todo.pop()]) <= 2).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least.update(dict.fromkeys(seen, min(keys[j] for j in seen)))
    return {k: (f"{f:016x}", least[i]) for i, (k, f) in enumerate(zip(keys, fps.tolist()))}


def test_simhash(spark, docs):
    found = by_id(spark, "op7_anchor_simhash")
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == groups({d.doc_id: d.text for d in docs})


def test_pages(spark):
    found = by_id(spark, "op8_wrapper_html_extraction", "page_id")
    pages = read(spark, "pages").collect()
    for p in pages:
        article = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        r = found[p.page_id]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == p.url


def test_secrets(spark, docs):
    found = Counter((r.doc_id, r.value_sha256) for r in QUERIES["op9_forest_secret_scan"](spark, FOLDER).collect())
    for d in docs:
        for value in re.findall(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}", d.text):
            assert found[d.doc_id, hashlib.sha256(value.encode()).hexdigest()] >= 1


def compare(spark, name, sql):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    result = con.execute(sql)
    columns = sorted(d[0] for d in result.description)
    at = [[d[0] for d in result.description].index(c) for c in columns]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(r[i] for i in at) for r in result.fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    compare(spark, name, ORACLES[name])


def test_pipeline_stages(spark, docs):
    """Each stage on its own input against a plain version; scores of the first are those of the classifier."""
    frame, columns = read(spark, "documents"), read(spark, "documents").columns
    good = by_id(spark, "op5_random_indexing_quality")
    first = corpus_pipeline.keep_good(spark, frame, FOLDER)
    assert first.columns == columns and {r.doc_id for r in first.collect()} == {i for i, r in good.items() if r.predicted}

    second = corpus_pipeline.drop_near_copies(spark, frame, FOLDER)
    assert second.columns == columns
    assert sorted(r.doc_id for r in second.collect()) == sorted({least for _, least in groups({d.doc_id: d.text for d in docs}).values()})

    windows, third = windows_of(spark), corpus_pipeline.cut_benchmarks(spark, frame, FOLDER)
    cut = {r.doc_id: r for r in third.collect()}
    assert third.columns == columns
    for d in docs:
        words, places, _ = hits(d.text, windows)
        left = [w for i, w in enumerate(words) if i not in places]
        if not places:
            assert cut[d.doc_id] == d
        elif d.doc_id in cut:
            assert WORDS.findall(lowered(cut[d.doc_id].text)) == left and not hits(cut[d.doc_id].text, windows)[1]
            assert cut[d.doc_id].n_chars == len(cut[d.doc_id].text)
        else:
            assert not left

    copies = {r.doc_id: r.copies for r in QUERIES["op10_curriculum_mixing"](spark, FOLDER).collect()}
    fourth = corpus_pipeline.mix_sources(spark, frame, FOLDER)
    assert fourth.columns == columns
    assert Counter(r.doc_id for r in fourth.collect()) == Counter({i: n for i, n in copies.items() if n})

    fifth = corpus_pipeline.deal_to_shards(spark, frame.union(frame.limit(30)), FOLDER)
    assert fifth.columns == [*columns, "shard", "slot"]
    sizes = Counter(r.shard for r in fifth.collect())
    assert sum(sizes.values()) == 230 and set(sizes.values()) <= {9, 10}


def test_pipeline_as_a_whole(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    rows = result.collect()
    assert rows and max(Counter(r.doc_id for r in rows).values()) <= 3
    windows = windows_of(spark)
    assert not any(hits(r.text, windows)[1] for r in rows)
    texts = {r.doc_id: r.text for r in rows}
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(texts) > 100


def test_pipeline_of_no_documents(spark):
    none = read(spark, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0


def test_none_of_the_queries_has_a_python_step_where_native_is_asked(spark):
    plan = QUERIES["op9_forest_secret_scan"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
