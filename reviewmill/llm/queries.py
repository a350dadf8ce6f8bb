"""The registered queries: each applies one operator to its whole table."""

import string

from pyspark.sql import functions as F

from . import decontaminate, html, knn, language, merkle, mixing, negatives, packing, quality, secrets, sharding, simhash, tokens
from .common import stored
from .registry import ORACLES, QUERIES, query  # noqa: F401


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _segments_sql():
    rows = ", ".join(
        f"({i}, {j}, {', '.join(f'{v!r}::DOUBLE' for v in piece)})"
        for i, knots in enumerate(mixing.CURRICULUM) for j, piece in enumerate(mixing.segments(knots))
    )
    return f"(VALUES {rows}) pieces(schedule, piece, t0, w, slope, demand0, demand1)"


_WEIGHTS = ", ".join(f"{mixing.integral(k)!r}::DOUBLE" for k in mixing.CURRICULUM)


@query(f"""
WITH sized AS (
  SELECT row_number() OVER () AS n, doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS code,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents)
, sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
, weighed AS (
  SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS schedule FROM sources)
, listed AS (SELECT *, [{_WEIGHTS}][schedule + 1] AS weight FROM weighed)
, levels AS (
  SELECT *, row_number() OVER o AS place,
         ((SELECT sum(source_size) FROM sources)::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM listed WINDOW o AS (ORDER BY most::DOUBLE / weight, source ASC NULLS LAST))
, targets AS (
  SELECT source, source_size, schedule,
         CASE WHEN l IS NULL THEN most::DOUBLE ELSE least(l * weight, most::DOUBLE) END AS target
  FROM levels, (SELECT min_by(level, place) AS l FROM levels WHERE level * weight <= most))
, placed AS (
  SELECT s.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY code, doc_id, size, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS words_before
  FROM sized s)
, passes AS (
  SELECT p.*, source_size, schedule, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes
  FROM placed p JOIN targets t ON t.source IS NOT DISTINCT FROM p.source)
, rests AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) - passes * source_size ELSE 0 END AS rest FROM passes)
SELECT doc_id, size, source_size, target, CAST(passes * size + greatest(0, least(size, rest - words_before)) AS BIGINT) AS taken,
       CAST(passes + CASE WHEN rest > 0 AND 2 * words_before + size <= 2 * rest THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM rests""")
def op10_curriculum_mixing(spark, folder):
    """The mix of all documents in training order: rows are sorted by the time of their first copy."""
    mixed = mixing.curriculum_mix(table(spark, folder, "documents"), keep=["doc_id"])
    first = mixed.select("row.doc_id", "size", "source_size", "target", "taken", "copies", F.try_element_at("times", F.lit(1)).alias("_time"))
    return first.orderBy(F.col("_time").asc_nulls_last(), "doc_id").drop("_time")


@query()
def op6_label_propagation(spark, folder):
    """Shards of all documents; equal texts are linked."""
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    nodes = sharding.number_rows(
        docs, "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5("text").alias("code"),
    )
    placed = sharding.balanced_shards(nodes, sharding.equal_text_links(nodes, nodes.count()))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op7_anchor_simhash(spark, folder):
    """Fingerprint and component of every document."""
    prints = stored(simhash.fingerprints(table(spark, folder, "documents"), keep=["doc_id"]), "prints")
    return simhash.near_duplicates(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def tokenizer_file(name="word_bpe_49k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op4_rans_tokens(spark, folder):
    """Places, lengths and checksums of all documents' ids, from the written blocks."""
    return tokens.token_table(table(spark, folder, "documents"), tokenizer_file())


@query()
def op2_fm_index_decontamination(spark, folder):
    """Words of each document inside benchmark windows, and the items they come from."""
    found = decontaminate.find_windows(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "row.doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def _crc32_sql(text):
    """The unsigned CRC-32 of a short text, by the table that its polynomial makes."""
    def entry(byte):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        return byte

    table_ = ", ".join(f"{entry(b)}::BIGINT" for b in range(256))
    step = f"xor(state >> 8, ([{table_}])[xor(state & 255, byte) + 1])"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda state, byte: {step}, 4294967295::BIGINT), 4294967295)"


def _merkle_sql(levels=4):
    """Both trees level by level: up to 16 ** levels documents a source and sources."""
    def field(value):
        return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"

    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    altered = f"coalesce({_crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0, false)"
    steps = [f"""
leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf, {leaf(f"CASE WHEN {altered} THEN {lower} ELSE text END")} AS offered FROM documents)
, numbered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves)
, a0 AS (SELECT tree, place, leaf AS node FROM numbered)
, p0 AS (SELECT *, offered AS node, '' AS proof, place AS spot FROM numbered)"""]

    def level(nodes, paths, key, n):
        """Runs of the nodes; those above; and the paths, extended where their tree has more than one node."""
        inner = "list_concat(list_slice(run, 1, spot % 16), list_slice(run, spot % 16 + 2, len(run)))"
        steps.append(f"""
, {nodes}r{n} AS (SELECT {key}, place // 16 AS place, list(node ORDER BY place) AS run, sum(count(*)) OVER (PARTITION BY {key}) AS n
  FROM {nodes}{n} GROUP BY {key}, place // 16)
, {nodes}{n + 1} AS (SELECT {key}, place, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS node FROM {nodes}r{n})
, {paths}{n + 1} AS (
  SELECT p.* REPLACE (CASE WHEN r.n > 1 THEN sha256(array_to_string(list_slice(run, 1, spot % 16), '') || p.node || array_to_string(list_slice(run, spot % 16 + 2, len(run)), '')) ELSE p.node END AS node,
         CASE WHEN r.n > 1 THEN proof || array_to_string({inner}, '') ELSE proof END AS proof, spot // 16 AS spot)
  FROM {paths}{n} p JOIN {nodes}r{n} r ON r.{key} = p.{key} AND r.place = p.spot // 16)""")

    for n in range(levels):
        level("a", "p", "tree", n)
    steps.append(f"""
, tops AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, 0 AS top FROM a{levels})
, b0 AS (SELECT top, place, node FROM tops)
, q0 AS (SELECT p.* REPLACE (t.place AS spot), t.node AS subroot, 0 AS top FROM p{levels} p JOIN tops t ON t.tree = p.tree)""")
    for n in range(levels):
        level("b", "q", "top", n)
    return f"""WITH {''.join(steps)}
SELECT doc_id, leaf, subroot, (SELECT node FROM b{levels}) AS root, sha256(proof) AS proof_sha256, q.node AS folded_root, q.node = (SELECT node FROM b{levels}) AS verified
FROM q{levels} q"""


def _held_out(parts, part):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part


@query()
def op3_bitmask_language_id(spark, folder):
    """The language of every text, learned from three of four labelled documents."""
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(~_held_out(4, 2)))
    found = language.predict(docs, model)
    return found.select("row.doc_id", "lang_pred", "score").withColumn("held_out", _held_out(4, 2))


@query()
def op5_random_indexing_quality(spark, folder):
    """The quality of every text, learned from four of five labelled documents."""
    docs = table(spark, folder, "documents")
    model = quality.train(docs.where(~_held_out(5, 0)), table(spark, folder, "labels"))
    scored = quality.score(docs, model)
    return scored.select("row.doc_id", "score", "predicted").withColumn("held_out", _held_out(5, 0))


@query()
def op1_voronoi_top_k(spark, folder):
    """The five best of all other vectors for every fiftieth."""
    vectors = table(spark, folder, "embeddings")
    return knn.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


@query()
def op8_wrapper_html_extraction(spark, folder):
    """The main text of every page, by its host's wrapper."""
    texts = html.main_texts(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op9_forest_secret_scan(spark, folder):
    """All candidates for secrets, with the forest's decision; values as digests."""
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "at", "nth", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "label", "score", "secret")


@query()
def op11_secondary_sort_negatives(spark, folder):
    """Up to three hard negatives for each of the five best positives of every fiftieth vector."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("id") % 50 == 0)


@query()
def op12_monotone_queue_packing(spark, folder):
    """The pieces of all documents in sequences of at most 2,048 ids; digests from the packed ids."""
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_file())
    return packing.pieces(packed).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


@query(_merkle_sql())
def op13_incremental_merkle(spark, folder):
    """Leaf, roots and witness digest of every document, and whether its possibly altered text still leads to the root."""
    docs = table(spark, folder, "documents")
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(altered, F.translate("text", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("text"))
    offered = merkle.leaf_digest([text if f == "text" else F.col(f) for f in merkle.FIELDS])
    found = merkle.manifest(docs, keep=["doc_id", F.unhex(offered).alias("offered")])
    found = found.select(
        "row.doc_id", *[merkle.hexed(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.hexed("siblings").cast("binary"), 256).alias("proof_sha256"),
        merkle.folded(merkle.hexed("row.offered"), F.col("places"), F.col("widths"), F.col("siblings")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
