"""A training corpus from raw documents, in stages that are each written and read again.

Documents that the quality classifier rejects go; of each group of near copies (SimHash of three-word shingles, linked at two bits or less) the one with the smallest doc_id stays; passages of
benchmark items are cut out; sources are mixed to their target weights, so documents may be repeated (up to three times) or left out;
the result is dealt to shards of equal size, copies of a document to the same shard as far as it has room.

Every stage takes all rows of the one before, in any order, and returns the columns of its documents; the last one adds
shard and slot. NULLs, empty texts, repeated rows and empty tables are treated as the operators say; a text that is nothing but a benchmark
passage is dropped.
"""

from pyspark.sql import functions as F

from reviewmill.llm import decontaminate, mixing, quality, sharding, simhash
from reviewmill.llm.common import stored


def _columns(df, names):
    return df.select(*[F.col("row").getField(c).alias(c) for c in names])


def keep_good(spark, docs, sf_dir):
    """Learn quality from four of five labelled documents and drop what is rejected."""
    learned = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    model = quality.train(learned, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _columns(quality.score(docs, model, keep=docs.columns).where("predicted = 1"), docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    return simhash.first_of_each(docs)


def cut_benchmarks(spark, docs, sf_dir):
    """Cut benchmark passages; n_chars follows the text."""
    cut = decontaminate.remove_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    cut = cut.where(~F.col("was_cut") | (F.length("text") > 0))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("was_cut"), F.length("text")).otherwise(F.col("row.n_chars")).cast("long")}
    return cut.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def mix_sources(spark, docs, sf_dir):
    """Repeat, keep or leave out documents so that the sources meet their target weights; in training order."""
    return _columns(mixing.training_order(mixing.curriculum_mix(docs)), docs.columns)


def deal_to_shards(spark, docs, sf_dir):
    """Deal the rows to 24 shards; equal texts are linked."""
    rows = sharding.number_rows(docs, F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), F.md5("text").alias("code"))
    placed = sharding.balanced_shards(rows, sharding.equal_text_links(rows.select("node", "code"), rows.count()))
    return placed.select("row.*", "shard", "slot")


STAGES = [
    ("keep_good", keep_good),
    ("drop_near_copies", drop_near_copies),
    ("cut_benchmarks", cut_benchmarks),
    ("mix_sources", mix_sources),
    ("deal_to_shards", deal_to_shards),
]

# No SQL: a trained classifier decides in the first stage. The stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
