"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8). Each query is run
to the end into Spark's no-op sink, once; building it (which for the models includes the training) counts. Before
that, all run once on the smallest tables, if they are there, to get the JVM warm.
"""

import json
import os
import time

from reviewmill.queries import QUERIES
from reviewmill.session import local_session

HEADLINE = [
    "join_left", "join_then_filter", "filter_then_join", "filter_then_left_join", "join_semi",
    "star_distribution", "profile_documents", "quality_counts", "strip_links",
    "json_records", "json_to_delimited", "scan_delimited", "convert_to_parquet", "scan_mergeable_table",
    "upsert_all_columns", "upsert_leaves_stars", "upsert_by_path",
    "sample_by_key", "split_by_key", "stratified_split", "balanced_classes", "overlapping_batches",
    "tokenize_texts", "normalize_texts", "word_class_counts", "sentiment_scores", "sentiment_accuracy",
    "category_reviews_scored", "category_reviews_upserted",
    "term_counts", "document_frequencies", "tfidf_features", "class_metrics", "star_predictions",
    "embedding_predictions",
]


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    if os.path.isdir(small):
        for name in HEADLINE:
            run(spark, name, small)
    seconds = {name: run(spark, name, folder) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
