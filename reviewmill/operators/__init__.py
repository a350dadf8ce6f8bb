from .relational import (
    attach_business, broken_rows, category_reviews, in_category, mispredicted, preview,
    reviews_in_category, set_difference, stars_to_double, strip_links,
)
from .quality import distribution, exact_quantiles, profile, quality_report
from .reuse import reused, staged
from .ingest import (
    business_key_values, json_values, records_to_lines, reviews_to_lines, split_bad_records, to_delimited,
)
from .upsert import AmbiguousUpdate, upsert, upsert_table
from .sampling import balance, class_ratios, overlapping_batches, sample_about, split, stratified_split
from .sentiment import (
    SentimentModel, accuracy, normalize, right_prediction, score_job, score_sentiment, tokenize, train_sentiment,
    weak_labels, word_class_counts,
)
from .classify import (
    assemble, class_metrics, class_weights, confusion, doc_freq, embedding_features, evaluate_f1,
    f1_weighted, fit_embeddings, fit_stars, index_labels, loss_gradient, term_counts, tfidf_stages, tfidf_weights,
)
