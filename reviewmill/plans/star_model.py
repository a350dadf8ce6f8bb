"""Star-rating classifier: links out, stratified split, balanced classes, TF-IDF, logistic regression."""

from ..operators.classify import class_metrics, evaluate_f1, fit_stars, tfidf_stages
from ..operators.relational import strip_links
from ..operators.reuse import reused, staged
from ..operators.sampling import balance, stratified_split
from ..sources.catalog import overwrite_table

PREDICTION_COLUMNS = ["stars", "label", "prediction"]


def star_model(spark, reviews, table, key="review_id", seed=1, train_share=0.8, max_iter=100):
    """Fit on balanced train rows, predict balanced test rows, write them: (model, F1, class metrics).

    The balanced samples are staged, so that the many passes of the fit do not go over all reviews again.
    A sample leaves little in each of the input partitions; the rebalance merges them by their real size.
    """
    clean = strip_links(reviews.where("stars IS NOT NULL").select(key, "stars", "text").na.fill("", "text"))
    train, test = stratified_split(clean, "stars", train_share, seed, key)
    train, test = balance(train, "stars", seed + 1, key), balance(test, "stars", seed + 1, key)
    with staged(train.hint("rebalance"), "train") as train, staged(test.hint("rebalance"), "test") as test:
        features = tfidf_stages().fit(train)
        model = fit_stars(features.transform(train), max_iter=max_iter)
        with reused(model.transform(features.transform(test)).select(key, *PREDICTION_COLUMNS)) as predictions:
            f1 = evaluate_f1(predictions)
            metrics = class_metrics(predictions).collect()
            overwrite_table(predictions, table)
    return model, f1, metrics
