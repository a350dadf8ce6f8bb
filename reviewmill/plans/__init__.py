from .category_sentiment import category_sentiment, scored_category_reviews
from .demo_batches import demo_batches
from .dump_ingest import ingest_dump
from .star_model import star_model
