"""Review analytics on Spark: load, join, label, measure, upsert, sample and classify."""
