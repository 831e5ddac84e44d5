"""pickwise — Spark-native recommendation analytics.

Batch statistics, item-item similarity (latent-factor cosine, co-occurrence,
TF-IDF content), ALS user recommendations, and online re-ranking of
recommendations from a rating stream, all as DataFrame / SQL / pyspark.ml
plans that run unchanged in batch or in Structured Streaming micro-batches.
"""

__version__ = "0.1.0"
