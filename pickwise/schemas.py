"""Canonical schemas and the fixed constants of the recommendation pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference application's for equal results.
# ---------------------------------------------------------------------------
USER_MAX_RECOMMENDATION = 20      # top-k of the offline per-user list
MAX_SIM_PRODUCTS_NUM = 20         # candidates taken from the neighbour list online
MAX_USER_RATING_NUM = 20          # recent ratings asked for online (inclusive range -> 21 rows)
RECENT_ROWS = MAX_USER_RATING_NUM + 1
RATING_QUEUE_SIZE = 40            # per-user recent-ratings queue bound
SIM_THRESHOLD = 0.4               # strict ">" threshold on similarities
SIM_DIGITS = 10                   # similarities are rounded to this many digits before the threshold
HIGH_SCORE_CUTOFF = 3.0           # recent score > 3 boosts, <= 3 penalises
RATING_PREFIX = "PRODUCT_RATING_PREFIX"
ALS_RANK, ALS_MAX_ITER, ALS_REG = 5, 10, 0.01
GRID_RANKS = (5, 10, 20, 50)
GRID_REGS = (1.0, 0.1, 0.01)
TRAIN_FRACTION = 0.8
HASHING_TF_FEATURES = 200
HOT_DEFAULT_NUM = 100
SEED = 42
# ---------------------------------------------------------------------------

RECOMMENDATION = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])
RECS = T.ArrayType(RECOMMENDATION)

PRODUCT = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

RATING = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

# Rating rows that carry an arrival sequence number as the tie-break after timestamp.
SEQ_RATING = T.StructType(RATING.fields + [T.StructField("seq", T.LongType())])

USER_RECS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("recs", RECS),
])

PRODUCT_RECS = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("recs", RECS),
])

USER = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

# Raw product file: 7 '^'-separated fields, of which 0, 1, 4, 5, 6 are kept.
PRODUCT_FILE = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("categoryIds", T.StringType()),
    T.StructField("catalogueId", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

RATING_FILE = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

EDGE = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("simProductId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])
