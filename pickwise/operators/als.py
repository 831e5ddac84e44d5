"""Latent-factor model (M1-M6, A6, A9) on ``pyspark.ml`` ALS.

The split is a hash split, so a recomputed partition (after an executor
loss) lands every row on the same side again; ``randomSplit`` over an input
whose order can change would not guarantee that. ALS checkpoints its factor
lineage into the session's shared checkpoint folder every
``checkpointInterval`` iterations.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.operators.inner_product import top_inner_products
from pickwise.operators.stats import rmse
from pickwise.schemas import (ALS_MAX_ITER, ALS_RANK, ALS_REG, GRID_RANKS, GRID_REGS, SEED,
                              TRAIN_FRACTION, USER_MAX_RECOMMENDATION)
from pickwise.session import checkpoint_root


def als_estimator(rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER, reg: float = ALS_REG,
                  seed: int = SEED, blocks: int | tuple[int, int] | None = None):
    from pyspark.ml.recommendation import ALS
    kw = {}
    if blocks:
        users, items = blocks if isinstance(blocks, tuple) else (blocks, blocks)
        kw = {"numUserBlocks": users, "numItemBlocks": items}
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="userId",
               itemCol="productId", ratingCol="score", coldStartStrategy="drop",
               implicitPrefs=False, nonnegative=False, checkpointInterval=10, **kw)


def auto_blocks(ratings: DataFrame) -> int:
    """User/item blocks for ALS from the input's own split (no job): one block
    per input partition, at most the cluster's default parallelism."""
    parallelism = ratings.sparkSession.sparkContext.defaultParallelism
    return max(1, min(ratings.rdd.getNumPartitions(), parallelism))


GRID_BLOCK_ROWS = 20_000_000      # ratings in a block of a grid fit, at most


def grid_blocks(train: DataFrame, at_once: int) -> int:
    """Blocks of one of ``at_once`` fits that share the cluster: its share of the cores, as a factor is sent to every
    block that needs it in each iteration; more where a block would hold over GRID_BLOCK_ROWS ratings."""
    share = math.ceil(train.sparkSession.sparkContext.defaultParallelism / at_once)
    most = auto_blocks(train)
    return most if most <= share else max(share, math.ceil(train.count() / GRID_BLOCK_ROWS))


def grid_sides(train: DataFrame, blocks: int) -> tuple[int, int]:
    """(user, item) blocks of a grid fit. The factors of the side with more ids are the bulk of an iteration's shuffle,
    once for each block of the other side: that one, with fewer ids, has two blocks, more where a block would hold over
    GRID_BLOCK_ROWS ratings, and never more than ``blocks``."""
    if blocks <= 2:
        return blocks, blocks
    rows, users, items = train.agg(F.count("*"), F.approx_count_distinct("userId"), F.approx_count_distinct("productId")).first()
    few = min(blocks, max(2, math.ceil(rows / GRID_BLOCK_ROWS)))
    return (blocks, few) if users >= items else (few, blocks)


def als_train(ratings: DataFrame, rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER,
              reg: float = ALS_REG, seed: int = SEED, blocks: int | tuple[int, int] | None = None):
    """M1: fit explicit ALS on (userId, productId, score). ``blocks``: of either side, or (user, item)."""
    checkpoint_root(ratings.sparkSession)
    triples = ratings.select("userId", "productId", "score")
    return als_estimator(rank, max_iter, reg, seed, blocks or auto_blocks(triples)).fit(triples)


def als_predict_pairs(model, pairs: DataFrame) -> DataFrame:
    """M2: score arbitrary (userId, productId) pairs; unseen ids drop."""
    return model.transform(pairs).withColumn("prediction", F.col("prediction").cast("double"))


def user_recs(model, k: int = USER_MAX_RECOMMENDATION) -> DataFrame:
    """M3: top-k predictions per user, only those > 0, users with none absent. Exact, by pruned inner
    products: a user meets the item factors in blocks of falling norm until none left can reach the list."""
    users = model.userFactors.select(F.col("id").alias("userId"), "features")
    found = top_inner_products(users, item_factors(model), k, "userId", "productId")
    return found.where(F.size("recs") > 0).select("userId", "recs")


def item_factors(model) -> DataFrame:
    """M4: productId, features ARRAY<FLOAT>."""
    return model.itemFactors.select(F.col("id").cast("int").alias("productId"), "features")


def train_test_split(ratings: DataFrame, fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """M5: deterministic hash split of rating rows into (train, test)."""
    bucket = F.pmod(F.xxhash64("userId", "productId", "timestamp", "score"), F.lit(1000))
    tagged = ratings.withColumn("_b", bucket)
    cut = int(round(fraction * 1000))
    return (tagged.filter(F.col("_b") < cut).drop("_b"), tagged.filter(F.col("_b") >= cut).drop("_b"))


FACTOR_BROADCAST_CELLS = 1 << 22  # floats of a broadcast factor table (16 MB), at most


def scored_pairs(model, pairs: DataFrame) -> DataFrame:
    """``als_predict_pairs`` for pairs without null ids, as (score, prediction). Pairs meet the larger factor table in
    a join while they have no vector yet, the smaller one by broadcast up to FACTOR_BROADCAST_CELLS, so that no pair
    is shuffled with a vector (``transform`` joins both tables, the second one with the first one's vectors)."""
    sides = [(f.count(), f.select(F.col("id").alias(key), F.col("features").alias(vector)), key)
             for f, key, vector in ((model.userFactors, "userId", "uf"), (model.itemFactors, "productId", "vf"))]
    (n, small, by), (_, large, first) = sorted(sides, key=lambda x: x[0])
    small = F.broadcast(small) if n * model.rank <= FACTOR_BROADCAST_CELLS else small
    both = pairs.select("userId", "productId", "score").join(large, first).join(small, by)
    # single precision, in the order of the vectors, as the model adds it up; null (not a filter, which would take the
    # product again) where it is no number
    product = F.aggregate(F.zip_with("uf", "vf", lambda x, y: x * y), F.lit(0.0).cast("float"), lambda s, x: s + x)
    return both.select("score", F.nanvl(product.cast("double"), F.lit(None).cast("double")).alias("prediction"))


def model_rmse(model, test: DataFrame) -> float:
    """A6 on a model: RMSE over the test pairs the model can score."""
    return rmse(scored_pairs(model, test), "score", "prediction").first()["rmse"]


def _with_ids(pairs: DataFrame) -> DataFrame:
    """(userId, productId, score); a null id is an error, as it is for the model."""
    def given(c):
        return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} Ids MUST NOT be Null"))).otherwise(F.col(c)).alias(c)
    return pairs.select(given("userId"), given("productId"), "score")


def als_grid_search(spark: SparkSession, train: DataFrame, test: DataFrame,
                    ranks=GRID_RANKS, regs=GRID_REGS, max_iter: int = ALS_MAX_ITER,
                    seed: int = SEED, blocks: int | tuple[int, int] | None = None, parallelism: int = 4) -> DataFrame:
    """M6: rank x lambda grid; returns (rank, lambda, rmse). Each fit is a
    distributed job; up to ``parallelism`` fits run at once from driver
    threads (as TrainValidationSplit does), so small fits share the cluster.
    Only the 12 scalar results come back to the driver; fits are seeded, so
    the result does not depend on the concurrency. For all fits, the test pairs
    are shuffled by user once, and the ratings sorted by user and product once:
    each fit shuffles them three times, and runs of an id compress well."""
    from concurrent.futures import ThreadPoolExecutor

    given = train.select("userId", "productId", "score").persist()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    test = _with_ids(test).repartition(parts, "userId").persist()
    grid = [(int(r), float(lam)) for r in ranks for lam in regs]
    at_once = max(1, min(parallelism, len(grid)))
    blocks = blocks or grid_sides(given, grid_blocks(given, at_once))
    # a range of both columns: a user with very many ratings lies in several parts
    train = given.repartitionByRange(parts, "userId", "productId").sortWithinPartitions("userId", "productId").persist()
    train.count()
    given.unpersist()

    def fit(point):
        r, lam = point
        model = als_train(train, r, max_iter, lam, seed, blocks)
        return (r, lam, float(model_rmse(model, test)))

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = list(pool.map(fit, grid))
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame(rows, "rank int, lambda double, rmse double")


def best_params(grid: DataFrame) -> DataFrame:
    """The (rank, lambda) with the least RMSE (ties: smaller rank, larger lambda)."""
    return grid.orderBy(F.col("rmse").asc(), F.col("rank").asc(), F.col("lambda").desc()).limit(1)
