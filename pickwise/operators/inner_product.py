"""Exact top-k by inner product (M3), without scoring all pairs.

Items are ranked by the norm of their vectors, longest first, and cut into blocks of that order. No item of a block
can score more with a query than the query's norm times the block's longest norm. So queries meet the blocks in
order, and a query is finished as soon as the next block's bound lies below its k-th best score; most queries see
the first blocks only. A block has a bounded number of cells (``BLOCK_CELLS``) and is broadcast; the queries that are
still open are the only thing read in a round.

Scores are rounded to ``SIM_DIGITS`` digits before they are ranked, so that equal vectors tie and the smaller
identifier comes first. Only positive scores count. ``scored`` says how many items a query has met."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pickwise.schemas import SIM_DIGITS
from pickwise.session import scratch_path

#: Doubles of the largest block (16 MB); the first block has FIRST_ROWS rows, each next one four times as many.
BLOCK_CELLS, FIRST_ROWS = 1 << 21, 1024
#: Scores held at a time by a task.
SCORES = 1 << 22
#: Room for rounding in the bound.
SLACK = 1 + 1e-9
STATE = "key long, features array<double>, norm double, ids array<long>, scores array<double>, scored long, open boolean"


def _written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)


def block_rows(dim: int) -> list[int]:
    """Rows of the blocks that grow; the last size holds for all further blocks."""
    most, sizes = max(1, BLOCK_CELLS // max(1, dim)), []
    while not sizes or sizes[-1] < most:
        sizes.append(min(most, FIRST_ROWS * 4 ** len(sizes)))
    return sizes


def _vectors(df: DataFrame, key: str, features: str) -> DataFrame:
    v = F.transform(features, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return df.select(F.col(key).cast("long").alias("key"), v.alias("v")).where("key is not null and v is not null").select(
        "key", "v", norm.alias("norm"))


def norm_blocks(items: DataFrame, dim: int) -> DataFrame:
    """(block, key, v, norm): the items by falling norm in blocks, numbered from 0. Ranks are global places: the
    items are range-partitioned by norm, and each part's places begin where the part before ends."""
    spark = items.sparkSession
    placed = (items.repartitionByRange(F.desc("norm"), "key").sortWithinPartitions(F.desc("norm"), "key")
              .select("*", F.monotonically_increasing_id().alias("id")))
    table = _written(placed.select("*", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("at")),
                     "ip-items")
    parts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each part
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = spark.createDataFrame(parts.select("part", before.alias("before")).collect(), "part long, before long")
    rank = F.col("before") + F.col("at")
    block, begin = None, 0
    sizes = block_rows(dim)
    for n, rows in enumerate(sizes[:-1]):
        block = (F.when(rank < begin + rows, n) if block is None else block.when(rank < begin + rows, n))
        begin += rows
    rest = (len(sizes) - 1 + F.floor((rank - begin) / sizes[-1])).cast("int")
    block = rest if block is None else block.otherwise(rest)
    return _written(table.join(F.broadcast(starts), "part").select(block.alias("block"), "key", "v", "norm"), "ip-blocks", "block")


def _meet(block, next_norm: float, k: int):
    """A task function: open queries meet one block (a broadcast of keys and vectors); ``next_norm`` is the longest norm
    of what follows it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vectors = block.value
        for batch in batches:
            rows = max(1, SCORES // max(1, len(keys)))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                q = np.stack(part.column(1).to_numpy(zero_copy_only=False))
                norm = part.column(2).to_numpy()
                ids, scores = part.column(3).to_pylist(), part.column(4).to_pylist()
                found = np.round(q @ vectors.T, SIM_DIGITS)
                out_ids, out_scores, open_ = [], [], []
                for r in range(part.num_rows):
                    s = found[r]
                    floor = scores[r][-1] if len(scores[r]) == k else 0.0
                    least = max(floor, np.partition(s, len(s) - k)[len(s) - k]) if len(s) > k else floor
                    good = np.flatnonzero((s >= least) & (s > 0))
                    i = np.concatenate([np.array(ids[r], np.int64), keys[good]])
                    v = np.concatenate([np.array(scores[r], float), s[good]])
                    best = np.lexsort((i, -v))[:k]
                    out_ids.append(i[best])
                    out_scores.append(v[best])
                    kth = float(v[best[-1]]) if len(best) == k else 0.0
                    reach = norm[r] * next_norm * SLACK
                    open_.append(bool(reach > 0 and reach >= kth))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(out_ids, pa.list_(pa.int64())),
                     pa.array(out_scores, pa.list_(pa.float64())),
                     pa.array(part.column(5).to_numpy() + len(keys), pa.int64()), pa.array(open_, pa.bool_())],
                    names=["key", "features", "norm", "ids", "scores", "scored", "open"])
    return run


def _block(spark: SparkSession, table: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, float] | None:
    rows = table.where(F.col("block") == n).select("key", "v", "norm").toPandas()  # BLOCK_CELLS at most
    if not len(rows):
        return None
    return rows["key"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()), float(rows["norm"].max())


def top_inner_products(queries: DataFrame, items: DataFrame, k: int, query_key: str, item_key: str,
                       features: str = "features") -> DataFrame:
    """query_key, recs ARRAY<STRUCT<productId, score>> (the k largest positive inner products, score falling, smaller
    identifier first), scored. Rows without identifier or vector are left out; a query without a positive product has
    an empty list."""
    spark = queries.sparkSession
    given = _vectors(items, item_key, features)
    first = given.select(F.size("v").alias("d")).first()
    dim = first["d"] if first else 1
    blocks = norm_blocks(given, dim)
    state = _vectors(queries, query_key, features).select(
        "key", F.col("v").alias("features"), "norm", F.array().cast("array<long>").alias("ids"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored"), F.lit(True).alias("open"))
    done, n, block = [], 0, _block(spark, blocks, 0)
    while block is not None:
        following = _block(spark, blocks, n + 1)
        shared = spark.sparkContext.broadcast(block[:2])
        met = state.mapInArrow(_meet(shared, following[2] if following else 0.0, k), STATE)
        state = _written(met, "ip-state")
        done.append(state.where("not open"))
        state = state.where("open")
        if not state.head(1):
            break
        n, block = n + 1, following
    if not done:
        done = [state]
    finished = done[0]
    for part in done[1:]:
        finished = finished.unionByName(part)
    recs = F.zip_with("ids", "scores", lambda i, s: F.struct(i.cast("int").alias("productId"), s.alias("score")))
    return finished.select(F.col("key").cast("int").alias(query_key), recs.alias("recs"), "scored")
