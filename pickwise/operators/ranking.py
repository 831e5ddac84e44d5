"""Ranking, top-k, latest-wins and list building.

Per-group top-k uses ``row_number() <= k``: Spark plans a WindowGroupLimit,
which also runs a partial limit *before* the shuffle, so a key holding a
third of all rows ships only k rows per map task. Latest-wins uses
``max_by`` / ``min`` aggregates, which combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.schemas import RECENT_ROWS


def top_k_per_key(df: DataFrame, key: str, k: int | None, score: str = "score",
                  item: str = "productId", rank_col: str = "rank") -> DataFrame:
    """Rows ranked by score desc, item asc within key; keep rank <= k."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(item).asc())
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked if k is None else ranked.filter(F.col(rank_col) <= k)


def recent_ratings_k(ratings: DataFrame, k: int = RECENT_ROWS) -> DataFrame:
    """The k newest rating rows per user (timestamp desc, seq desc); repeats count."""
    w = Window.partitionBy("userId").orderBy(F.col("timestamp").desc(), F.col("seq").desc())
    return ratings.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= k)


def latest_rating_upsert(ratings: DataFrame) -> DataFrame:
    """One row per (userId, productId): the latest score, the first timestamp (Q2, Q3)."""
    return (ratings.groupBy("userId", "productId")
            .agg(F.max_by("score", F.struct("timestamp", "seq")).alias("score"),
                 F.min("timestamp").alias("timestamp")))


def latest_event_per_user(events: DataFrame, order_cols=("ts", "seq")) -> DataFrame:
    """The newest event per user by (ts, seq) (Q7)."""
    others = [c for c in events.columns if c != "userId"]
    latest = F.max_by(F.struct(*others), F.struct(*order_cols)).alias("e")
    return events.groupBy("userId").agg(latest).select("userId", "e.*")


def collect_recs_per_key(edges: DataFrame, key: str = "productId", item: str = "simProductId",
                         score: str = "score", k: int | None = None) -> DataFrame:
    """A5: exploded (key, item, score) -> key, recs ARRAY<STRUCT<productId, score>>
    ordered by score desc, productId asc. With ``k``, the per-key top-k is cut
    first (WindowGroupLimit), so the collected list is bounded by k."""
    src = top_k_per_key(edges, key, k, score=score, item=item) if k is not None else edges
    entry = F.struct((-F.col(score)).alias("neg"), F.col(item).cast("int").alias("productId"),
                     F.col(score).cast("double").alias("score"))
    lists = src.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    recs = F.transform("_l", lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score")))
    return lists.select(F.col(key), recs.alias("recs"))


def explode_recs(nested: DataFrame, key: str = "productId") -> DataFrame:
    """Nested recs -> key, rank (1-based), productId, score."""
    return (nested.select(F.col(key).alias("_key"), F.posexplode("recs").alias("pos", "r"))
            .select(F.col("_key").alias(key if key != "productId" else "queryProductId"),
                    (F.col("pos") + 1).alias("rank"),
                    F.col("r.productId").alias("productId"),
                    F.col("r.score").alias("score")))


def similarity_map(nested: DataFrame, key: str = "productId") -> DataFrame:
    """Neighbour list -> MAP<productId, score> per key."""
    m = F.map_from_entries(F.transform("recs", lambda e: F.struct(e["productId"], e["score"])))
    return nested.select(F.col(key), m.alias("sims"))


def top_n(df: DataFrame, n: int, order_cols: list) -> DataFrame:
    """L1/L2/L4: global ORDER BY ... LIMIT n (TakeOrderedAndProject: per-partition
    top-n, then one merge of at most n rows per partition), then a 1-based rank
    over the <= n kept rows."""
    kept = df.orderBy(*order_cols).limit(n)
    return kept.withColumn("rank", F.row_number().over(Window.orderBy(*order_cols)))


def first_match(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """L4: one row per key, the first by ``order`` (ascending, nulls first; equal ones by their other columns): what a
    store's "find one" returns, but the same one every time. An aggregate that combines map-side, no sort."""
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("row")
    return df.groupBy(key).agg(first).select(key, "row.*").select(*df.columns)
