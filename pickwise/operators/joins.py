"""Joins of the serving and online paths (J4-J10) and the size-checked broadcast.

Broadcast is used only when a side has a proven bound: either it is the
output of a LIMIT / per-key top-k of known size, or its row count was
measured below ``max_rows``. Anything else is left to the planner (sort-merge
join, with AQE free to switch to broadcast from runtime statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, bound: int | None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` when its known row bound is under ``max_rows``."""
    return F.broadcast(df) if bound is not None and bound <= max_rows else df


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, int]:
    """Measure ``df`` (callers persist it first) and hint broadcast only under the bound."""
    n = df.count()
    return (F.broadcast(df) if n <= max_rows else df), n


def exclude_rated_products(candidates: DataFrame, rated: DataFrame) -> DataFrame:
    """Candidates (userId, productId, ...) minus products the user rated."""
    return candidates.join(rated.select("userId", "productId"), ["userId", "productId"], "left_anti")


def mean_scores(ratings: DataFrame, keys: DataFrame | None = None, key_bound: int | None = None) -> DataFrame:
    """productId, avg. With ``keys``, ratings are semi-joined to the keys first,
    so only the asked-for products are aggregated."""
    src = ratings.select("productId", "score")
    if keys is not None:
        src = src.join(bounded_broadcast(keys.select("productId").distinct(), key_bound),
                       "productId", "left_semi")
    return src.groupBy("productId").agg(F.avg("score").alias("avg"))


def enrich_product_score(products: DataFrame, avg_scores: DataFrame) -> DataFrame:
    """Products left join mean score; missing -> 0.0."""
    return (products.join(avg_scores.select("productId", "avg"), "productId", "left")
            .withColumn("score", F.coalesce(F.col("avg"), F.lit(0.0)))
            .drop("avg"))


def recs_to_products(recs: DataFrame, products: DataFrame, bound: int | None = None) -> DataFrame:
    """Exploded recs (productId + rank/recScore columns) -> product rows.
    Unknown ids vanish (inner join); rank is carried (Q16)."""
    return bounded_broadcast(recs, bound).join(products, "productId")


def serve_products(keys: DataFrame, products: DataFrame, ratings: DataFrame,
                   bound: int | None = None) -> DataFrame:
    """J6 + J5: ranked product ids -> product rows + mean score.

    When the key set is bounded (top-N, one user's list) the products scan and
    the ratings aggregate are both cut down to those keys by broadcast semi joins."""
    if bound is not None and bound <= BROADCAST_MAX_ROWS:
        keys = keys.persist()       # <= bound rows, shared by the three uses below
    if bound is not None:
        prods = products.join(bounded_broadcast(keys.select("productId").distinct(), bound),
                              "productId", "left_semi")
    else:
        prods = products
    avg = mean_scores(ratings, keys if bound is not None else None, bound)
    return enrich_product_score(recs_to_products(keys, prods, bound), avg)


def neighbour_lookup(events: DataFrame, edges: DataFrame, edges_bound: int | None = None) -> DataFrame:
    """Event product -> its neighbours (stream-static join on productId)."""
    e = edges.select("productId", "simProductId", F.col("score").alias("sim"))
    return events.join(bounded_broadcast(e, edges_bound), "productId")


def pair_similarity_lookup(pairs: DataFrame, edges: DataFrame, left: str, right: str,
                           edges_bound: int | None = None) -> DataFrame:
    """sim(left, right) from the edge table. The default 0.0 of a missing
    pair fails the '> 0.4' test, so an inner join is equivalent."""
    e = edges.select(F.col("productId").alias(left), F.col("simProductId").alias(right),
                     F.col("score").alias("sim"))
    return pairs.join(bounded_broadcast(e, edges_bound), [left, right])


def recs_for_username(user_keys: DataFrame, users: DataFrame, user_recs: DataFrame) -> DataFrame:
    """Username -> userId -> recs; unknown user / no recs -> empty list."""
    u = user_keys.select("username").distinct().join(users, "username")
    out = u.join(user_recs, "userId", "left")
    return out.withColumn("recs", F.coalesce(F.col("recs"), F.array().cast(user_recs.schema["recs"].dataType)))
