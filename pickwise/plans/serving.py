"""Serving compositions (§2.10): each answers a whole DataFrame of keys in one plan.

The reference answers one key per request; here a single key is a one-row
DataFrame, and a batch of keys is joined once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions import java_string_hash, normalise_rating_score, rating_line
from pickwise.functions import now_epoch as now_epoch_col
from pickwise.operators.joins import bounded_broadcast, checked_broadcast, enrich_product_score, mean_scores, recs_for_username
from pickwise.operators.ranking import top_k_per_key, top_n
from pickwise.operators.stats import rating_month_projection
from pickwise.schemas import HOT_DEFAULT_NUM

PRODUCT_COLS = ["productId", "name", "imageUrl", "categories", "tags", "score"]


def _ranked_products(ranked: DataFrame, products: DataFrame, n: int) -> DataFrame:
    """At most ``n`` ranked ids with their mean (productId, rank, avg) as product rows; the products scan is cut down
    to them by the broadcast join."""
    return (bounded_broadcast(ranked, n).join(products, "productId")
            .withColumn("score", F.coalesce("avg", F.lit(0.0))).select("rank", *PRODUCT_COLS))


def hot_products(ratings: DataFrame, products: DataFrame, n: int = HOT_DEFAULT_NUM) -> DataFrame:
    """L1: the n newest-month (product, month) rows by count; a product seen in
    several of those rows keeps its best rank; enriched with the mean score. The facts are
    read once: a product's mean comes from its months' sums."""
    months = (rating_month_projection(ratings).groupBy("yearmonth", "productId")
              .agg(F.count("productId").alias("count"), F.sum("score").alias("s"), F.count("score").alias("m")))
    whole = Window.partitionBy("productId")
    with_mean = months.select("yearmonth", "productId", "count", (F.sum("s").over(whole) / F.sum("m").over(whole)).alias("avg"))
    top = top_n(with_mean, n, [F.col("yearmonth").desc(), F.col("count").desc(), F.col("productId").asc()])
    return _ranked_products(top.groupBy("productId").agg(F.min("rank").alias("rank"), F.first("avg").alias("avg")), products, n)


def most_rated_products(ratings: DataFrame, products: DataFrame, n: int = HOT_DEFAULT_NUM) -> DataFrame:
    """L2: the n most rated products, enriched; counts and means from one aggregate."""
    counts = ratings.groupBy("productId").agg(F.count("productId").alias("count"), F.avg("score").alias("avg"))
    top = top_n(counts, n, [F.col("count").desc(), F.col("productId").asc()])
    return _ranked_products(top.select("productId", "rank", "avg"), products, n)


def product_info(keys: DataFrame, products: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per asked id; product columns null when the id is unknown."""
    k = keys.select(F.col("productId").cast("int")).distinct()
    found = enrich_product_score(products.join(k, "productId", "left_semi"), mean_scores(ratings, k))
    return k.join(found, "productId", "left").select(*PRODUCT_COLS)


def search_products_by_name(products: DataFrame, ratings: DataFrame, query: str) -> DataFrame:
    """Unanchored, case-sensitive regex on the name, enriched."""
    hits = products.filter(F.col("name").rlike(query))
    return enrich_product_score(hits, mean_scores(ratings, hits)).select(*PRODUCT_COLS)


def ranked_edges_to_products(edges: DataFrame, keys: DataFrame | None, products: DataFrame,
                             ratings: DataFrame, k: int | None = None) -> DataFrame:
    """item_cf_products / content_based_products: for each asked product id the
    ranked neighbour list, as product rows with the mean score and rec score."""
    e = edges if keys is None else edges.join(
        keys.select(F.col("productId").cast("int")).distinct(), "productId", "left_semi")
    return ranked_to_products(top_k_per_key(e, "productId", k, score="score", item="simProductId"), products, ratings)


def ranked_to_products(ranked: DataFrame, products: DataFrame, ratings: DataFrame, named: DataFrame | None = None,
                       digits: int | None = None) -> DataFrame:
    """Ranked lists as product rows. With ``named`` (productId: all ids the lists can name), the products among them
    are counted and broadcast under the bound, so the long lists are not shuffled. With ``digits``, a product's mean
    score is rounded once, not in each row that names it."""
    recs = ranked.select(F.col("productId").alias("queryProductId"), "rank",
                         F.col("simProductId").alias("productId"), F.col("score").alias("recScore"))
    prods = enrich_product_score(products, mean_scores(ratings))
    if digits is not None:
        prods = prods.withColumn("score", F.round("score", digits))
    if named is not None:
        prods, _ = checked_broadcast(prods.join(named.select("productId").distinct(), "productId", "left_semi")
                                     .select("productId", "name", "score").persist())
    return recs.join(prods, "productId")


def user_recs_to_products(user_keys: DataFrame, users: DataFrame, user_recs: DataFrame,
                          products: DataFrame, ratings: DataFrame, k: int | None = None) -> DataFrame:
    """offline_products / stream_products: username -> recs -> product rows.
    An unknown user or an empty list gives no rows; ``k`` optionally keeps
    the first k of each list (Q15), default the whole list."""
    nested = recs_for_username(user_keys, users, user_recs)
    rows = (nested.select("username", F.posexplode("recs").alias("pos", "r"))
            .select("username", (F.col("pos") + 1).alias("rank"), F.col("r.productId").alias("productId"),
                    F.col("r.score").alias("recScore")))
    if k is not None:
        rows = rows.filter(F.col("rank") <= k)
    prods = enrich_product_score(products, mean_scores(ratings))
    return rows.join(prods, "productId")


def register_users(requests: DataFrame, existing: DataFrame, now_epoch: int | None = None) -> DataFrame:
    """New usernames only (left anti on username): userId = Java hash of the
    name, first = true, timestamp = registration time (the query's start
    instant unless given), no preferences yet."""
    new = requests.select("username").distinct().join(existing.select("username"), "username", "left_anti")
    ts = F.lit(now_epoch).cast("bigint") if now_epoch is not None else now_epoch_col()
    return new.select(java_string_hash("username").alias("userId"), "username",
                      F.lit(True).alias("first"), ts.alias("timestamp"),
                      F.array().cast("array<string>").alias("prefGenres"))


def rate_products(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Rate requests (username, productId, rawScore 1..10, timestamp) ->
    accepted rating rows + their log line. Unknown usernames are skipped."""
    r = requests.join(users.select("username", "userId"), "username")
    rated = r.select("userId", F.col("productId").cast("int"),
                     normalise_rating_score("rawScore").alias("score"),
                     F.col("timestamp").cast("bigint"), *[c for c in ("seq",) if c in r.columns])
    return rated.withColumn("value", rating_line("userId", "productId", "score", "timestamp"))
