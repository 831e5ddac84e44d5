"""Online re-ranking priority (SP), the same row functions in batch and in the stream.

Relations (the contract shared with the SQL oracle):
  cur    newest rating per user by (timestamp, seq)                       W6
  cand   neighbours q of cur.productId the user never rated, top 20 by
         sim desc, q asc                                           J7, J4, W3
  recent the 21 newest rating rows of the user (repeats count)           W4
  hit    cand(u, q) x recent(u, r, score) x edges(q, r, sim)          J8, J9
  prio   avg(sim * score) + log10(max(#score>3, 1)) - log10(max(#score<=3, 1))
                                                                   A7, A8, F7

A user is one row: newest product, rated set, recent ratings. That row meets the neighbour list of its
product, and the first 20 entries that aren't rated are cut inside the row, so users x neighbours never exist as rows
and nothing but the cut is exchanged. The <= 20 x 21 pairs of a user are then joined with the similarities (a compiled
hash join; looking them up inside the row takes many times as long). A user holding a third of all rows costs 21 rows per
map task (WindowGroupLimit) and its set of rated products, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions import log10_count
from pickwise.operators.joins import bounded_broadcast
from pickwise.operators.ranking import collect_recs_per_key, latest_event_per_user, recent_ratings_k, top_k_per_key
from pickwise.schemas import HIGH_SCORE_CUTOFF, MAX_SIM_PRODUCTS_NUM, RECENT_ROWS, SIM_THRESHOLD


def current_events(events: DataFrame) -> DataFrame:
    """W6 on (timestamp, seq): userId, productId, score, timestamp, seq."""
    return latest_event_per_user(events.select("userId", "productId", "score", "timestamp", "seq"),
                                 order_cols=("timestamp", "seq"))


def rated_sets(rated: DataFrame) -> DataFrame:
    """userId, rated: the products a user rated, once each (combined map-side; bounded by the catalogue)."""
    return rated.groupBy("userId").agg(F.collect_set(F.col("productId").cast("int")).alias("rated"))


def candidates_in_row(users: DataFrame, lists: DataFrame, k: int = MAX_SIM_PRODUCTS_NUM) -> DataFrame:
    """``users`` (userId, productId, rated, ...) with ``candidates``, the first ``k`` entries of the
    product's neighbour list that aren't rated. ``lists`` (productId, recs) is sorted by score falling,
    productId rising. Users whose product has no list fall out; productId is dropped."""
    ids = F.transform("recs", lambda r: r["productId"])
    first = F.slice(F.array_except(ids, F.coalesce("rated", F.array().cast("array<int>"))), 1, k)
    kept = [c for c in users.columns if c not in ("productId", "rated")]
    found = users.join(lists.select("productId", "recs"), "productId").select(*kept, "recs", first.alias("first"))
    return found.select(*kept, F.filter("recs", lambda r: F.array_contains("first", r["productId"])).alias("candidates"))


def pairs_of_rows(rows: DataFrame) -> DataFrame:
    """userId, productId (candidate), recentProductId, recentScore from ``rows`` (userId, recentProducts,
    recentScores, candidates): at most 20 x 21 for each user."""
    each = rows.select("userId", "recentProducts", "recentScores", F.explode("candidates.productId").alias("productId"))
    recent = each.select("userId", "productId", F.explode(F.arrays_zip("recentProducts", "recentScores")).alias("r"))
    return recent.select("userId", "productId", F.col("r.recentProducts").alias("recentProductId"),
                         F.col("r.recentScores").alias("recentScore"))


def top_k_candidates(cur: DataFrame, edges: DataFrame, rated: DataFrame,
                     k: int = MAX_SIM_PRODUCTS_NUM, edges_bound: int | None = None) -> DataFrame:
    """J7 -> J4 -> W3: userId, productId (candidate), sim, candRank."""
    users = cur.select("userId", "productId").join(rated_sets(rated), "userId", "left")
    cut = candidates_in_row(users, bounded_broadcast(collect_recs_per_key(edges), edges_bound), k)
    return cut.select("userId", F.posexplode("candidates").alias("at", "c")).select(
        "userId", F.col("c.productId").alias("productId"), F.col("c.score").alias("sim"), (F.col("at") + 1).alias("candRank"))


def candidate_recent_pairs(cand: DataFrame, recent: DataFrame) -> DataFrame:
    """Each candidate x each recent rating of the same user (<= 20 x 21 per user)."""
    r = recent.select("userId", F.col("productId").alias("recentProductId"),
                      F.col("score").alias("recentScore"))
    return cand.select("userId", "productId").join(r, "userId")


def hits(pairs: DataFrame, edges: DataFrame, threshold: float = SIM_THRESHOLD,
         edges_bound: int | None = None) -> DataFrame:
    """J9 + P7: keep (candidate, recent) pairs whose similarity is > threshold."""
    e = edges.select(F.col("productId"), F.col("simProductId").alias("recentProductId"),
                     F.col("score").alias("sim"))
    return (pairs.join(bounded_broadcast(e, edges_bound), ["productId", "recentProductId"])
            .filter(F.col("sim") > F.lit(threshold)))


def score_candidates(hit: DataFrame) -> DataFrame:
    """A7 + A8 + F7: userId, productId, baseScore, nHigh, nLow, priority."""
    agg = hit.groupBy("userId", "productId").agg(
        F.avg(F.col("sim") * F.col("recentScore")).alias("baseScore"),
        F.count_if(F.col("recentScore") > HIGH_SCORE_CUTOFF).alias("nHigh"),
        F.count_if(F.col("recentScore") <= HIGH_SCORE_CUTOFF).alias("nLow"))
    return agg.withColumn("priority", F.col("baseScore") + log10_count("nHigh") - log10_count("nLow"))


def stream_priority(ratings: DataFrame, edges: DataFrame, events: DataFrame | None = None,
                    k: int = MAX_SIM_PRODUCTS_NUM, recent_k: int = RECENT_ROWS,
                    threshold: float = SIM_THRESHOLD, edges_bound: int | None = None) -> DataFrame:
    """SP: userId, productId, priority (+ parts) for the newest event of every
    user in ``events`` (default: every user in ``ratings``).

    ``ratings`` is the rating history *including* the events (the event is
    stored and queued before it reaches the stream)."""
    cur = current_events(events if events is not None else ratings)
    hist = ratings.select("userId", "productId", "score", "timestamp", "seq")
    if events is not None:
        hist = hist.join(cur.select("userId"), "userId", "left_semi")
    newest = F.struct("recency", F.col("productId").cast("int").alias("productId"), "score")
    recent = recent_ratings_k(hist, recent_k).groupBy("userId").agg(F.sort_array(F.collect_list(newest)).alias("r")).select(
        "userId", F.col("r.productId").alias("recentProducts"), F.col("r.score").alias("recentScores"))
    users = cur.select("userId", "productId").join(rated_sets(hist), "userId").join(recent, "userId")
    cut = candidates_in_row(users, bounded_broadcast(collect_recs_per_key(edges), edges_bound), k)
    return score_candidates(hits(pairs_of_rows(cut), edges, threshold, edges_bound))


def rank_priorities(prio: DataFrame) -> DataFrame:
    """L3: 1-based rank per user by priority desc, productId asc."""
    return top_k_per_key(prio, "userId", None, score="priority", item="productId", rank_col="rank")


def stream_recs_table(prio: DataFrame, users_in_batch: DataFrame) -> DataFrame:
    """T5 form: userId, recs ARRAY<STRUCT<productId, score>> ordered by priority
    desc; users of the batch without any scored candidate get recs = [] (Q6).
    The list per user is bounded by the 20 candidates."""
    entry = F.struct((-F.col("priority")).alias("neg"), F.col("productId").cast("int").alias("productId"),
                     F.col("priority").alias("score"))
    lists = prio.groupBy("userId").agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    recs = F.transform("_l", lambda e: F.struct(e["productId"].alias("productId"), e["score"].alias("score")))
    full = users_in_batch.select("userId").distinct().join(lists, "userId", "left")
    empty = F.array().cast("array<struct<productId:int,score:double>>")
    return full.select("userId", F.coalesce(recs, empty).alias("recs"))
