"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the driver's whole tables (through the fixture views) and returns
flat columns whose names match the SQL oracle in ``pickwise.plans.oracle``.
Doubles are rounded to 6 digits on both sides for the value-hash compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.functions import (cosine_expr, epoch_to_yearmonth, from_document, java_string_hash, rating_line,
                                to_document)
from pickwise.operators import als as als_ops
from pickwise.operators import joins, priority, ranking, similarity, stats
from pickwise.operators.inner_product import top_inner_products
from pickwise.plans import name_index, serving
from pickwise.sources import fixtures as fx
from pickwise.schemas import ALS_RANK, ALS_REG, SIM_THRESHOLD, USER_MAX_RECOMMENDATION
from pickwise.session import materialize, scratch_path
from pickwise.sources import io
from pickwise.streaming.parse import parse_rating_events, valid_rating_events

R6 = 6
REGISTRATION_EPOCH = 1735689600      # registration time used by the register_users query
SEARCH_QUERY = "ring"
SEARCH_PATTERNS = ["ring", "^s.*bolt$", "red|gizmo", "w[aeiou]dge", "colou?r", "old", "e{2}n", "a.l"]


def _r6(c):
    return F.round(F.col(c), R6).alias(c)


def _edges_item_cf(spark: SparkSession, sf_dir: str):
    """M9 on R2, cached for its several uses, with its proven row bound
    (n_items * (n_items - 1)) for the broadcast check."""
    r2 = fx.ratings_r2(spark, sf_dir)
    edges, bound = similarity.item_cf(r2)
    return r2, materialize(edges), bound


def _sp_parts(spark: SparkSession, sf_dir: str):
    r2, edges, n = _edges_item_cf(spark, sf_dir)
    cur = priority.current_events(r2)
    rated = r2.select("userId", "productId")
    cand = priority.top_k_candidates(cur, edges, rated, edges_bound=n)
    recent = ranking.recent_ratings_k(r2.select("userId", "productId", "score", "timestamp", "seq"))
    return r2, edges, n, cur, rated, cand, recent


# --- statistics -------------------------------------------------------------

def q_rate_more_products(spark, sf_dir):
    return stats.rate_more_products(fx.ratings_r1(spark, sf_dir))


def q_rate_more_recently_products(spark, sf_dir):
    return stats.rate_more_recently_products(fx.ratings_r1(spark, sf_dir))


def q_average_products(spark, sf_dir):
    return stats.average_products(fx.ratings_r1(spark, sf_dir)).select("productId", _r6("avg"))


def q_distinct_users(spark, sf_dir):
    return stats.distinct_users(fx.ratings_r1(spark, sf_dir))


def q_distinct_products(spark, sf_dir):
    return stats.distinct_products(fx.ratings_r1(spark, sf_dir))


def q_rating_month_projection(spark, sf_dir):
    return stats.rating_month_projection(fx.ratings_r1(spark, sf_dir))


def q_rating_triples(spark, sf_dir):
    return stats.rating_triples(fx.ratings_r1(spark, sf_dir))


def q_epoch_to_yearmonth(spark, sf_dir):
    r1 = fx.ratings_r1(spark, sf_dir)
    return r1.select("timestamp", epoch_to_yearmonth("timestamp").alias("yearmonth")).distinct()


def q_rmse(spark, sf_dir):
    """A6 on fixed pairs: each R1 rating against its product's mean score."""
    r1 = fx.ratings_r1(spark, sf_dir)
    pred = r1.join(stats.average_products(r1).withColumnRenamed("avg", "prediction"), "productId")
    return stats.rmse(pred, "score", "prediction").select(_r6("rmse"))


# --- top-N serving ------------------------------------------------------------

def q_hot_products(spark, sf_dir):
    return serving.hot_products(fx.ratings_r1(spark, sf_dir), fx.products(spark, sf_dir)).withColumn(
        "score", F.round("score", R6))


def q_most_rated_products(spark, sf_dir):
    return serving.most_rated_products(fx.ratings_r1(spark, sf_dir), fx.products(spark, sf_dir)).withColumn(
        "score", F.round("score", R6))


def q_enrich_product_score(spark, sf_dir):
    r1 = fx.ratings_r1(spark, sf_dir)
    out = joins.enrich_product_score(fx.products(spark, sf_dir), stats.average_products(r1))
    return out.select(*serving.PRODUCT_COLS).withColumn("score", F.round("score", R6))


def q_product_documents(spark, sf_dir):
    """F16: every served product as a JSON document, parsed back with an explicit schema."""
    r1 = fx.ratings_r1(spark, sf_dir)
    served = joins.enrich_product_score(fx.products(spark, sf_dir), stats.average_products(r1))
    served = served.select(*serving.PRODUCT_COLS).withColumn("score", F.round("score", R6))
    docs = served.select("productId", to_document(*serving.PRODUCT_COLS).alias("doc"))
    back = from_document("doc", "productId int, name string, imageUrl string, categories string, "
                                "tags string, score double")
    return docs.select("productId", "doc", back["name"].alias("name"), back["score"].alias("score"))


def q_product_info(spark, sf_dir):
    keys = fx.ratings_r2(spark, sf_dir).select("productId")
    return serving.product_info(keys, fx.products(spark, sf_dir), fx.ratings_r1(spark, sf_dir)).withColumn(
        "score", F.round("score", R6))


def q_search_products_by_name(spark, sf_dir):
    return serving.search_products_by_name(fx.products(spark, sf_dir), fx.ratings_r1(spark, sf_dir),
                                           SEARCH_QUERY).withColumn("score", F.round("score", R6))


# --- ratings, events, users -----------------------------------------------------

def q_normalise_rating_score(spark, sf_dir):
    raw = fx.rating_events_raw(spark, sf_dir)
    return raw.select("seq", "rawScore", F.round(F.col("rawScore") / 2.0, 2).alias("score"))


def q_user_ratings(spark, sf_dir):
    return fx.ratings_r2(spark, sf_dir).select("userId", "productId").distinct()


def q_recent_ratings_k(spark, sf_dir):
    r2 = fx.ratings_r2(spark, sf_dir).select("userId", "productId", "score", "timestamp", "seq")
    return ranking.recent_ratings_k(r2)


def q_latest_rating_upsert(spark, sf_dir):
    return ranking.latest_rating_upsert(fx.ratings_r2(spark, sf_dir))


def q_latest_event_per_user(spark, sf_dir):
    return priority.current_events(fx.ratings_r2(spark, sf_dir))


def q_emit_rating_events(spark, sf_dir):
    return io.emit_rating_events(fx.ratings_r2(spark, sf_dir))


def q_extract_rating_log(spark, sf_dir):
    """S9 over log lines laid out like the server's log file; 'view' events
    also leave a non-rating line that must be skipped."""
    r2 = fx.rating_events_raw(spark, sf_dir, ("event_type",)).withColumn(
        "score", F.round(F.col("rawScore") / 2.0, 2))
    head = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit("   INFO --- ["),
                    F.lpad(F.lit("http-nio-8080-exec-1"), 50, " "), F.lit("]  "),
                    F.rpad(F.lit("ProductRestApi"), 80, " "), F.lit("(line:   146)  :  "))
    msgs = F.array_compact(F.array(
        F.concat(head, rating_line("userId", "productId", "score", "timestamp")),
        F.when(F.col("event_type") == "view",
               F.concat(head, F.lit("GET /rest/product/info/"), F.col("productId").cast("string")))))
    lines = r2.select(F.explode(msgs).alias("value"))
    return io.extract_rating_log(lines)


def q_parse_rating_events(spark, sf_dir):
    lines = fx.rating_event_lines(spark, sf_dir)
    return parse_rating_events(lines)


def q_valid_event_filter(spark, sf_dir):
    lines = fx.rating_event_lines(spark, sf_dir)
    return valid_rating_events(parse_rating_events(lines))


def q_username_to_user_id(spark, sf_dir):
    u = fx.users(spark, sf_dir)
    return u.select("username", java_string_hash("username").alias("userId"))


def q_user_by_name(spark, sf_dir):
    """P10: look up every username of the users who rated (R2)."""
    u = fx.users(spark, sf_dir)
    asked = u.join(fx.ratings_r2(spark, sf_dir).select("userId").distinct(), "userId", "left_semi")
    return u.join(asked.select("username"), "username", "left_semi").select("userId", "username")


def q_register_users(spark, sf_dir):
    """Every customer asks to register; those with R2 ratings already exist."""
    u = fx.users(spark, sf_dir)
    existing = u.join(fx.ratings_r2(spark, sf_dir).select("userId").distinct(), "userId", "left_semi")
    out = serving.register_users(u.select("username"), existing, REGISTRATION_EPOCH)
    return out.select("userId", "username", "first", "timestamp")


def q_rate_products(spark, sf_dir):
    raw = fx.rating_events_raw(spark, sf_dir)
    u = fx.users(spark, sf_dir)
    req = raw.join(u, "userId").select("username", "productId", "rawScore", "timestamp", "seq")
    return serving.rate_products(req, u).select("seq", "userId", "productId", "score", "timestamp", "value")


def q_load_products(spark, sf_dir):
    """The products written as a delimited file, some lines spoilt by rule, and read back: every line as a
    product or as a reject with its reason."""
    pid = F.col("productId")
    line = F.concat_ws("^", F.when(pid % 17 == 0, F.concat(F.lit("x"), pid)).otherwise(pid.cast("string")),
                       F.concat(F.lit(" "), "name", F.lit(" ")), F.lit("1,2"), F.lit("B00"), "imageUrl", "categories", "tags")
    short = F.concat_ws("^", pid.cast("string"), "name")
    spoilt = F.when(pid % 29 == 0, F.lit("  ")).when(pid % 23 == 0, short).otherwise(line)
    return _loaded(spark, fx.products(spark, sf_dir).select(spoilt.alias("value")), io.read_products)


def q_load_ratings(spark, sf_dir):
    """The ratings written as a delimited file, some lines spoilt by rule and some with milliseconds, and read
    back: every line as a rating or as a reject with its reason."""
    seq, ids = F.col("seq"), [F.col("userId").cast("string"), F.col("productId").cast("string")]
    score = F.when(seq % 13 == 0, F.lit("x")).when(seq % 31 == 0, F.lit("NaN")).otherwise(F.col("score").cast("string"))
    when = F.when(seq % 7 == 0, F.col("timestamp") * 1000 + 123).otherwise(F.col("timestamp")).cast("string")
    spoilt = F.when(seq % 19 == 0, F.concat_ws(",", *ids, score)).otherwise(F.concat_ws(",", *ids, score, when))
    return _loaded(spark, fx.ratings_r2(spark, sf_dir).select(spoilt.alias("value")), io.read_ratings)


def _loaded(spark, lines, read):
    path = scratch_path(spark, "load")
    lines.write.text(path)
    found = read(spark, path)
    return io.accepted(found).unionByName(io.rejected(found).select("line", "reason"), allowMissingColumns=True)


def q_first_match(spark, sf_dir):
    """L4: every user's first rating."""
    r1 = fx.ratings_r1(spark, sf_dir).select("userId", "productId", "score", "timestamp")
    return ranking.first_match(r1, "userId", ["timestamp", "productId"])


# --- item-CF, similarity lists ----------------------------------------------------

def q_item_cf_recs(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    return edges.select("productId", "simProductId", _r6("score"))


def q_rank_similar_products(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    ranked = ranking.top_k_per_key(edges, "productId", None, item="simProductId")
    return ranked.select("productId", "simProductId", _r6("score"), "rank")


def q_collect_recs_per_key(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    nested = ranking.collect_recs_per_key(edges)
    ids = F.array_join(F.transform("recs", lambda r: r["productId"].cast("string")), ",")
    return nested.select("productId", F.size("recs").alias("nRecs"), ids.alias("recIds"))


def q_explode_recs(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    out = ranking.explode_recs(ranking.collect_recs_per_key(edges))
    return out.select("queryProductId", "rank", "productId", _r6("score"))


def q_similarity_map(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    m = ranking.similarity_map(ranking.collect_recs_per_key(edges))
    # each neighbour is looked up in its row's own map, as the online path does: no row meets another
    looked = F.transform(F.map_keys("sims"), lambda k: F.struct(
        k.alias("simProductId"), F.try_element_at("sims", k).alias("score")))
    return m.select("productId", F.inline(looked)).select("productId", "simProductId", _r6("score"))


def q_recs_to_products(spark, sf_dir):
    _, edges, _ = _edges_item_cf(spark, sf_dir)
    ranked = ranking.top_k_per_key(edges, "productId", None, item="simProductId")
    recs = ranked.select(F.col("productId").alias("queryProductId"), "rank",
                         F.col("simProductId").alias("productId"))
    return joins.recs_to_products(recs, fx.products(spark, sf_dir)).select(
        "queryProductId", "rank", "productId", "name")


def q_item_cf_products(spark, sf_dir):
    r2, edges, _ = _edges_item_cf(spark, sf_dir)
    out = serving.ranked_edges_to_products(edges, r2.select("productId"), fx.products(spark, sf_dir),
                                           fx.ratings_r1(spark, sf_dir))
    return out.select("queryProductId", "rank", "productId", "name", _r6("recScore"), _r6("score"))


# --- dense-vector similarity ---------------------------------------------------------

def q_product_recs(spark, sf_dir):
    v = fx.item_vectors(spark, sf_dir)
    edges = similarity.cosine_all_pairs(v)
    ranked = ranking.top_k_per_key(edges, "productId", None, item="simProductId")
    return ranked.select("productId", "simProductId", _r6("score"), "rank")


def q_cosine_similarity(spark, sf_dir):
    """F9 as a JVM expression, evaluated on the pairs the blocked operator found."""
    v = fx.item_vectors(spark, sf_dir)
    edges = similarity.cosine_all_pairs(v).select("productId", "simProductId")
    a = v.select("productId", F.col("features").alias("fa"))
    b = v.select(F.col("productId").alias("simProductId"), F.col("features").alias("fb"))
    out = edges.join(a, "productId").join(b, "simProductId")
    return out.select("productId", "simProductId", F.round(cosine_expr("fa", "fb"), R6).alias("score"))


def q_search_by_index(spark, sf_dir):
    """P8 through the trigram index: several patterns (plain, anchored, alternatives, classes, without a literal)."""
    root = scratch_path(spark, "name-index")
    name_index.publish_name_index(spark, root, fx.products(spark, sf_dir))
    found = [name_index.search(spark, root, p).select(F.lit(p).alias("pattern"), "productId", "name") for p in SEARCH_PATTERNS]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def q_top_inner_products(spark, sf_dir):
    """M3's search on given vectors: every twentieth vector against all, the 20 largest positive inner products."""
    v = fx.item_vectors(spark, sf_dir)
    asked = v.where(F.col("productId") % 20 == 0).withColumnRenamed("productId", "userId")
    return ranking.explode_recs(top_inner_products(asked, v, 20, "userId", "productId").select("userId", "recs"), key="userId") \
        .select("userId", "rank", "productId", _r6("score"))


# --- content features -----------------------------------------------------------------

def q_content_features(spark, sf_dir):
    d = fx.product_text(spark, sf_dir)
    out = similarity.content_features(d)
    return out.select("productId", "term", "tf", _r6("idf"), _r6("weight"))


def q_content_based_recs(spark, sf_dir):
    d = fx.product_text(spark, sf_dir)
    return similarity.content_based_ranked(d, digits=R6).select("productId", "simProductId", "score", "rank")


def q_content_based_products(spark, sf_dir):
    d = fx.product_text(spark, sf_dir)
    out = serving.ranked_to_products(similarity.content_based_ranked(d, digits=R6), fx.products(spark, sf_dir),
                                     fx.ratings_r1(spark, sf_dir), d, R6)
    return out.select("queryProductId", "rank", "productId", "name", "recScore", "score")


# --- online priority and its parts -------------------------------------------------------

def q_neighbour_lookup(spark, sf_dir):
    r2, edges, n = _edges_item_cf(spark, sf_dir)
    cur = priority.current_events(r2).select("userId", F.col("productId"))
    out = joins.neighbour_lookup(cur, edges, n)
    return out.select("userId", F.col("productId").alias("curProductId"),
                      F.col("simProductId").alias("productId"), _r6("sim"))


def q_exclude_rated_products(spark, sf_dir):
    r2, edges, n = _edges_item_cf(spark, sf_dir)
    cur = priority.current_events(r2)
    nb = joins.neighbour_lookup(cur.select("userId", "productId"), edges, n).select(
        "userId", F.col("simProductId").alias("productId"), "sim")
    out = joins.exclude_rated_products(nb, r2.select("userId", "productId"))
    return out.select("userId", "productId", _r6("sim"))


def q_top_k_candidates(spark, sf_dir):
    _, _, _, _, _, cand, _ = _sp_parts(spark, sf_dir)
    return cand.select("userId", "productId", _r6("sim"), "candRank")


def q_candidate_recent_cross(spark, sf_dir):
    _, _, _, _, _, cand, recent = _sp_parts(spark, sf_dir)
    return priority.candidate_recent_pairs(cand, recent)


def q_pair_similarity_lookup(spark, sf_dir):
    _, edges, n, _, _, cand, recent = _sp_parts(spark, sf_dir)
    hit = priority.hits(priority.candidate_recent_pairs(cand, recent), edges, edges_bound=n)
    return hit.select("userId", "productId", "recentProductId", "recentScore", _r6("sim"))


def _scored(spark, sf_dir):
    r2, edges, n = _edges_item_cf(spark, sf_dir)
    return priority.stream_priority(r2, edges, edges_bound=n)


def q_weighted_base_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("userId", "productId", _r6("baseScore"))


def q_boost_penalty_counts(spark, sf_dir):
    return _scored(spark, sf_dir).select("userId", "productId", "nHigh", "nLow")


def q_stream_priority(spark, sf_dir):
    return _scored(spark, sf_dir).select("userId", "productId", _r6("priority"))


def q_sort_priority(spark, sf_dir):
    p = _scored(spark, sf_dir).select("userId", "productId", _r6("priority"))
    return priority.rank_priorities(p)


def _stream_recs(spark, sf_dir):
    r2, edges, n = _edges_item_cf(spark, sf_dir)
    prio = priority.stream_priority(r2, edges, edges_bound=n)
    return r2, priority.stream_recs_table(prio, r2.select("userId"))


def q_recs_for_username(spark, sf_dir):
    r2, table = _stream_recs(spark, sf_dir)
    u = fx.users(spark, sf_dir)
    asked = u.join(r2.select("userId").distinct(), "userId", "left_semi").select("username")
    nested = joins.recs_for_username(asked, u, table)
    return nested.select("username", "userId", F.size("recs").alias("nRecs"))


def q_stream_products(spark, sf_dir):
    r2, table = _stream_recs(spark, sf_dir)
    u = fx.users(spark, sf_dir)
    asked = u.join(r2.select("userId").distinct(), "userId", "left_semi").select("username")
    out = serving.user_recs_to_products(asked, u, table, fx.products(spark, sf_dir), fx.ratings_r1(spark, sf_dir))
    return out.select("username", "rank", "productId", "name", _r6("recScore"), _r6("score"))


def q_top_k_per_user(spark, sf_dir):
    """W1 on fixed scores: mean R1 score per (user, product), top 20 per user."""
    r1 = fx.ratings_r1(spark, sf_dir)
    s = r1.groupBy("userId", "productId").agg(F.avg("score").alias("score"))
    top = ranking.top_k_per_key(s, "userId", 20)
    return top.select("userId", "productId", _r6("score"), "rank")


# --- model (rows-only checks) ------------------------------------------------------------

def _als_model(spark, sf_dir):
    r2 = fx.ratings_r2(spark, sf_dir)
    return r2, als_ops.als_train(r2)


def q_als_train(spark, sf_dir):
    _, model = _als_model(spark, sf_dir)
    return model.userFactors.select(F.col("id").alias("userId"), "features")


def q_item_factors(spark, sf_dir):
    _, model = _als_model(spark, sf_dir)
    return als_ops.item_factors(model)


def q_als_predict_pairs(spark, sf_dir):
    r2, model = _als_model(spark, sf_dir)
    return als_ops.als_predict_pairs(model, r2.select("userId", "productId", "score"))


def q_user_recs(spark, sf_dir):
    _, model = _als_model(spark, sf_dir)
    return ranking.explode_recs(als_ops.user_recs(model), key="userId")


def q_als_product_recs(spark, sf_dir):
    """Item-item lists from the ALS item factors: blocked cosine > 0.4, ranked."""
    _, model = _als_model(spark, sf_dir)
    factors = als_ops.item_factors(model).persist()
    edges = similarity.cosine_all_pairs(factors, n_items=factors.count())
    ranked = ranking.top_k_per_key(edges, "productId", None, item="simProductId")
    return ranked.select("productId", "simProductId", _r6("score"), "rank")


def q_offline_products(spark, sf_dir):
    r2, model = _als_model(spark, sf_dir)
    u = fx.users(spark, sf_dir)
    asked = u.join(r2.select("userId").distinct(), "userId", "left_semi").select("username")
    out = serving.user_recs_to_products(asked, u, als_ops.user_recs(model), fx.products(spark, sf_dir),
                                        fx.ratings_r1(spark, sf_dir))
    return out.select("username", "rank", "productId", "name", "recScore", "score")


def q_train_test_split(spark, sf_dir):
    train, test = als_ops.train_test_split(fx.ratings_r2(spark, sf_dir))
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .select("seq", "userId", "productId", "score", "split"))


def q_als_grid_search(spark, sf_dir):
    train, test = als_ops.train_test_split(fx.ratings_r2(spark, sf_dir))
    return als_ops.als_grid_search(spark, train, test)


def q_best_params(spark, sf_dir):
    return als_ops.best_params(q_als_grid_search(spark, sf_dir))


# --- model checks: what must hold of a fitted model, per user, product or pair ---------------

def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _rated_factors(spark, sf_dir):
    """R2 rows with both factors (uf, vf)."""
    r2, model = _als_model(spark, sf_dir)
    u = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("uf"))
    v = model.itemFactors.select(F.col("id").alias("productId"), F.col("features").alias("vf"))
    return r2, model, r2.select("userId", "productId", "score").join(u, "userId").join(v, "productId")


def q_als_normal_equations(spark, sf_dir):
    """M1: every user's factors solve the user's regularised normal equations over the item factors: the sum of
    (predicted - score) * item factors plus lambda * ratings * user factors vanishes (to single precision)."""
    _, _, rows = _rated_factors(spark, sf_dir)
    error = _dot("uf", "vf") - F.col("score")
    sums = rows.groupBy("userId").agg(
        F.count("*").alias("nRatings"), F.first("uf").alias("uf"),
        F.array(*[F.sum(error * F.col("vf")[i]) for i in range(ALS_RANK)]).alias("g"),
        F.sum(F.col("score") * F.sqrt(_dot("vf", "vf"))).alias("size"))
    rest = F.zip_with("g", "uf", lambda g, x: F.abs(g + ALS_REG * F.col("nRatings") * x))
    return sums.select("userId", "nRatings", (F.array_max(rest) <= 1e-3 * (1 + F.col("size"))).alias("solved"))


def q_als_factor_ranks(spark, sf_dir):
    """M4: every rated product has one vector of the model's rank."""
    _, model = _als_model(spark, sf_dir)
    return als_ops.item_factors(model).groupBy("productId").agg(
        F.count("*").alias("vectors"), F.max(F.size("features")).alias("rank"))


def q_als_predictions_are_products(spark, sf_dir):
    """M2: every pair's prediction is the inner product of its factors."""
    r2, model, rows = _rated_factors(spark, sf_dir)
    pairs = r2.select("userId", "productId", "score")
    predicted = als_ops.als_predict_pairs(model, pairs).groupBy("userId", "productId").agg(
        F.count("*").alias("n"), F.max("prediction").alias("prediction"))
    own = rows.groupBy("userId", "productId").agg(F.max(_dot("uf", "vf")).alias("product"))
    return predicted.join(own, ["userId", "productId"]).select(
        "userId", "productId", "n", (F.abs(F.col("prediction") - F.col("product")) <= 1e-4).alias("isProduct"))


def _recs_state(spark, sf_dir):
    """Per user of R2: size of the list, and whether it is sorted, positive, and made of inner products."""
    r2, model = _als_model(spark, sf_dir)
    listed = als_ops.user_recs(model)
    u = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("uf"))
    v = model.itemFactors.select(F.col("id").alias("productId"), F.col("features").alias("vf"))
    entries = listed.select("userId", F.posexplode("recs").alias("at", "r")).select(
        "userId", "at", F.col("r.productId").alias("productId"), F.col("r.score").alias("score"))
    exact = entries.join(u, "userId").join(v, "productId").groupBy("userId").agg(
        F.count("*").alias("n"), F.min("score").alias("least"), F.max(F.abs(_dot("uf", "vf") - F.col("score"))).alias("off"))
    falling = F.forall(F.sequence(F.lit(0), F.size("recs") - 1), lambda i: (i == 0) | (
        F.get("recs", i)["score"] <= F.get("recs", i - 1)["score"]))
    lists = listed.select("userId", falling.alias("sorted")).join(exact, "userId")
    good = F.col("sorted") & (F.col("n") <= USER_MAX_RECOMMENDATION) & (F.col("least") > 0) & (F.col("off") < 1e-6)
    users = r2.select("userId").distinct()
    return r2, model, users.join(lists, "userId", "left").select("userId", F.coalesce(good, F.lit(True)).alias("wellFormed"))


def q_user_recs_are_lists(spark, sf_dir):
    """M3, P5: every user's list has at most 20 positive entries, falling, each the inner product of its factors."""
    return _recs_state(spark, sf_dir)[2]


def q_als_product_recs_are_cosines(spark, sf_dir):
    """C1 on the model's factors: no listed pair is off its cosine or under the threshold. One row per rated product."""
    r2, model = _als_model(spark, sf_dir)
    factors = als_ops.item_factors(model).select("productId", F.col("features").alias("a"))
    edges = similarity.cosine_all_pairs(als_ops.item_factors(model))
    b = factors.select(F.col("productId").alias("simProductId"), F.col("a").alias("b"))
    off = edges.join(factors, "productId").join(b, "simProductId").groupBy("productId").agg(
        F.max(F.abs(cosine_expr("a", "b") - F.col("score"))).alias("off"), F.min("score").alias("least"))
    return r2.select("productId").distinct().join(off, "productId", "left").select(
        "productId", F.coalesce((F.col("off") < 1e-6) & (F.col("least") > SIM_THRESHOLD), F.lit(True)).alias("areCosines"))


def q_grid_has_its_minimum(spark, sf_dir):
    """The twelve grid points, each with an error, and the best of them has the least."""
    grid = q_als_grid_search(spark, sf_dir).persist()
    least = als_ops.best_params(grid).first()["rmse"]
    out = grid.select("rank", "lambda", ((F.col("rmse") > 0) & (F.col("rmse") >= least)).alias("ok"))
    rows = spark.createDataFrame(out.collect(), out.schema)     # 12 rows
    grid.unpersist()
    return rows


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # model checks
    "als_normal_equations": q_als_normal_equations,
    "als_factor_ranks": q_als_factor_ranks,
    "als_predictions_are_products": q_als_predictions_are_products,
    "user_recs_are_lists": q_user_recs_are_lists,
    "als_product_recs_are_cosines": q_als_product_recs_are_cosines,
    "grid_has_its_minimum": q_grid_has_its_minimum,
    # loaders
    "load_products": q_load_products,
    "load_ratings": q_load_ratings,
    # statistics
    "rate_more_products": q_rate_more_products,
    "rate_more_recently_products": q_rate_more_recently_products,
    "average_products": q_average_products,
    "distinct_users": q_distinct_users,
    "distinct_products": q_distinct_products,
    "rating_month_projection": q_rating_month_projection,
    "rating_triples": q_rating_triples,
    "epoch_to_yearmonth": q_epoch_to_yearmonth,
    "rmse": q_rmse,
    # top-N serving and lookups
    "hot_products": q_hot_products,
    "most_rated_products": q_most_rated_products,
    "first_match": q_first_match,
    "enrich_product_score": q_enrich_product_score,
    "product_info": q_product_info,
    "product_documents": q_product_documents,
    "search_products_by_name": q_search_products_by_name,
    "search_products_by_index": q_search_by_index,
    # ratings, events, users
    "normalise_rating_score": q_normalise_rating_score,
    "user_ratings": q_user_ratings,
    "recent_ratings_k": q_recent_ratings_k,
    "latest_rating_upsert": q_latest_rating_upsert,
    "latest_event_per_user": q_latest_event_per_user,
    "emit_rating_events": q_emit_rating_events,
    "extract_rating_log": q_extract_rating_log,
    "parse_rating_events": q_parse_rating_events,
    "valid_event_filter": q_valid_event_filter,
    "username_to_user_id": q_username_to_user_id,
    "user_by_name": q_user_by_name,
    "register_users": q_register_users,
    "rate_products": q_rate_products,
    # item-CF and lists
    "item_cf_recs": q_item_cf_recs,
    "rank_similar_products": q_rank_similar_products,
    "collect_recs_per_key": q_collect_recs_per_key,
    "explode_recs": q_explode_recs,
    "similarity_map": q_similarity_map,
    "recs_to_products": q_recs_to_products,
    "item_cf_products": q_item_cf_products,
    # dense vectors, content
    "product_recs": q_product_recs,
    "top_inner_products": q_top_inner_products,
    "cosine_similarity": q_cosine_similarity,
    "content_features": q_content_features,
    "content_based_recs": q_content_based_recs,
    "content_based_products": q_content_based_products,
    # online priority
    "neighbour_lookup": q_neighbour_lookup,
    "exclude_rated_products": q_exclude_rated_products,
    "top_k_candidates": q_top_k_candidates,
    "candidate_recent_cross": q_candidate_recent_cross,
    "pair_similarity_lookup": q_pair_similarity_lookup,
    "weighted_base_score": q_weighted_base_score,
    "boost_penalty_counts": q_boost_penalty_counts,
    "stream_priority": q_stream_priority,
    "sort_priority": q_sort_priority,
    "recs_for_username": q_recs_for_username,
    "stream_products": q_stream_products,
    "top_k_per_user": q_top_k_per_user,
    # model
    "als_train": q_als_train,
    "item_factors": q_item_factors,
    "als_predict_pairs": q_als_predict_pairs,
    "user_recs": q_user_recs,
    "als_product_recs": q_als_product_recs,
    "offline_products": q_offline_products,
    "train_test_split": q_train_test_split,
    "als_grid_search": q_als_grid_search,
    "best_params": q_best_params,
}
