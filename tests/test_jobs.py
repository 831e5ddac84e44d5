"""The pipeline programs end to end on files in the reference's layouts."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pickwise.operators import ranking, similarity, stats
from pickwise.plans import jobs
from pickwise.sources import fixtures as fx
from pickwise.sources.keyed import current_keyed


def _write_inputs(spark, tmp):
    p = fx.products(spark, SF_SMALL)
    (p.select(F.concat_ws("^", F.col("productId").cast("string"), "name", F.lit("1,2"), F.lit("B00"),
                          "imageUrl", "categories", "tags").alias("value"))
     .write.text(f"{tmp}/products"))
    r2 = fx.ratings_r2(spark, SF_SMALL)
    (r2.select(F.concat_ws(",", F.col("userId").cast("string"), F.col("productId").cast("string"),
                           F.col("score").cast("string"), F.col("timestamp").cast("string")).alias("value"))
     .write.text(f"{tmp}/ratings"))
    return p, r2


def test_load_stats_itemcf_offline_content(spark, tmpdir_path):
    p, r2 = _write_inputs(spark, tmpdir_path)
    root = f"{tmpdir_path}/tables"
    jobs.load_job(spark, f"{tmpdir_path}/products", f"{tmpdir_path}/ratings", root)
    assert spark.read.parquet(jobs.path(root, "products")).count() == p.count()
    assert spark.read.parquet(jobs.path(root, "ratings") + "/delta").count() == r2.count()
    for table in ("products", "ratings"):
        assert spark.read.parquet(jobs.path(root, table) + "_rejects").count() == 0

    jobs.stats_job(spark, root)
    got = {r["productId"]: r["count"] for r in spark.read.parquet(jobs.path(root, "rate_more")).collect()}
    # statistics count current ratings: one per (user, product) after the upsert
    current = ranking.latest_rating_upsert(r2)
    want = {r["productId"]: r["count"] for r in stats.rate_more_products(current).collect()}
    assert got == want
    months = spark.read.parquet(jobs.path(root, "rate_more_recently"))
    assert "yearmonth" in months.columns and months.count() > 0

    jobs.itemcf_job(spark, root)
    nested = current_keyed(spark, jobs.path(root, "itemcf"), "productId").all()
    listed = nested.select("productId", F.explode("recs.productId").alias("simProductId")).collect()
    assert {tuple(r) for r in listed} == {(r["productId"], r["simProductId"]) for r in similarity.item_cf_edges(r2).collect()}

    jobs.offline_job(spark, root)
    ur = spark.read.parquet(jobs.path(root, "user_recs")).collect()
    assert ur and all(0 < len(r["recs"]) <= 20 for r in ur)
    pr = current_keyed(spark, jobs.path(root, "product_recs"), "productId").all().collect()
    assert all(e["score"] > 0.4 for r in pr for e in r["recs"])

    jobs.content_job(spark, root)
    cb = current_keyed(spark, jobs.path(root, "content"), "productId").all().collect()
    assert all(e["productId"] != r["productId"] for r in cb for e in r["recs"])

    # write side: register the customers, rate with the event stream's requests,
    # then the online job consumes the rating-event lines the rate job emitted
    users = fx.users(spark, SF_SMALL)
    assert jobs.register_job(spark, root, users.select("username"), 1700000000) == users.count()
    assert jobs.register_job(spark, root, users.select("username"), 1700000001) == 0
    raw = fx.rating_events_raw(spark, SF_SMALL)
    requests = raw.join(users, "userId").select("username", "productId", "rawScore", "timestamp", "seq")
    name = jobs.rate_job(spark, root, requests)
    assert jobs.rate_job(spark, root, requests, request=name) == name      # run again: nothing doubles
    current = jobs.current_ratings(spark, root)
    assert spark.read.parquet(jobs.path(root, "ratings") + "/delta").count() == r2.count() + requests.count()
    n_pairs = r2.select("userId", "productId").distinct().count()
    assert current.count() == 2 * n_pairs          # loaded ids + the hash ids of the registered names
    query = jobs.online_job(spark, root, source_dir=jobs.path(root, "rating_events"),
                            checkpoint=f"{tmpdir_path}/ockpt", trigger={"availableNow": True})
    query.awaitTermination(300)
    assert query.exception() is None
    from pickwise.streaming.pipeline import read_stream_recs
    recs = read_stream_recs(spark, jobs.path(root, "stream_recs"))
    assert recs.count() == r2.select("userId").distinct().count()

    # compaction leaves both logs' contents as they are
    before = sorted(tuple(r) for r in jobs.current_ratings(spark, root).collect())
    lists = sorted((r["userId"], str(r["recs"])) for r in recs.collect())
    folded = jobs.compact_job(spark, root)
    assert folded["ratings"] == 2 and folded["stream_recs"] >= 1
    assert sorted(tuple(r) for r in jobs.current_ratings(spark, root).collect()) == before
    again = read_stream_recs(spark, jobs.path(root, "stream_recs"))
    assert sorted((r["userId"], str(r["recs"])) for r in again.collect()) == lists
    assert jobs.compact_job(spark, root) == {"ratings": 0, "stream_recs": 0}

    # read side over the stored tables
    from pickwise.plans import reads
    jobs.stats_job(spark, root)
    jobs.offline_job(spark, root)
    names = users.select("username")
    hot = reads.hot(spark, root, 5).collect()
    assert 0 < len(hot) <= 5 and sorted(r["rank"] for r in hot) == sorted(set(r["rank"] for r in hot))
    assert [r["rank"] for r in reads.most_rated(spark, root, 5).orderBy("rank").collect()] == [1, 2, 3, 4, 5]
    ids = spark.createDataFrame([(0,), (1,), (10**6,)], "productId int")
    info = {r["productId"]: r for r in reads.product_info(spark, root, ids).collect()}
    assert info[10**6]["name"] is None and info[0]["name"] is not None
    assert reads.item_cf(spark, root, ids).select("queryProductId").distinct().count() == 2
    assert reads.item_cf(spark, root, ids, k=3).groupBy("queryProductId").count() \
        .agg(F.max("count")).first()[0] <= 3
    assert reads.content_based(spark, root, ids).count() >= 0
    want_search = p.filter(F.col("name").rlike("ring")).count()
    assert reads.search(spark, root, "ring").count() == want_search
    off = reads.offline(spark, root, names, k=3)
    assert off.count() > 0 and off.groupBy("username").count().agg(F.max("count")).first()[0] <= 3
    assert reads.stream(spark, root, names).select("username").distinct().count() == \
        r2.select("userId").distinct().count()
