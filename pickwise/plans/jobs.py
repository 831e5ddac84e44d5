"""The pipeline's programs as Spark jobs.

    load       products + ratings files -> products / ratings tables, and their rejects
    register   usernames -> users (new names only, Java-hash ids)
    rate       rate requests -> ratings (append) + rating log lines (the online job's input)
    stats      ratings -> rate_more_products, rate_more_recently_products, average_products
    offline    ratings -> user_recs (ALS top 20), product_recs (factor cosine > 0.4)
    itemcf     ratings -> item_cf_recs (co-occurrence cosine > 0.4)
    content    product text -> content_based_recs (TF-IDF cosine > 0.4)
    tune       ratings -> als_grid (rank, lambda, rmse) + best
    compact    ratings log, stream_recs -> the same, folded by key range
    online     rating-line stream -> stream_recs (keyed state + foreachBatch re-ranking)

Tables are Parquet directories under one root; the ratings are read once per
job and cached across its outputs. The neighbour lists (product_recs, item_cf_recs, content_based_recs) are
published as immutable versions laid out by product, so a running online job takes up a new model at its next
trigger, and reads of a few products open only their buckets. Usage:

    python -m pickwise.plans.jobs stats --root /shared/recs
"""

from __future__ import annotations

import argparse
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.operators import als as als_ops
from pickwise.operators import ranking, similarity, stats
from pickwise.plans.name_index import publish_name_index
from pickwise.sources import io
from pickwise.sources.keyed import publish_keyed
from pickwise.sources.upsert import DELTA, UpsertLog
from pickwise.sources.versions import folder_names

TABLES = {
    "products": "products", "ratings": "ratings",
    "rate_more": "rate_more_products", "rate_more_recently": "rate_more_recently_products",
    "average": "average_products", "user_recs": "user_recs", "product_recs": "product_recs",
    "itemcf": "item_cf_recs", "content": "content_based_recs", "stream_recs": "stream_recs",
    "als_grid": "als_grid", "users": "users", "rating_events": "rating_events",
}


def path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{TABLES[table]}"


def load_job(spark: SparkSession, products_file: str, ratings_file: str, root: str) -> None:
    """Parse the two delimited input files and store both tables. Loaded
    ratings get seq 0; later rate requests carry their arrival sequence. Lines that give no product or
    rating go to ``<table>_rejects`` with their reason and file. The load is the delta 'load' of the ratings log."""
    for table, read in (("products", io.read_products), ("ratings", io.read_ratings)):
        lines = read(spark, products_file if table == "products" else ratings_file).persist(StorageLevel.MEMORY_AND_DISK)
        valid = io.accepted(lines)
        if table == "products":
            io.write_overwrite(valid, path(root, table))
            publish_name_index(spark, root.rstrip("/"), valid)
        else:
            ratings_log(spark, root).append(valid.withColumn("seq", F.lit(0).cast("bigint")), "request", "load")
        io.write_overwrite(io.rejected(lines), path(root, table) + "_rejects")
        lines.unpersist()


def ratings_log(spark: SparkSession, root: str) -> UpsertLog:
    """The ratings as a log of requests (W5): of a (user, product)'s ratings the latest score counts, with the first timestamp."""
    return UpsertLog(spark, path(root, "ratings"), keys=["userId", "productId"], latest={"score": T.DoubleType()},
                     order=["timestamp", "seq"], first={"firstTimestamp": "timestamp"}, bucket_key="userId")


def current_ratings(spark: SparkSession, root: str) -> DataFrame:
    """userId, productId, score (latest), timestamp (first) of every rated pair: the compacted log, and the requests
    since, of which only the touched buckets are grouped again."""
    return ratings_log(spark, root).read().select("userId", "productId", "score", F.col("firstTimestamp").alias("timestamp"))


def compact_job(spark: SparkSession, root: str) -> dict[str, int]:
    """Fold the deltas of the ratings log and of the stream's lists; returns how many of each. The ratings' deltas
    stay, since the online job's history stream reads them."""
    from pickwise.streaming.pipeline import compact_stream_recs
    log = ratings_log(spark, root)
    folded = {"ratings": log.compact(), "stream_recs": compact_stream_recs(spark, path(root, "stream_recs"))}
    log.retire()
    return folded


def _ratings(spark: SparkSession, root: str) -> DataFrame:
    return current_ratings(spark, root).persist(StorageLevel.MEMORY_AND_DISK)


def register_job(spark: SparkSession, root: str, usernames: DataFrame, now_epoch: int) -> int:
    """Append the usernames not yet registered; returns how many were new."""
    from pickwise.plans.serving import register_users
    users_path = path(root, "users")
    if folder_names(spark, users_path):
        existing = io.read_table(spark, users_path).select("username")
    else:  # the first registration creates the table
        existing = spark.createDataFrame([], "username string")
    new = register_users(usernames, existing, now_epoch).persist()
    n = new.count()
    if n:
        io.rating_append(new, users_path)
    new.unpersist()
    return n


def rate_job(spark: SparkSession, root: str, requests: DataFrame, request: str | None = None) -> str:
    """Rate requests (username, productId, rawScore 1..10, timestamp, seq):
    unknown usernames are skipped; scores are halved (HALF_UP, 2 digits); the
    ratings go to the log and their log lines to the
    rating-event directory the online job reads, each into the folder of this ``request`` (a new name by default).
    A job that died between the two is run again under the same name: it writes both folders anew, so that no rating
    is lost or counted twice. Returns the name."""
    from pickwise.plans.serving import rate_products
    request = request or uuid.uuid4().hex
    users = io.read_table(spark, path(root, "users")).select("userId", "username")
    rated = rate_products(requests, users).persist(StorageLevel.MEMORY_AND_DISK)
    ratings_log(spark, root).append(rated.select("userId", "productId", "score", "timestamp", "seq"), "request", request)
    rated.select(F.concat_ws("|", "value", F.col("seq").cast("string")).alias("value")) \
        .write.mode("overwrite").text(f"{path(root, 'rating_events')}/request={request}")
    rated.unpersist()
    return request


def stats_job(spark: SparkSession, root: str) -> None:
    """Statistics: three aggregates over one cached scan. The
    per-month table is partitioned by yearmonth, so the "hot" read prunes to
    the newest months."""
    r = _ratings(spark, root)
    io.write_overwrite(stats.rate_more_products(r), path(root, "rate_more"))
    io.write_overwrite(stats.rate_more_recently_products(r), path(root, "rate_more_recently"),
                       partition_by=["yearmonth"])
    io.write_overwrite(stats.average_products(r), path(root, "average"))
    r.unpersist()


def offline_job(spark: SparkSession, root: str) -> None:
    """Offline model: ALS -> per-user top 20 (> 0) and item-factor cosine lists."""
    r = _ratings(spark, root)
    model = als_ops.als_train(r)
    io.write_overwrite(als_ops.user_recs(model), path(root, "user_recs"))
    factors = als_ops.item_factors(model).persist(StorageLevel.MEMORY_AND_DISK)
    edges = similarity.cosine_all_pairs(factors, n_items=factors.count())
    publish_lists(spark, root, "product_recs", edges)
    factors.unpersist()
    r.unpersist()


def publish_lists(spark: SparkSession, root: str, table: str, edges: DataFrame) -> str:
    """Neighbour lists from (productId, simProductId, score), as the next version of a list table."""
    lists = ranking.collect_recs_per_key(edges).persist(StorageLevel.MEMORY_AND_DISK)
    version = publish_keyed(spark, path(root, table), lists, "productId")
    lists.unpersist()
    return version


def itemcf_job(spark: SparkSession, root: str) -> None:
    """Item-CF lists."""
    r = _ratings(spark, root)
    publish_lists(spark, root, "itemcf", similarity.item_cf_edges(r))
    r.unpersist()


def content_job(spark: SparkSession, root: str, text_col: str = "tags") -> None:
    """Content-based lists from the product text (tags by default, '|' as a word break)."""
    p = io.read_table(spark, path(root, "products"))
    docs = p.select("productId", F.regexp_replace(F.col(text_col), r"\|", " ").alias("text"))
    publish_lists(spark, root, "content", similarity.content_based_edges(docs))


def tune_job(spark: SparkSession, root: str) -> DataFrame:
    """Model tuning: the 12-point grid, written; returns the best row."""
    r = _ratings(spark, root)
    train, test = als_ops.train_test_split(r)
    grid = als_ops.als_grid_search(spark, train, test)
    io.write_overwrite(grid, path(root, "als_grid"))
    r.unpersist()
    return als_ops.best_params(spark.read.parquet(path(root, "als_grid")))


def online_job(spark: SparkSession, root: str, source_dir: str | None = None, topic: str | None = None,
               bootstrap_servers: str | None = None, checkpoint: str | None = None, trigger: dict | None = None,
               matrix: str = "product_recs"):
    """Online re-ranking: start the stream; returns its query. ``matrix`` is the list table whose version in use
    gives candidates and similarities: the offline job's factor lists, or "itemcf"."""
    from pickwise.session import stream_checkpoint_path
    from pickwise.streaming.pipeline import OnlinePaths, rating_stream_query
    # per-user state (queue + rated set) lives in RocksDB, off the JVM heap,
    # unless the cluster chose a provider already (it must not change across restarts)
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, None):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fmt = "kafka" if topic else "text"
    lines = io.rating_stream_source(spark, fmt, source_dir, topic, bootstrap_servers)
    recs = path(root, "stream_recs")
    paths = OnlinePaths(lists=path(root, matrix), recs=recs, rejects=recs + "_rejects", metrics=recs + "_metrics")
    ckpt = checkpoint or stream_checkpoint_path(spark, "pickwise-online")
    # the stored ratings (loaded history + rate-job appends) feed every user's rated set
    return rating_stream_query(lines, paths, ckpt, trigger, history_path=f"{path(root, 'ratings')}/{DELTA}")


def main(argv=None):
    ap = argparse.ArgumentParser(prog="pickwise.plans.jobs")
    ap.add_argument("job", choices=["load", "register", "rate", "stats", "offline", "itemcf", "content", "tune", "compact", "online"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--products")
    ap.add_argument("--ratings")
    ap.add_argument("--source")
    ap.add_argument("--topic")
    ap.add_argument("--bootstrap-servers")
    ap.add_argument("--matrix", choices=["product_recs", "itemcf"], default="product_recs", help="list table of the online job")
    ap.add_argument("--usernames", help="register: a text file, one username a line")
    ap.add_argument("--requests", help="rate: a Parquet folder (username, productId, rawScore, timestamp, seq)")
    ap.add_argument("--request", help="rate: name of this request, for running it again")
    ap.add_argument("--checkpoint", help="stream checkpoint folder; default: pickwise-online under spark.checkpoint.dir")
    a = ap.parse_args(argv)
    from pickwise.session import build_session
    spark = build_session(app_name=f"pickwise-{a.job}")
    if a.job == "load":
        load_job(spark, a.products, a.ratings, a.root)
    elif a.job == "register":
        register_job(spark, a.root, spark.read.text(a.usernames).select(F.col("value").alias("username")), int(time.time()))
    elif a.job == "rate":
        rate_job(spark, a.root, spark.read.parquet(a.requests), a.request)
    elif a.job == "stats":
        stats_job(spark, a.root)
    elif a.job == "offline":
        offline_job(spark, a.root)
    elif a.job == "itemcf":
        itemcf_job(spark, a.root)
    elif a.job == "content":
        content_job(spark, a.root)
    elif a.job == "compact":
        print(compact_job(spark, a.root))
    elif a.job == "tune":
        tune_job(spark, a.root).show()
    else:
        online_job(spark, a.root, a.source, a.topic, a.bootstrap_servers, checkpoint=a.checkpoint,
                   matrix=a.matrix).awaitTermination()


if __name__ == "__main__":
    main()
