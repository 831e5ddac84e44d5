"""Views over the driver's test tables that stand in for the pipeline's inputs.

R1  ratings for the batch statistics      (lineitem x orders)
R2  ratings for similarity/online/ALS     (events)
PR  products                              (part)
V   item vectors                          (embeddings)
D   product text                          (documents)
U   users                                 (customer)
E   rating event lines                    (R2 formatted, plus derived malformed lines)

Every view selects only the columns it needs, so Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.functions import epoch_seconds, normalise_rating_score, rating_line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """For CPU-heavy per-row work (tokenising whole texts): when the scan yields
    fewer partitions than the cluster has cores (a file with one row group),
    spread the rows round-robin. A scan that is already split is left alone,
    so at scale this adds no shuffle."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def ratings_r1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, productId, score (1..5), timestamp (epoch s)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("userId"),
                    F.col("l_partkey").cast("int").alias("productId"),
                    (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("score"),
                    epoch_seconds("l_shipdate").alias("timestamp")))


def rating_events_raw(spark: SparkSession, sf_dir: str, extra_cols: tuple = ()) -> DataFrame:
    """R2 before normalisation: seq, userId, productId, rawScore (UI 1..10), timestamp, ts."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props", *extra_cols)
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("productId"),
        F.least(F.lit(10.0), F.lit(1.0) + F.floor(F.col("value") / 10)).cast("double").alias("rawScore"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("ts"),
        *extra_cols,
    )


def ratings_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, userId, productId, score (0.5..5), timestamp, ts (full precision)."""
    raw = rating_events_raw(spark, sf_dir)
    return raw.select("seq", "userId", "productId",
                      normalise_rating_score("rawScore").alias("score"), "timestamp", "ts")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productId, name, imageUrl, categories, tags."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    tags = F.array_join(F.concat(F.split(F.col("p_name"), " "), F.array(F.col("p_brand"), F.col("p_type"))), "|")
    return p.select(F.col("p_partkey").cast("int").alias("productId"),
                    F.col("p_name").alias("name"),
                    F.lit("").alias("imageUrl"),
                    F.concat_ws("|", "p_type", "p_brand").alias("categories"),
                    tags.alias("tags"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productId, features ARRAY<FLOAT>."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").cast("int").alias("productId"), F.col("embedding").alias("features"))


def product_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productId, text (whole document)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spread(d.select(F.col("doc_id").cast("int").alias("productId"), F.col("text")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, username (c_name is unique)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.select(F.col("c_custkey").cast("int").alias("userId"), F.col("c_name").alias("username"))


def rating_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: ``seq, value`` lines. Every R2 row formatted with the log prefix, plus
    malformed lines derived from the data: 'error' events also appear with a
    non-numeric score, 'signup' events also appear truncated to three fields.
    One scan of ``events``; the three branches share it."""
    r2 = (rating_events_raw(spark, sf_dir, ("event_type",))
          .withColumn("score", normalise_rating_score("rawScore")))
    uid, pid = F.col("userId").cast("string"), F.col("productId").cast("string")
    value = F.explode(F.array_compact(F.array(
        rating_line("userId", "productId", "score", "timestamp"),
        F.when(F.col("event_type") == "error",
               F.concat_ws("|", uid, pid, F.lit("x"), F.col("timestamp").cast("string"))),
        F.when(F.col("event_type") == "signup",
               F.concat_ws("|", uid, pid, F.col("score").cast("string"))),
    )))
    return r2.select(F.col("seq"), value.alias("value"))
