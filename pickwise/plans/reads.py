"""Read side over the job tables (the serving layer of the pipeline).

Each call answers a DataFrame of keys (product ids, usernames, or a search
pattern) from the tables the jobs wrote under ``root``, enriching product
rows with the stored mean score. Nothing is recomputed from raw ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.operators import joins
from pickwise.operators.ranking import top_n
from pickwise.plans import name_index
from pickwise.plans.jobs import path
from pickwise.plans.serving import PRODUCT_COLS
from pickwise.schemas import HOT_DEFAULT_NUM
from pickwise.sources.keyed import current_keyed


def _t(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(path(root, table))


def _enriched(spark: SparkSession, root: str) -> DataFrame:
    return joins.enrich_product_score(_t(spark, root, "products"), _t(spark, root, "average"))


def _serve_ranked(spark: SparkSession, root: str, ranked: DataFrame, bound: int | None) -> DataFrame:
    prods = _t(spark, root, "products")
    avg = _t(spark, root, "average")
    if bound is not None:
        keys = joins.bounded_broadcast(ranked.select("productId").distinct(), bound)
        prods = prods.join(keys, "productId", "left_semi")
        avg = avg.join(keys, "productId", "left_semi")
    out = joins.enrich_product_score(joins.recs_to_products(ranked, prods, bound), avg)
    return out.select("rank", *PRODUCT_COLS)


def hot(spark: SparkSession, root: str, n: int = HOT_DEFAULT_NUM) -> DataFrame:
    """Newest-month rows by count, limited before de-duplication (best rank kept)."""
    top = top_n(_t(spark, root, "rate_more_recently"), n,
                [F.col("yearmonth").desc(), F.col("count").desc(), F.col("productId").asc()])
    return _serve_ranked(spark, root, top.groupBy("productId").agg(F.min("rank").alias("rank")), n)


def most_rated(spark: SparkSession, root: str, n: int = HOT_DEFAULT_NUM) -> DataFrame:
    top = top_n(_t(spark, root, "rate_more"), n, [F.col("count").desc(), F.col("productId").asc()])
    return _serve_ranked(spark, root, top.select("productId", "rank"), n)


def _lists(spark: SparkSession, root: str, table: str, ids: DataFrame, k: int | None) -> DataFrame:
    nested = current_keyed(spark, path(root, table), "productId").of_keys(ids)  # only the buckets of these products
    rows = (nested.select(F.col("productId").alias("queryProductId"), F.posexplode("recs").alias("pos", "r"))
            .select("queryProductId", (F.col("pos") + 1).alias("rank"),
                    F.col("r.productId").alias("productId"), F.col("r.score").alias("recScore")))
    if k is not None:
        rows = rows.filter(F.col("rank") <= k)
    return rows.join(_enriched(spark, root), "productId")


def item_cf(spark: SparkSession, root: str, ids: DataFrame, k: int | None = None) -> DataFrame:
    return _lists(spark, root, "itemcf", ids, k)


def content_based(spark: SparkSession, root: str, ids: DataFrame, k: int | None = None) -> DataFrame:
    return _lists(spark, root, "content", ids, k)


def product_info(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    k = ids.select(F.col("productId").cast("int")).distinct()
    found = current_keyed(spark, f"{root.rstrip('/')}/products_by_id", "productId").of_keys(k)  # only these ids' buckets
    return k.join(joins.enrich_product_score(found, _t(spark, root, "average")), "productId", "left").select(*PRODUCT_COLS)


def search(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    found = name_index.search(spark, root.rstrip("/"), pattern)
    return joins.enrich_product_score(found, _t(spark, root, "average")).select(*PRODUCT_COLS)


def _user_lists(spark: SparkSession, root: str, recs: DataFrame, usernames: DataFrame,
                k: int | None) -> DataFrame:
    nested = joins.recs_for_username(usernames, _t(spark, root, "users"), recs)
    rows = (nested.select("username", F.posexplode("recs").alias("pos", "r"))
            .select("username", (F.col("pos") + 1).alias("rank"), F.col("r.productId").alias("productId"),
                    F.col("r.score").alias("recScore")))
    if k is not None:
        rows = rows.filter(F.col("rank") <= k)
    return rows.join(_enriched(spark, root), "productId")


def offline(spark: SparkSession, root: str, usernames: DataFrame, k: int | None = None) -> DataFrame:
    return _user_lists(spark, root, _t(spark, root, "user_recs"), usernames, k)


def stream(spark: SparkSession, root: str, usernames: DataFrame, k: int | None = None) -> DataFrame:
    from pickwise.streaming.pipeline import read_stream_recs
    return _user_lists(spark, root, read_stream_recs(spark, path(root, "stream_recs")), usernames, k)
