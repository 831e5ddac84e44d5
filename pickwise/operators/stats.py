"""Batch statistics.

Each is one partial+final hash aggregate over a pruned scan. Ordering is left
to the read queries (top-N), so no global sort is paid to store a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions import epoch_to_yearmonth


def rating_month_projection(ratings: DataFrame) -> DataFrame:
    """productId, score, yearmonth."""
    return ratings.select("productId", "score", epoch_to_yearmonth("timestamp").alias("yearmonth"))


def rating_triples(ratings: DataFrame) -> DataFrame:
    """userId, productId, score."""
    return ratings.select("userId", "productId", "score")


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """A1: productId, count (number of ratings)."""
    return ratings.groupBy("productId").agg(F.count("productId").alias("count"))


def rate_more_recently_products(ratings: DataFrame) -> DataFrame:
    """A2: productId, count, yearmonth per (month, product)."""
    return (rating_month_projection(ratings)
            .groupBy("yearmonth", "productId")
            .agg(F.count("productId").alias("count"))
            .select("productId", "count", "yearmonth"))


def average_products(ratings: DataFrame) -> DataFrame:
    """A3: productId, avg (mean score)."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def distinct_users(ratings: DataFrame) -> DataFrame:
    """A4."""
    return ratings.select("userId").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    """A4."""
    return ratings.select("productId").distinct()


def rmse(pairs: DataFrame, actual: str = "score", predicted: str = "prediction") -> DataFrame:
    """One row, sqrt(mean((actual - predicted)^2))."""
    err = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return pairs.agg(F.sqrt(F.avg(err * err)).alias("rmse"))
