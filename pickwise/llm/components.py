"""Connected components of a link table, by alternating large and small stars.

Every round replaces links by links to smaller neighbours, until each vertex is
linked to the smallest vertex of its component alone. A round is two groupings and
two joins on the links; a vertex with very many links is pre-aggregated, and its join
is split by adaptive execution. Nothing but a count and a checksum reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` has a < b: b's smaller neighbours are linked to the least of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(least, "b")
    return (joined.where(F.col("a") > F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
            .union(least.select(F.col("m").alias("a"), "b")).distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def components(links: DataFrame) -> DataFrame:
    """(vertex, component): every vertex of ``links`` (a, b; a < b) with the smallest
    vertex of its component. No links: no rows."""
    now, before = written(links.select("a", "b").distinct(), "links"), None
    state = _state(now)
    while state != before:
        now, before = written(_small_star(_large_star(now)), "links"), state
        state = _state(now)
    return (now.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
            .union(now.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct()))
