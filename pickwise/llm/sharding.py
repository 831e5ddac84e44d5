"""Balanced contiguous shards from global byte prefix sums.

Every row weighs its text's UTF-8 bytes plus one. Rows are put in the global
order of their key, range-partitioned into blocks; the blocks' totals give every
block the bytes and rows that precede it, a running sum inside the block gives
every row its place on the global byte line, and the line is cut at equal
targets. Only (key, size, checksum) is shuffled, never a text.

Defined results: null text weighs 1 (checksum 0); rows with a null key come
first; rows with equal keys are neighbours in a fixed but unspecified order (a
key that holds a third of all rows is split over blocks and shards by row
position); an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.common import shuffle_partitions, written

#: Rows of about 40 bytes in one block, at which more blocks are made.
ROWS_PER_BLOCK = 1_000_000


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                   rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards are contiguous in key
    order and each is within one largest row of the mean size; ``slot`` counts
    a shard's rows from 0 without a gap."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("pos")), "shard-sizes")
    n_blocks = max(shuffle_partitions(spark), -(-narrow.count() // rows_per_block))
    blocks = written(narrow.repartitionByRange(n_blocks, F.col("doc_id").asc_nulls_first(), F.col("pos"))
                     .withColumn("block", F.spark_partition_id()), "shard-blocks")
    # one row a block: the window below sees n_blocks rows
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("block").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"))
    starts = totals.select("block", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("r").over(before), F.lit(0)).alias("rows_before"))
    total = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    inside = Window.partitionBy("block").orderBy(F.col("doc_id").asc_nulls_first(), F.col("pos"))
    end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("bytes_before")
    nth = F.row_number().over(inside) - F.lit(1) + F.col("rows_before")
    # a row belongs to the shard in which its middle byte falls; doubled to stay in integers
    middle = f"least({n_shards} - 1, ((2 * row_end - size) * {n_shards}) div {max(1, 2 * total)})"
    placed = written(
        blocks.join(F.broadcast(starts), "block")
        .select("doc_id", "size", "text_crc32", end.alias("row_end"), nth.alias("nth"))
        .select("doc_id", "size", "text_crc32", "nth", F.expr(middle).cast("int").alias("shard")), "shard-rows")
    firsts = placed.groupBy("shard").agg(F.min("nth").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("nth") - F.col("first")).alias("slot"))
