"""Tables laid out by key, for reads of a few keys.

A key's rows lie in one of ``n`` partition folders by the key's hash (``<folder>/buckets=<n>/bucket=<b>/``), sorted by
key inside. A read for given keys takes only the folders those keys fall into (partition pruning), and within a
file the key's range in the footer leaves out row groups. The number of buckets is part of the path, so a
reader needs nothing else. The keys' side is small; joined as the broadcast side, the table isn't shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.sources.versions import current_path, folder_names, publish

BUCKETS = 64
#: Buckets for a table of many rows: about so many rows each, at most ``MOST_BUCKETS``.
ROWS_PER_BUCKET, MOST_BUCKETS = 250_000, 4096


def bucket_of(key: Column | str, buckets: int) -> Column:
    """Bucket of a key; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_for(rows: int) -> int:
    return max(BUCKETS, min(MOST_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def write_keyed(df: DataFrame, folder: str, key: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` by ``key``: one shuffle on the bucket, one file or a few for each."""
    (df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").sortWithinPartitions("bucket", key)
     .write.partitionBy("bucket").parquet(f"{folder}/buckets={buckets}"))


class KeyedTable:
    """One table written by ``write_keyed``; its files are listed once."""

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.key = key
        layout = [n for n in folder_names(spark, folder) if n.startswith("buckets=")]
        if len(layout) != 1:
            raise FileNotFoundError(f"{folder} isn't a keyed table")
        self.buckets = int(layout[0].split("=")[1])
        self.table = spark.read.parquet(f"{folder}/{layout[0]}")

    def all(self) -> DataFrame:
        return self.table.drop("bucket")

    def touched(self, keys: DataFrame, name: str | None = None) -> list[int]:
        """Buckets of the keys in the column ``name`` of ``keys``: at most ``buckets`` numbers."""
        rows = keys.select(bucket_of(F.col(name or self.key).cast(self.table.schema[self.key].dataType), self.buckets).alias("b"))
        return sorted(r[0] for r in rows.distinct().collect())

    def part(self, buckets: list[int]) -> DataFrame:
        """Only the rows in ``buckets``; other folders aren't opened."""
        return self.table.where(F.col("bucket").isin(buckets)).drop("bucket")

    def of_keys(self, keys: DataFrame, name: str | None = None) -> DataFrame:
        """Rows whose key is in ``keys``, from the buckets of those keys."""
        wanted = keys.select(F.col(name or self.key).cast(self.table.schema[self.key].dataType).alias(self.key)).distinct()
        return self.part(self.touched(wanted)).join(wanted, self.key, "left_semi")


def publish_keyed(spark: SparkSession, table: str, df: DataFrame, key: str, buckets: int | None = None) -> str:
    """Publish ``df`` as the next version of a table laid out by key; returns the version's id. Without
    ``buckets``, their number follows the rows, counted once (``df`` should be cheap to read twice)."""
    n = buckets or buckets_for(df.count())
    return publish(spark, table, lambda folder: write_keyed(df, folder, key, n))


def current_keyed(spark: SparkSession, table: str, key: str) -> KeyedTable:
    """The version in use of a table laid out by key."""
    return KeyedTable(spark, current_path(spark, table), key)
