"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.session import scratch_path

#: A run of what separates words: ASCII space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared checkpoint folder and read it
    back: its rows (and anything nondeterministic in them, such as row
    positions) stay fixed whatever executor is lost later, and nothing above
    is computed twice. The files live as long as the application's checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positional(df: DataFrame) -> DataFrame:
    """The same rows with columns named c0, c1, ...: working columns added
    next to them can't clash with a caller's column names."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def column_at(df: DataFrame, name: str) -> str:
    """Name in ``positional(df)`` of the column ``name`` (exact case first, else
    the session's case-insensitive match)."""
    names = df.columns
    at = names.index(name) if name in names else [c.lower() for c in names].index(name.lower())
    return f"c{at}"


def words_of(text: Column) -> Column:
    """Words of a text in order; null or blank text: no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(sizes: DataFrame, on: str) -> DataFrame:
    """(``on``, salts) of the keys with more rows than an average partition would have, from ``sizes`` (``on``, n): at
    most as many as there are shuffle partitions. ``salts``: how many partitions a key's rows would fill."""
    parts = shuffle_partitions(sizes.sparkSession)
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = sizes.where(F.col("n") * parts > total).select(on, F.ceil(F.col("n") * parts / total).cast("int").alias("salts"))
    return sizes.sparkSession.createDataFrame(hot.collect(), hot.schema)


def salted_join(left: DataFrame, right: DataFrame, on: str, by: list[str], sizes: DataFrame | None = None,
                how: str = "inner") -> DataFrame:
    """``left`` joined (``how``: inner or left) with the smaller ``right`` on the column ``on``, where single keys may hold
    a large share of ``left``. A key with more rows than an average partition is dealt to several by
    the hash of the columns ``by``, and its rows of ``right`` are copied to each. There are
    at most as many such keys as shuffle partitions, so their broadcast is bounded, and at most twice as many copies.
    ``sizes`` (``on``, n): rows of ``left`` for each key, where already counted."""
    if sizes is None:
        sizes = left.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(sizes, on))
    salts = F.coalesce("salts", F.lit(1))
    dealt = left.join(hot, on, "left").withColumn("salt", F.pmod(F.xxhash64(*by), salts).cast("int")).drop("salts")
    copied = right.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt.join(copied, [on, "salt"], how).drop("salt")
