"""Sources and sinks.

Parquet is the store. The format and options of the table readers/writers are
arguments, so a document-store or Kafka connector can be plugged in where its
package is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.functions import normalise_epoch, rating_line, strip_rating_prefix
from pickwise.schemas import PRODUCT_FILE, RATING_PREFIX


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """line, file, and the line's fields ``a`` (an array, split once)."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                                        F.split("value", sep, -1).alias("a"))


def _with_reasons(lines: DataFrame, of_fields) -> DataFrame:
    """``lines`` with the struct ``row`` and ``reason``, null where the line is good. One generator types a line, so
    that neither is computed again by what filters on it."""
    return lines.select("line", "file", F.inline(F.transform(F.array("a"), of_fields)))


def accepted(lines: DataFrame) -> DataFrame:
    """The typed rows of the good lines of ``read_products`` or ``read_ratings``."""
    return lines.where(F.col("reason").isNull()).select("row.*")


def rejected(lines: DataFrame) -> DataFrame:
    """line, file, reason of the others: accepted and rejected lines together are the input, each line once."""
    return lines.where(F.col("reason").isNotNull()).select("line", "file", "reason")


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Line, file, row, reason of a '^'-separated product file, 7 fields; row keeps 0, 1, 4, 5, 6, trimmed.

    There is no quoting: names may hold a literal '"' that a plain split keeps.
    Missing trailing fields read as '' (an empty tag list is legal); a blank line or a bad id is rejected."""
    names = PRODUCT_FILE.names

    def of_fields(a: Column) -> Column:
        def text(name: str) -> Column:
            return F.trim(F.coalesce(F.get(a, F.lit(names.index(name))), F.lit(""))).alias(name)

        number = F.trim(F.get(a, F.lit(0))).try_cast("int")
        reason = (F.when((F.size(a) == 1) & (F.trim(F.get(a, F.lit(0))) == ""), "blank line")
                  .when(number.isNull(), "bad productId"))
        row = F.struct(number.alias("productId"), text("name"), text("imageUrl"), text("categories"), text("tags"))
        return F.struct(row.alias("row"), reason.alias("reason"))

    return _with_reasons(_lines(spark, path, r"\^"), of_fields)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Line, file, row, reason of ',' separated ``userId,productId,score,timestamp``; a missing field or a bad
    number (NaN included) is rejected, the first bad field named."""
    kinds = (("userId", "int"), ("productId", "int"), ("score", "double"), ("timestamp", "bigint"))

    def of_fields(a: Column) -> Column:
        numbers = {n: F.trim(F.get(a, F.lit(i))).try_cast(t) for i, (n, t) in enumerate(kinds)}
        reason = F.when((F.size(a) == 1) & (F.trim(F.get(a, F.lit(0))) == ""), "blank line").when(F.size(a) < 4, "too few fields")
        for n, t in kinds:
            bad = numbers[n].isNull() | (F.isnan(numbers[n]) if t == "double" else F.lit(False))
            reason = reason.when(bad, f"bad {n}")
        numbers["timestamp"] = normalise_epoch(numbers["timestamp"])
        return F.struct(F.struct(*[c.alias(n) for n, c in numbers.items()]).alias("row"), reason.alias("reason"))

    return _with_reasons(_lines(spark, path, ","), of_fields)


def load_products(spark: SparkSession, path: str) -> DataFrame:
    """The products of a file; ``rejected(read_products(...))`` has the lines that give none."""
    return accepted(read_products(spark, path))


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The ratings of a file; ``rejected(read_ratings(...))`` has the lines that give none."""
    return accepted(read_ratings(spark, path))


def read_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
               schema=None, options: dict | None = None) -> DataFrame:
    """S3: whole-table scan. Filters/selects applied later are pushed to the scan."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def write_overwrite(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                    partition_by: list[str] | None = None, options: dict | None = None) -> None:
    """Replace a result table."""
    w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path is not None else w.save()


def rating_append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rating rows."""
    df.write.mode("append").format(fmt).save(path)


def rating_stream_source(spark: SparkSession, fmt: str = "text", path: str | None = None,
                         topic: str | None = None, bootstrap_servers: str | None = None,
                         options: dict | None = None) -> DataFrame:
    """Unbounded lines as ``value``, ``partition`` and ``offset`` (null for files). Kafka (a new query starts at the
    latest offset, which its checkpoint records, so a restart goes on where it stopped; bound a
    trigger with the ``maxOffsetsPerTrigger`` option) where the connector is
    on the classpath; a text-file directory otherwise."""
    rs = spark.readStream
    if fmt == "kafka":
        rs = (rs.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", "latest")
              .options(**(options or {})))
        return rs.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")
    rs = rs.format(fmt).options(**(options or {}))
    df = rs.load(path)
    return df.select(F.col("value").cast("string").alias("value"), F.lit(None).cast("int").alias("partition"),
                     F.lit(None).cast("bigint").alias("offset"))


def emit_rating_events(ratings: DataFrame, prefix: str = RATING_PREFIX) -> DataFrame:
    """``PREFIX:uid|pid|score|epochSec`` per accepted rating."""
    return ratings.select(rating_line("userId", "productId", "score", "timestamp", prefix).alias("value"))


def extract_rating_log(lines: DataFrame, prefix: str = RATING_PREFIX, col: str = "value") -> DataFrame:
    """Keep log lines that carry a rating and strip the layout head."""
    return (lines.filter(F.col(col).contains(prefix + ":"))
            .select(strip_rating_prefix(col, prefix).alias("value")))
