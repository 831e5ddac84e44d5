"""WARC records in a content-addressed archive.

An archive is two tables in one folder: ``payloads`` holds the bytes of every
distinct payload once, under its SHA-256, in buckets of that digest; ``headers`` holds each record's exact
WARC and HTTP header bytes, with the SHA-256 of the payload they go with. Reading
joins the two and gives back the original records: the headers go to the payloads' buckets, the payloads themselves stay
where they are. Payloads that very many records share (at most one for each shuffle partition) are
copied to several tasks instead, and their records dealt among those. The payload's digests are taken
again from the stored bytes when they are read: a record whose payload no longer
has its address, or whose header states another digest or length, raises.

Of records with equal payloads of at least ``revisit_from`` bytes, the one with
the largest identifier is the response and the others are revisits of it; smaller
payloads are responses throughout. Line ends in a url are percent-encoded in its header.

Defined results: null html is an empty payload; a null url is written as an empty
target; in a group the rows that share the largest identifier are all responses, a
row without identifier is a revisit unless the whole group has none; repeated rows
give repeated records; an empty table gives an empty archive; other columns are ignored."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm.common import hot_keys, salted_join, shuffle_partitions

CRLF = "\r\n"
REVISIT_FROM = 1000
#: Fixed by the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*lines: Column | str) -> Column:
    parts = [F.concat(F.lit(x) if isinstance(x, str) else x, F.lit(CRLF)) for x in lines]
    return F.concat(*parts, F.lit(CRLF))


def _record_id(key: Column) -> Column:
    """A stable URN from the record's key."""
    h = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _table_name() -> str:
    """A name for the catalog's entry of a bucketed folder; the entry lives as long as the session."""
    return f"warc_payloads_{uuid.uuid4().hex}"


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """sha256, payload; known to lie in buckets, so that a join on the digest doesn't move it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/payloads")
    (layout,) = [s.getPath() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    name = _table_name()
    spark.sql(f"CREATE TABLE {name} (sha256 BINARY, payload BINARY) USING parquet CLUSTERED BY (sha256) "
              f"INTO {layout.getName().split('=')[1]} BUCKETS LOCATION '{layout}'")
    return spark.table(name)


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", date: str = "2020-01-01T00:00:00Z",
                  revisit_from: int = REVISIT_FROM) -> None:
    """Write one record per page to the archive ``folder``."""
    payload = F.encode(F.coalesce(html_col, F.lit("")), "utf-8")
    spark = pages.sparkSession
    buckets = shuffle_partitions(spark)  # as the aggregate's output lies: one file for each
    (pages.select(payload.alias("payload")).groupBy(F.unhex(F.sha2("payload", 256)).alias("sha256"))
     .agg(F.first("payload").alias("payload")).write.bucketBy(buckets, "sha256").option("compression", "zstd")
     .option("path", f"{folder}/payloads/buckets={buckets}").saveAsTable(_table_name()))
    slim = pages.select(F.col(id_col).cast("long").alias("id"), _one_line(F.coalesce(url_col, F.lit(""))).alias("url"),
                        F.unhex(F.sha2(payload, 256)).alias("sha256"), F.sha1(payload).alias("sha1"),
                        F.octet_length(payload).cast("long").alias("n_bytes"))
    group = slim.where(F.col("n_bytes") >= revisit_from).groupBy("sha256").agg(F.max("id").alias("last"))
    rows = slim.join(group, "sha256", "left")
    is_response = F.col("last").isNull() | F.coalesce(F.col("id") == F.col("last"), F.lit(False))
    http = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                  F.concat(F.lit("Content-Length: "), F.col("n_bytes")))
    size = F.octet_length("http") + F.when(F.col("is_response"), F.col("n_bytes")).otherwise(0)
    common = [
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"))), f"WARC-Date: {date}",
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")), "Content-Type: application/http;msgtype=response",
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.concat(F.lit("Content-Length: "), size)]
    response = _lines("WARC/1.1", "WARC-Type: response", *common)
    revisit = _lines("WARC/1.1", "WARC-Type: revisit", *common, f"WARC-Profile: {PROFILE}",
                     F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("last"))))
    (rows.withColumns({"is_response": is_response, "http": http})
     .select("id", "sha256", F.when(F.col("is_response"), F.lit(None)).otherwise(F.col("last")).alias("refers_to"),
             F.encode(F.when(F.col("is_response"), response).otherwise(revisit), "utf-8").alias("warc_header"),
             F.encode("http", "utf-8").alias("http_header"))
     .write.parquet(f"{folder}/headers"))


def _field(header: str, name: str) -> Column:
    return F.regexp_extract(F.decode(header, "utf-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record, rebuilt: (page_id, target_uri, record_type, refers_to, payload_bytes,
    payload_digest, payload, record). ``payload`` is the full payload also for a revisit,
    ``record`` the exact bytes of the WARC record, which for a revisit has none.
    The digests are taken from the stored bytes, for each record."""
    payloads = _payloads(spark, folder)
    headers = spark.read.parquet(f"{folder}/headers").withColumnsRenamed({"id": "page_id"})
    sizes = headers.groupBy("sha256").agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(sizes, "sha256").select("sha256"))
    few = headers.join(hot, "sha256", "left_anti").join(payloads, "sha256", "left")
    many = salted_join(headers.join(hot, "sha256", "left_semi"), payloads.join(hot, "sha256", "left_semi"), "sha256",
                       ["page_id", "warc_header"], sizes=sizes, how="left")
    joined = few.unionByName(many).withColumns({
        "actual": F.unhex(F.sha2("payload", 256)), "payload_digest": F.sha1("payload"),
        "payload_bytes": F.octet_length("payload").cast("long")})
    rows = joined.withColumn("record_type", _field("warc_header", "WARC-Type"))
    stated = _field("warc_header", "WARC-Payload-Digest")
    length = _field("warc_header", "Content-Length").cast("long")
    is_response = F.col("record_type") == "response"
    whole = (F.coalesce(F.col("actual") == F.col("sha256"), F.lit(False))
             & (stated == F.concat(F.lit("sha1:"), F.col("payload_digest")))
             & (length == F.octet_length("http_header") + F.when(is_response, F.col("payload_bytes")).otherwise(0)))
    broken = F.raise_error(F.concat(F.lit("archive is damaged at record "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    end = F.lit((CRLF * 2).encode())
    return rows.select(
        "page_id", _field("warc_header", "WARC-Target-URI").alias("target_uri"), "record_type", "refers_to",
        "payload_bytes", F.when(whole, F.col("payload_digest")).otherwise(broken).alias("payload_digest"), "payload",
        F.when(is_response, F.concat("warc_header", "http_header", "payload", end))
        .otherwise(F.concat("warc_header", "http_header", end)).alias("record"))
