"""Exact de-duplication by content sort.

Spark samples splitters and range-partitions the texts by their leading bytes
and a salt, external sorting inside each partition puts equal texts next to each
other, and the window below compares every text in full with its neighbour: a run
of equal texts is a group. The salt takes the text and the identifier, so a text
that a third of all rows share is sorted as ``SALTS`` separate runs; the runs of
one text (at most ``SALTS`` rows after the sort) meet by SHA-256.

Defined results: null text equals empty text; of equal texts the row with the
largest (or smallest) identifier stays, a null identifier only when the group has
no other; of repeated rows with that identifier one stays; an empty table
gives an empty result; other columns are carried by ``deduplicate`` under any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.llm.common import column_at, positional, written

SALTS = 32
#: Leading characters that the sampled splitters see; the sort and the comparison take whole texts.
SPLITTER_CHARS = 24


def _runs(df: DataFrame, c_id: str, c_text: str, keep: str) -> DataFrame:
    """The rows, sorted by content, with the figures of their run of equal texts."""
    text = F.coalesce(F.col(c_text), F.lit(""))
    ranged = (df.withColumn("k_head", F.substring(text, 1, SPLITTER_CHARS))
              .withColumn("k_salt", F.xxhash64(text, F.pmod(F.xxhash64(c_id), F.lit(SALTS))))
              .repartitionByRange("k_head", "k_salt"))
    run = (Window.partitionBy("k_head", "k_salt", c_text).orderBy(_first(c_id, keep)))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (ranged.withColumn("run_id", (F.max if keep == "largest" else F.min)(c_id).over(whole))
            .withColumn("run_size", F.count(F.lit(1)).over(whole))
            .withColumn("run_nth", F.row_number().over(run)))


def _first(c_id: str, keep: str) -> Column:
    return F.col(c_id).desc_nulls_last() if keep == "largest" else F.col(c_id).asc_nulls_last()


def _sha(c_text: str) -> Column:
    return F.sha2(F.coalesce(F.col(c_text), F.lit("")), 256)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256)."""
    pick = F.max if keep == "largest" else F.min
    df = docs.select(F.col(id_col).alias("c_id"), F.coalesce(text_col, F.lit("")).alias("c_text"))
    slim = written(_runs(df, "c_id", "c_text", keep).select(
        "c_id", F.unhex(_sha("c_text")).alias("sha"), "run_id", "run_size", "run_nth"), "copies")
    groups = (slim.where("run_nth = 1").groupBy("sha")
              .agg(pick("run_id").alias("keep_id"), F.sum("run_size").alias("group_size")))
    return slim.join(groups, "sha").select(
        F.col("c_id").alias("doc_id"), "keep_id", "group_size",
        ((F.col("run_nth") == 1) & F.col("c_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The documents that stay, with all their columns."""
    c_id, c_text = column_at(docs, id_col), column_at(docs, text_col)
    df = positional(docs)
    heads = _runs(df, c_id, c_text, keep).where("run_nth = 1").withColumn("sha", _sha(c_text))
    nth = F.row_number().over(Window.partitionBy("sha").orderBy(_first(c_id, keep)))
    return heads.withColumn("nth", nth).where("nth = 1").select(*df.columns).toDF(*docs.columns)
