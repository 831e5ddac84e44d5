"""Registered queries of the training-data operators: each applies its operator,
with its production parameters, to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import (decontamination, exact_dedup, minhash_dedup, packing, quality_rules, sentencepiece_nbest,
                          sharding, spelling_variants, token_counts, toxicity, url_filters, warc, whitening)
from pickwise.llm.common import read_table
from pickwise.session import scratch_path


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of near equal bytes."""
    placed = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, good): a page shows the document whose number is the last segment of its
    path; it is good if that document is labelled of good quality and not toxic."""
    number = F.regexp_extract(url_filters.path_of(F.col("url")), r"/([0-9]{1,18})(\.[a-z]+)?/?$", 1)
    pages = read_table(spark, sf_dir, "pages").select("page_id", number.try_cast("long").alias("doc_id"))
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    return pages.where("doc_id is not null").join(labels, "doc_id").select("page_id", "good")


def q_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the fixed rules, else by its path template."""
    return url_filters.judge(read_table(spark, sf_dir, "pages"), page_labels(spark, sf_dir))


def q_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's four best segmentations, as scores and digests."""
    best = sentencepiece_nbest.encode_nbest(read_table(spark, sf_dir, "documents"),
                                            public_tokenizers.path("piece_bpe_32k.model"))
    return best.select("doc_id", "n_pieces", "scores",
                       F.transform("ids", lambda b: F.crc32(b)).alias("ids_crc32"), "round_trip")


def q_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates, by the contract's two-word shingles."""
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), width=2)


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents of good quality that aren't toxic."""
    return read_table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base figures and the verdict of the log-likelihood ratio."""
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, trusted_ids(spark, sf_dir)))


def q_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    pieces = packing.token_pieces(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces)


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back; the digest is of the whole rebuilt record."""
    folder = scratch_path(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("record_sha256"))


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts."""
    return exact_dedup.mark_copies(read_table(spark, sf_dir, "documents"))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, through a cache that starts empty."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"),
                                     scratch_path(spark, "token-counts"))


#: Chain order; the tables label one kind of toxicity, and quality.
CATEGORIES = ["low_quality", "toxic"]


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def toxicity_chain(spark: SparkSession, sf_dir: str) -> toxicity.Chain:
    """The chain fitted on the labelled documents of the tables in ``sf_dir``."""
    return toxicity.fit(read_table(spark, sf_dir, "documents"), toxicity_labels(spark, sf_dir), CATEGORIES)


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's category probabilities and verdict."""
    return toxicity.judge(read_table(spark, sf_dir, "documents"), toxicity_chain(spark, sf_dir))


def q_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, form and root."""
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))


def q_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's eight whitened components."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in windows of the benchmark's items."""
    return decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sharding": q_sharding,
    "op2_url_filters": q_url_filters,
    "op3_minhash_dedup": q_minhash_dedup,
    "op4_quality_rules": q_quality_rules,
    "op5_best_fit_packing": q_best_fit_packing,
    "op6_warc": q_warc,
    "op7_sentencepiece_nbest": q_sentencepiece_nbest,
    "op8_exact_dedup": q_exact_dedup,
    "op9_token_counts": q_token_counts,
    "op10_toxicity": q_toxicity,
    "op11_spelling_variants": q_spelling_variants,
    "op12_embedding_whitening": q_embedding_whitening,
    "op13_decontamination": q_decontamination,
}
