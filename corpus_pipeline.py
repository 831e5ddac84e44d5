"""Training-corpus pipeline: STAGES in order, each over all that its predecessor kept.

Every stage but the last returns the columns of ``documents``. Models and corpus
statistics of a stage come from that stage's own input. A stage's result is written once
and read as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import exact_dedup, minhash_dedup, packing, quality_rules, toxicity
from pickwise.llm.common import read_table, written
from pickwise.llm.queries import CATEGORIES, toxicity_labels, trusted_ids


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the log-likelihood ratio go."""
    return quality_rules.filter_documents(docs, quality_rules.fit(docs, trusted_ids(spark, sf_dir)))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, toxicity_labels(spark, sf_dir), CATEGORIES))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near duplicates (80 % of five-word shingles) the document with the smallest doc_id stays."""
    return minhash_dedup.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, as packed token sequences."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality), ("toxicity", toxic), ("exact_dedup", exact),
          ("minhash_dedup", near), ("best_fit_packing", pack)]
#: The classifier and the packing can't be written in SQL; tests/llm/test_pipeline.py compares what each stage keeps of
#: its input with a plain version of its rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
