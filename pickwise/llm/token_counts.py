"""Token counts behind a digest cache.

A text's count depends on its bytes and the tokenizer file only, so counts are
kept in a table keyed by the SHA-256 of both. A run takes the corpus's distinct
contents (partial aggregation first: copies collapse before the shuffle), drops
those already in the cache, encodes the misses once each, appends them, and joins
every document to its count by digest.

Defined results: null text counts as empty (0 bytes); special strings, normalisation
and white space are the tokenizer library's defaults, nothing is added, cut or padded;
repeated rows each get a row; an empty table gives an empty result and leaves the
cache as it is; two runs that append the same content at once are harmless, since
equal rows are read as one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Texts encoded in one library call: bounds the ids held at a time.
TEXTS_PER_CALL = 64


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: another version of it shares no cached count."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def load_counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts: sentencepiece for ``.model``, tokenizers for ``.json``."""
    if path.endswith(".model"):
        import sentencepiece
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def read_cache(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame | None:
    """(digest, n_tokens) stored for this tokenizer; None before the first append."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; the cache at
    ``cache_path`` gains the contents that it lacked."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    contents = docs.select(digest, text.alias("content")).groupBy("digest").agg(F.first("content").alias("content"))
    cached = read_cache(spark, cache_path, version)
    misses = contents if cached is None else contents.join(cached, "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(tokenizer_path)
        for batch in batches:
            counts: list[int] = []
            for at in range(0, batch.num_rows, TEXTS_PER_CALL):
                counts += count(batch.column(1).slice(at, TEXTS_PER_CALL).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())],
                                             names=["digest", "n_tokens"])

    (misses.select("digest", "content").mapInArrow(encode, "digest binary, n_tokens long")
     .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest)
    return keyed.join(read_cache(spark, cache_path, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
