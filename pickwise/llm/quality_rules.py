"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted: one over a
trusted target (labelled good documents), one over the raw corpus (every document,
whole text). A document's score is the sum of log(target / raw) over its n-grams,
divided by their number; documents below a fixed threshold are rejected. A bucket's
ratio is smoothed by ``PRIOR`` occurrences on both sides, so rare n-grams say little and
only what is frequent in the corpus but absent from the target counts against a text.

The model is two counts for each of ``BUCKETS`` buckets, whatever the corpus size;
it is the only thing that reaches the driver, and scoring is an expression on the row.
Both are counts over all their documents, however many.

Defined results: a null, empty or blank text has no words, all figures are 0 and it
fails the base rules; without any trusted document, or without documents, every
n-gram scores 0 and the base rules decide alone; repeated rows are judged and counted
each; other columns are carried by ``filter_documents`` under any name."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import words_of

BUCKETS = 1 << 16
PRIOR = 8.0
THRESHOLD = -0.1
MIN_WORDS = 50
WINDOW = 3
#: Up to so many different repeated windows, a scan of them is cheaper than sorting places.
FEW = 16
SYMBOLS = r"[#*$%&|<>]"
A_WORD = r"[^\x20\x09-\x0D]"


def gram_hashes(words: Column) -> Column:
    """Hashes of the unigrams and bigrams of an array of words, which is computed once a row."""
    def of(w: Column) -> Column:
        one = F.transform(w, lambda x: F.xxhash64(x))
        two = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
        return F.concat(one, F.slice(two, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))))
    return _let(words, of)


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def bucket_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str,
                  buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target). ``trusted`` is (doc_id), of any size: it grows with the corpus, so it is never
    broadcast, and the texts are sorted to it by identifier once (about the input's size is shuffled)."""
    chosen = trusted.where("doc_id is not null").select("doc_id").distinct().withColumn("good", F.lit(1))
    flagged = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen.hint("merge"), "doc_id", "left")
    return (flagged.select(F.coalesce("good", F.lit(0)).alias("good"),
                           F.explode(gram_hashes(words_of(F.col("text")))).alias("h"))
            .groupBy(_bucket(F.col("h"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target")))


def fit_weights(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> np.ndarray:
    """log(target / raw) of each bucket; at most ``buckets`` rows come to the driver."""
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in counts.collect():
        raw[bucket], target[bucket] = r, t
    if not target.sum():
        return np.zeros(buckets)
    expected = raw * (target.sum() / raw.sum())  # of the target, were it drawn from the raw corpus
    return np.log((target + prior) / (expected + prior))


def array_literal(values: np.ndarray) -> Column:
    """A constant array<double>, folded once by the optimiser."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def score(words: Column, weights: np.ndarray) -> Column:
    """Length-normalised log-likelihood ratio; no words: 0."""
    table, buckets = array_literal(weights), len(weights)
    n = F.size(words)

    def of(h: Column) -> Column:
        return F.get(table, _bucket(h, buckets))

    each = F.transform(words, lambda w, i: of(F.xxhash64(w)) + F.when(
        i + 1 < n, of(F.xxhash64(w, F.get(words, i + 1)))).otherwise(0.0))
    return F.when(n > 0, F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / (2 * n - 1)).otherwise(0.0)


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a ``WINDOW``-word window found twice or more in
    the text. Windows are compared by hash. Where few different windows repeat,
    each window is looked up among those; else all windows are sorted with their
    places. Either way the union of the repeated windows' spans is measured."""
    n = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                     F.lit(1), n)

    def spans(p: Column) -> Column:
        each = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    def by_lookup(h: Column, repeated: Column) -> Column:
        return F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(repeated, x), i)))

    def by_sorting(h: Column) -> Column:
        def places(s: Column) -> Column:
            at = F.transform(s, lambda x, i: F.when(
                (x["h"] == F.get(s, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(s, i - 1)["h"])), x["p"]))
            return F.sort_array(F.array_compact(at))
        return _let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), places)

    def of(h: Column) -> Column:
        def repeated_of(s: Column) -> Column:
            return F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1)))

        def count(r: Column) -> Column:
            return (F.when(F.size(r) == 0, F.lit(0))
                    .when(F.size(r) <= FEW, _let(by_lookup(h, r), spans))
                    .otherwise(_let(by_sorting(h), spans)))
        return _let(_let(F.sort_array(h), repeated_of), count)

    return _let(hashes, of)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    return fit_weights(bucket_counts(docs, trusted, id_col, text_col))


def judge(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its figures, ``base_failed``, ``quality_score`` and ``kept``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(A_WORD))
    of_words = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"), score(w, weights).alias("quality_score")))
    out = docs.select(
        F.col(id_col).alias("doc_id"), of_words.alias("f"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    failed = _failed(F.col("f.n_words"), F.col("f.n_repeat_words"))
    return out.select("doc_id", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words",
                      failed.alias("base_failed"), "f.quality_score",
                      (~failed & (F.col("f.quality_score") >= threshold)).alias("kept"))


def filter_documents(docs: DataFrame, weights: np.ndarray, text_col: str = "text",
                     threshold: float = THRESHOLD) -> DataFrame:
    """The documents kept by ``judge``'s rule, with all their columns; no shuffle. The rule is
    one expression that splits a text once, however the optimiser moves the filter."""
    return docs.where(_let(words_of(F.col(text_col)), lambda w: ~_failed(F.size(w), repeated_words(w))
                           & (score(w, weights) >= threshold)))
