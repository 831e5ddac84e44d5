"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions on which hashed
words and word beginnings a text has; each model but the first also sees the probabilities of
the categories before it. In training those are out-of-fold predictions, made by
models that haven't seen the row, so that later models learn how far the earlier
ones can be trusted on new text. The threshold of the last category comes from its own out-of-fold
predictions: where the share of toxic rows found, less ``CLEAN_WEIGHT`` times the share of others, is largest.

The models are fitted on a bounded sample: at most ``max_labelled`` labelled documents (those with the
smallest hashed identifiers) with at most ``max_ids`` features together. A task reads the written sample and fits, so
its memory is bounded too; the driver sees only the finished
weights (half a MB a model). Every document's whole text is scored where it is read, without a shuffle.

Defined results: a null, empty or blank text has no feature and gets the models' base
rates; a label that is null leaves its row out of the training; without any labelled
row, or where a category has one value only, that value (0 without rows) is its
probability; with few rows of one value of the last category, or where no threshold gains, it is ``THRESHOLD``; a probability equal to the
threshold is toxic; repeated rows are scored each, and train as one; an empty table gives an empty result;
other columns are carried by ``drop_toxic`` under any name."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.llm.common import written

FEATURES = 1 << 16
FOLDS = 3
MAX_LABELLED, MAX_IDS = 20_000, 1 << 25
#: Characters of a word's beginning that are a feature beside the word.
STEM = 5
ITERATIONS, REGULARISATION = 30, 1e-4
#: The last category's threshold where fewer than EVIDENCE training rows have one of its values.
THRESHOLD, EVIDENCE = 0.5, 30
CLEAN_WEIGHT = 3.0
#: Features worked on together in a fit.
BLOCK_IDS = 1 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def feature_ids(text: str | None) -> np.ndarray:
    """Different features of a text: its words, lower-cased and without leading and trailing ASCII punctuation, and
    their beginnings, by hash."""
    words = {w.strip(".,;:!?\"'()[]") for w in set(WORD.findall((text or "").lower()))}
    hashes = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    hashes += [zlib.crc32(w.encode("utf-8", "surrogatepass"), 1) for w in {w[:STEM] for w in words}]
    return np.unique(np.array(hashes, np.int64) % FEATURES).astype(np.int32)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _feature_ids(texts: pd.Series) -> pd.Series:
    return texts.map(feature_ids)


@dataclass
class Sample:
    """Rows of features: ``ids`` of all rows one after the other, ``size`` of each; ``before``: the earlier
    categories' probabilities."""
    ids: np.ndarray
    size: np.ndarray
    before: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """(first row, beyond, first id, beyond) of runs of rows with about ``BLOCK_IDS`` features."""
        ends = np.cumsum(self.size)
        a = 0
        while a < len(ends):
            start = int(ends[a] - self.size[a])
            b = max(a + 1, int(np.searchsorted(ends, start + BLOCK_IDS, side="right")))
            yield a, b, start, int(ends[b - 1])
            a = b

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Weights: a feature each, an earlier category each, and the intercept."""
        out = np.empty(len(self.size))
        for a, b, i, j in self.blocks():
            sums = np.concatenate([[0.0], np.cumsum(weights[self.ids[i:j]])])
            ends = np.cumsum(self.size[a:b])
            out[a:b] = sums[ends] - sums[ends - self.size[a:b]]
        return out + self.before @ weights[FEATURES:-1] + weights[-1]

    def part(self, chosen: np.ndarray) -> Sample:
        return Sample(self.ids[np.repeat(chosen, self.size)], self.size[chosen], self.before[chosen])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def minimise(value_and_slope: Callable, x: np.ndarray, iterations: int, kept: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton steps with halving, at most ``iterations``."""
    f, g = value_and_slope(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        d, used = -g, []
        for s, y in reversed(steps):
            used.append((s @ d) / (s @ y))
            d = d - used[-1] * y
        if steps:
            s, y = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(steps, reversed(used), strict=True):
            d = d + (a - (y @ d) / (s @ y)) * s
        slope, step = float(g @ d), 1.0
        while True:
            x2 = x + step * d
            f2, g2 = value_and_slope(x2)
            if f2 <= f + 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        if not f2 < f:
            break
        s, y = x2 - x, g2 - g
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-kept:]
        x, f, g = x2, f2, g2
    return x


def fit_weights(sample: Sample, labels: np.ndarray) -> np.ndarray:
    """Logistic regression; the intercept isn't regularised. Labels of one value: no features, an intercept that gives it."""
    width = FEATURES + sample.before.shape[1] + 1
    n, mean = len(labels), float(labels.mean()) if len(labels) else 0.0
    start = np.zeros(width)
    if mean in (0.0, 1.0):
        start[-1] = np.inf if mean else -np.inf
        return start

    def value_and_slope(w: np.ndarray) -> tuple[float, np.ndarray]:
        m = sample.margins(w)
        error = (sigmoid(m) - labels) / n
        slope = REGULARISATION * w
        slope[-1] = error.sum()
        slope[FEATURES:-1] += error @ sample.before
        for a, b, i, j in sample.blocks():
            slope[:FEATURES] += np.bincount(sample.ids[i:j], np.repeat(error[a:b], sample.size[a:b]), FEATURES)
        loss = np.logaddexp(0, np.where(labels > 0, -m, m)).mean()
        return loss + REGULARISATION / 2 * float(w[:-1] @ w[:-1]), slope

    start[-1] = np.log(mean / (1 - mean))
    return minimise(value_and_slope, start, ITERATIONS)


def probability(sample: Sample, weights: np.ndarray) -> np.ndarray:
    if np.isinf(weights[-1]):
        return np.full(len(sample.size), float(weights[-1] > 0))
    return sigmoid(sample.margins(weights))


@dataclass
class Chain:
    """Fitted weights in chain order, and the last category's threshold."""
    categories: list[str]
    weights: list[np.ndarray]
    threshold: float = THRESHOLD

    def probabilities(self, ids: list[np.ndarray]) -> np.ndarray:
        """A row for each text, a column for each category."""
        sample = Sample(np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(x) for x in ids], np.int64),
                        np.zeros((len(ids), 0)))
        for w in self.weights:
            sample.before = np.column_stack([sample.before, probability(sample, w)])
        return sample.before

    def score(self, text: Column) -> Column:
        """array<double>: a text's probability of each category."""
        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def of(texts: pd.Series) -> pd.Series:
            return pd.Series(list(self.probabilities([feature_ids(t) for t in texts])), dtype=object)
        return of(text)


FIT_SCHEMA = "fold int, row long, p double, weights binary"


def _fit_task(position: int, fold: int):
    """A task function: one model of the category at ``position``, without the rows of ``fold`` (-1: with all).
    It gives the weights where it saw all rows, else the probabilities of the rows it hasn't seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, size, folds, known = [], [np.zeros(0, np.int32)], [], [], []
        for batch in batches:
            lists = batch.column(1)
            rows.append(batch.column(0).to_numpy())
            ids.append(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32))
            size.append(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            folds.append(batch.column(2).to_numpy())
            known.append(np.stack(batch.column(3).to_pylist()))  # earlier probabilities, then the label
        if not rows:
            yield pa.RecordBatch.from_pylist([], schema=pa.schema([
                ("fold", pa.int32()), ("row", pa.int64()), ("p", pa.float64()), ("weights", pa.binary())]))
            return
        known = np.concatenate(known)
        sample = Sample(np.concatenate(ids), np.concatenate(size), known[:, :position])
        unseen = np.concatenate(folds) == fold
        labels = known[:, position]
        weights = fit_weights(sample.part(~unseen) if fold >= 0 else sample, labels[~unseen])
        if fold < 0:
            columns = [[fold], [None], [None], [weights.tobytes()]]
        else:
            at = np.concatenate(rows)[unseen]
            columns = [[fold] * len(at), at, probability(sample.part(unseen), weights), [None] * len(at)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.int32(), pa.int64(), pa.float64(), pa.binary()), strict=True)], names=["fold", "row", "p", "weights"])
    return run


def best_threshold(p: np.ndarray, labels: np.ndarray) -> float:
    """The probability from which on calling rows toxic finds most of the toxic and fewest of the others."""
    if min(labels.sum(), len(labels) - labels.sum()) < EVIDENCE:
        return THRESHOLD
    cuts, at = np.unique(p, return_inverse=True)
    toxic = np.bincount(at, labels, len(cuts))
    other = np.bincount(at, 1 - labels, len(cuts))
    gain = toxic[::-1].cumsum()[::-1] / toxic.sum() - CLEAN_WEIGHT * other[::-1].cumsum()[::-1] / other.sum()
    if gain.max() <= 0:
        return THRESHOLD
    best = int(np.flatnonzero(gain == gain.max())[-1])
    return float((cuts[best] + cuts[best - 1]) / 2) if best else float(cuts[0])


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = MAX_LABELLED, folds: int = FOLDS, max_ids: int = MAX_IDS) -> Chain:
    """``labels``: (doc_id, one 0/1 column for each category), at most ``max_labelled`` rows
    of which are used, so their broadcast is bounded."""
    chosen = (labels.select("doc_id", *[F.col(c).cast("double").alias(f"y{k}") for k, c in enumerate(categories)])
              .dropna().dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    ys = [f"y{k}" for k in range(len(categories))]
    table = written(found.select("doc_id", *ys, _feature_ids("text").alias("ids")), "toxicity-rows")
    one = table.groupBy("doc_id", *ys).agg(F.min("ids").alias("ids"))  # at most max_labelled rows
    by_hash = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    places = one.select("doc_id", *ys, "ids", F.row_number().over(by_hash).cast("long").alias("row"),
                        F.sum(F.size("ids").cast("long")).over(by_hash.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"))
    data = written(places.where(F.col("so_far") <= max_ids).select(
        "row", "ids", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(folds)).cast("int").alias("fold"), *ys), "toxicity-train")
    weights, threshold = [], THRESHOLD
    for k in range(len(categories)):
        before = [f"p{j}" for j in range(k)]
        given = data.select("row", "ids", "fold", F.array(*before, ys[k]).alias("known")).coalesce(1)
        parts = [given.mapInArrow(_fit_task(k, fold), FIT_SCHEMA) for fold in (-1, *range(folds))]
        fitted = parts[0]
        for part in parts[1:]:
            fitted = fitted.unionByName(part)
        fitted = written(fitted, "toxicity-fit")
        own = fitted.where("fold = -1").select("weights").collect()  # one model
        weights.append(np.frombuffer(own[0][0]) if own else np.append(np.zeros(FEATURES + k), -np.inf))
        unseen = fitted.where("fold >= 0").select("row", F.col("p").alias(f"p{k}"))
        data = written(data.join(unseen, "row"), "toxicity-train")
        if k == len(categories) - 1:
            last = data.select(f"p{k}", ys[k]).toPandas()  # at most max_labelled rows
            threshold = best_threshold(last[f"p{k}"].to_numpy(), last[ys[k]].to_numpy())
    return Chain(list(categories), weights, threshold)


def judge(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float | None = None) -> DataFrame:
    """(doc_id, p_<category> ..., toxic): one row per document; ``toxic`` by the chain's last category, at the chain's
    threshold unless another is given."""
    cut = chain.threshold if threshold is None else threshold
    scored = docs.select(F.col(id_col).alias("doc_id"), chain.score(F.col(text_col)).alias("p"))
    p = [F.get("p", F.lit(k)).alias(f"p_{c}") for k, c in enumerate(chain.categories)]
    return scored.select("doc_id", *p, (F.get("p", F.lit(len(p) - 1)) >= cut).alias("toxic"))


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """The documents that aren't toxic, with all their columns; no shuffle."""
    cut = chain.threshold if threshold is None else threshold
    return docs.where(F.get(chain.score(F.col(text_col)), F.lit(len(chain.categories) - 1)) < cut)
