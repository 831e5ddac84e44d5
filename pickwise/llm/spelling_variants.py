"""Spelling variants: words one edit apart, found by pivotal grams.

``vocabulary`` counts the words of all texts. ``near_words`` joins the words that differ by exactly one
inserted, deleted or replaced code point:

1. The bigrams of a word, with their positions, are ordered by rarity in the vocabulary. The first three are its
   prefix (``EDITS`` * 2 + 1), equal bigrams in the order of their positions; an edit may move a position by one, so the
   third's bigram counts at the next position too, if it is there.
2. Two disjoint bigrams of the prefix (``EDITS`` + 1) are its pivots: those that are rarest together, chosen by
   dynamic programming over the prefix in position order.
3. One edit can't touch both pivots. Of two near words, the one whose prefix ends first in the order has
   a pivot that the other has too, and then in its prefix. The edit lies on one side of that pivot, so on the other
   side the words are equal: pivots are joined with all prefixes on the word's beginning up to the bigram's end
   (the position is then the same) or on its end from the bigram on (the position moves with the length), and
   on the length, which is the same or one more or less.
4. Candidates are compared by their edit distance, in the task that joins them.

``variants`` then gives each word the form it is probably a variant of: its most frequent near word, if ``RATIO``
times as frequent; and by pointer doubling the root at which the forms end (counts grow
along them, so there is no circle and 27 steps are beyond any count).

The table of bigrams has at most 90 x 90 rows (the alphabet is a-z and 64 letters) and is the only thing on the
driver. Words meet by bigram, what is beside it, and length; such a key with many words is dealt to several tasks.

Defined results: null, empty and wordless texts have no words; a null identifier reads as the
empty string; repeated rows count each; words of any length are compared whole; equally frequent near words: the
smallest in code-point order is the form; an empty table gives an empty result; other columns are not read."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import salted_join, written

EDITS = 1
GRAM = 2
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: One in so many different words of a document loses a letter before counting (None: none does).
SLIP = 199
#: Letters counted by a task before it hands its counts on.
HELD_LETTERS = 1 << 23

COUNT_SCHEMA = "word string, n long"
GRAM_SCHEMA = "word string, n long, length int, gram string, pos int, pivot boolean"


def _counts(counter: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())],
                                      names=[name, "n"])


def _counted(count_row, name: str):
    """A task function that adds up ``count_row(counter, row)``, with a bounded counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        letters = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                letters += count_row(counter, *row)
                if letters > HELD_LETTERS:
                    yield _counts(counter, name)
                    counter, letters = Counter(), 0
        if counter:
            yield _counts(counter, name)
    return run


def slipped(word: str, seed: int, slip: int | None) -> str:
    """The word, or the word without one letter; ``seed`` is the checksum of what stands before it."""
    h = zlib.crc32(word.encode(), seed)
    if slip is None or h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, slip: int | None = SLIP) -> DataFrame:
    """(word, n): the words of at least ``min_length`` letters and ``min_count`` occurrences in all texts."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def count_text(counter: Counter, key: str, text: str | None) -> int:
        if not text:
            return 0
        seed, letters = zlib.crc32(f"{key}:".encode()), 0
        for word, n in Counter(runs.findall(text.encode().lower().decode())).items():  # bytes: A-Z alone change
            word = slipped(word, seed, slip)
            if len(word) >= min_length:
                counter[word] += n
                letters += len(word) + 64
        return letters

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_counted(count_text, "word"), COUNT_SCHEMA)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Each bigram's place in the order of rarity; at most 8,100 bigrams exist."""
    def count_grams(counter: Counter, word: str) -> int:
        counter.update(word[i:i + GRAM] for i in range(len(word) - GRAM + 1))
        return len(word)

    rows = (words.select("word").mapInArrow(_counted(count_grams, "gram"), "gram string, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).orderBy("n", "gram").collect())
    return {r["gram"]: i for i, r in enumerate(rows)}


def prefix_and_pivots(word: str, ranks: dict[str, int]) -> list[tuple[int, bool]]:
    """(position, is a pivot) of the word's prefix grams, in position order."""
    order = sorted(range(len(word) - GRAM + 1), key=lambda i: (ranks[word[i:i + GRAM]], i))
    size = EDITS * GRAM + 1
    last = order[size - 1]
    moved = [last + EDITS] if word[last + EDITS:last + EDITS + GRAM] == word[last:last + GRAM] else []
    places = sorted({*order[:size], *moved})
    weights = [ranks[word[i:i + GRAM]] for i in places]
    # best[k][m]: least weight of k disjoint grams among the first m places, and the last of them
    best: list[list[tuple[int, int] | None]] = [[(0, -1)] * (len(places) + 1)]
    before = [sum(p + GRAM <= i for p in places) for i in places]  # places that end before each begins
    for k in range(1, EDITS + 2):
        row: list[tuple[int, int] | None] = [None]
        for m in range(len(places)):
            rest = best[k - 1][before[m]]
            taken = None if rest is None else (rest[0] + weights[m], m)
            left = row[m]
            row.append(left if taken is None or (left is not None and left[0] <= taken[0]) else taken)
        best.append(row)
    pivots, m = set(), len(places)
    for k in range(EDITS + 1, 0, -1):
        at = best[k][m][1]
        pivots.add(at)
        m = before[at]
    return [(p, i in pivots) for i, p in enumerate(places)]


def word_grams(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """``GRAM_SCHEMA``: every word's prefix grams, its pivots marked."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, n, len(w), w[p:p + GRAM], p, pivot)
                    for w, n in zip(*[c.to_pylist() for c in batch.columns], strict=True)
                    for p, pivot in prefix_and_pivots(w, ranks)]
            if rows:
                types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=["word", "n", "length", "gram", "pos", "pivot"])

    return words.select("word", "n").mapInArrow(cut, GRAM_SCHEMA)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both ways round, every pair of words (word, n) one edit apart."""
    grams = written(word_grams(words, gram_ranks(words)), "grams")

    # the unchanged side of a gram; keys are hashes, which choose candidates alone
    sides = F.explode(F.array(F.concat(F.lit("<"), F.substring("word", F.lit(1), F.col("pos") + GRAM)),
                              F.concat(F.lit(">"), F.substring("word", F.col("pos") + 1, F.col("length")))))
    sided = grams.withColumn("side", sides)
    lengths = F.explode(F.array(*[F.col("length") + change for change in range(-EDITS, EDITS + 1)]))
    pivots = (sided.where("pivot").withColumn("length", lengths)
              .select("word", "n", F.xxhash64("side", "length").alias("key")))
    index = sided.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.xxhash64("side", "length").alias("key"))
    pairs = salted_join(pivots, index, "key", ["word"]).where(
        (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", EDITS) == EDITS))
    once = pairs.select(*[F.when(F.col("word") < F.col("near"), F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (
        ("word", "near"), ("n", "near_n"), ("near", "word"), ("near_n", "n"))]).distinct()
    both = written(once, "near-words")
    return both.union(both.select("near", "near_n", "word", "n"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **words_as) -> DataFrame:
    """One row per word of ``vocabulary``: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, id_col, text_col, **words_as), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    has_form = -F.col("best.m") >= ratio * F.col("n")
    table = written(words.join(best, "word", "left").select(
        "word", F.when(has_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.m")).alias("form_n")), "forms")
    jumps, moved = table.where("form is not null").select("word", F.col("form").alias("root")), True
    while moved:  # each round doubles the steps already taken
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        jumps = written(jumps.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        moved = bool(jumps.where("moved").head(1))
        jumps = jumps.drop("moved")
    return table.join(jumps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
