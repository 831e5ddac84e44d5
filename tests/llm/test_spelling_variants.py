"""Spelling variants against a comparison of all words."""

import collections
import itertools
import random
import re
import zlib

import pytest

from pickwise.llm import spelling_variants as sv

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=6, min_count=5, ratio=5, slip=199):
    counts = collections.Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if slip and h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: set() for w in words}
    shared = collections.defaultdict(set)  # words one edit apart have a text with at most one letter less in common
    for w in words:
        for part in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} if len(w) < 100 else {w[:50]}:
            shared[part].add(w)
    for group in shared.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= ratio * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def result(df, **words_as):
    got = [tuple(r) for r in sv.variants(df, **words_as).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], min_count=2, ratio=2)
    assert len(want) > 500 and any(w[1] for w in want)
    assert result(docs, min_count=2, ratio=2) == want


@pytest.mark.parametrize("alphabet", ["ab", "abcdeé", "aÀ"])
def test_dense_words(spark, alphabet):
    """Small alphabets: many equal bigrams in a word and many words for a bigram."""
    rng = random.Random(len(alphabet))
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9))) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(base, k=30))) for i in range(40)]
    rows += [(100 + i, " ".join(w[:p] + rng.choice(alphabet) + w[p + rng.randint(0, 1):] for w in rng.choices(base, k=9)
                                for p in [rng.randrange(len(w))])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, min_count=1, ratio=2, slip=7)
    assert result(df, min_count=1, ratio=2, slip=7) == want and sum(w[4] for w in want) > 50


def test_forms_end_at_the_root(spark):
    counts = {"planten": 2, "plantes": 10, "plantas": 50, "plantar": 250}
    rows = [(i, " ".join([w.upper()] * n)) for i, (w, n) in enumerate(counts.items())] + [(9, None), (None, ""), (8, "...")]
    got = {r[0]: r for r in result(spark.createDataFrame(rows, "doc_id long, text string"), min_count=2, slip=None)}
    assert {w: (r[1], r[2]) for w, r in got.items()} == {
        "planten": ("plantes", "plantar"), "plantes": ("plantas", "plantar"), "plantas": ("plantar", "plantar"),
        "plantar": (None, "plantar")}
    assert got["plantes"][4:] == (2, 50)


def test_edge_rows(spark, docs, none):
    assert sv.variants(none).count() == 0
    long = "z" * 30000
    rows = [(1, f"{long} {long}a word"), (1, f"{long} {long}a word"), (2, "É" * 6 + " " + "É" * 5 + "é")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string")
    got = result(df, min_count=1, slip=None)
    assert {(r[0][:2], len(r[0]), r[3], r[4]) for r in got} == {
        ("zz", 30000, 2, 1), ("zz", 30001, 2, 1), ("ÉÉ", 6, 1, 1)} and len(got) == 4


def test_pivots_are_disjoint_and_rarest():
    ranks = {"ab": 0, "bc": 1, "cd": 5, "de": 9, "ef": 8, "fg": 7}
    got = sv.prefix_and_pivots("abcdefg", ranks)
    assert got == [(0, True), (1, False), (2, True)]
    same = {"aa": 0, "ab": 1}
    assert [p for p, _ in sv.prefix_and_pivots("aaaaaaaa", same)] == [0, 1, 2, 3]  # one place more of an equal bigram
