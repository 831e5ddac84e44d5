"""Decontamination against a search of every window in every document."""

import hashlib
import random
import re

import pytest

from pickwise.llm import decontamination as dc

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    cut = [("" if i is None else str(i), words(t)) for i, t in items]
    windows = {}
    for i, w in cut:
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s:s + n])):
                    hit.update(range(s, s + n))
                    found |= own
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(spark, docs, items, **how):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, row long, words string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted([tuple(r) for r in dc.decontaminate(d, i, **how).collect()], key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = sorted([tuple(r) for r in dc.decontaminate(docs, items).collect()], key=repr)
    assert got == want and any(r[-1] for r in got)


@pytest.mark.parametrize("window, shingle", [(10, 5), (6, 3), (4, 8), (1, 1)])
def test_few_different_words(spark, window, shingle):
    """Repeated words everywhere: equal shingles in a window, overlapping and touching hits, short items."""
    rng = random.Random(window)
    docs = [(i, " ".join(rng.choices("aa b É9 x", k=1)[0] if rng.random() < .1 else rng.choice(["a", "b", "É", "9"])
                         for _ in range(rng.randint(0, 300)))) for i in range(30)]
    items = [(i, ", ".join(rng.choice(["A", "b", "É", "9"]) for _ in range(rng.randint(0, 14)))) for i in range(25)]
    got = result(spark, docs, items, window=window, shingle=shingle)
    assert got == brute(docs, items, window) and any(r[2] for r in got)


def test_edge_rows(spark):
    passage = " ".join(f"W{i}" for i in range(30))
    docs = [(1, None), (2, ""), (3, "!!! ..."), (4, passage), (4, passage), (None, f"x {passage.upper()} y"), (5, "w0 w1 w2"),
            (6, passage.replace(" ", "\x00-") + " tail"), (7, ("q " * 40000) + passage), (8, "w" * 5000 + "1"), (9, "w" * 5000 + "2")]
    items = [(1, passage), (1, passage), (None, passage), (2, ""), (3, None), (4, "w1 w2"), (5, "w" * 5000 + "1"), (6, "Ä W0 W1")]
    got = result(spark, docs, items)
    assert got == brute(docs, items)
    assert result(spark, docs, []) == brute(docs, []) and result(spark, [], items) == []


def test_hot_passage_is_dealt_to_several_tasks(spark):
    """A third of the documents hold one item, whose windows many items share."""
    shared = " ".join(f"s{i}" for i in range(14))
    docs = [(i, f"a{i} {shared} b{i}" if i % 3 == 0 else f"c{i} d{i}") for i in range(300)]
    items = [(i, f"{shared} t{i}") for i in range(20)]
    assert result(spark, docs, items) == brute(docs, items)
