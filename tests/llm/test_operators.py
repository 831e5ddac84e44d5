"""Each operator against a brute-force version on rows with nulls, ties and repeats, and on an empty table."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from pickwise.llm import (exact_dedup, minhash_dedup, packing, quality_rules, sentencepiece_nbest, sharding,
                          token_counts, toxicity, url_filters, warc)
from pickwise.session import scratch_path

from .conftest import ROWS

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
MODEL, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_sharding(docs, none):
    rows = sharding.shard_by_bytes(docs, 3).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in rows) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS)
    of = collections.defaultdict(list)
    for r in rows:
        of[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in of.values())
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    ids = [r.doc_id or -1 for r in ordered]
    assert ids == sorted(ids)
    assert sharding.shard_by_bytes(none, 3).count() == 0


def test_sharding_balances_bytes(spark):
    sizes = [len("x" * (i * 37 % 101)) + 1 for i in range(500)]
    df = spark.createDataFrame([(i, "x" * (i * 37 % 101)) for i in range(500)], "doc_id long, text string")
    by = collections.Counter()
    for r in sharding.shard_by_bytes(df, 7).collect():
        by[r.shard] += r["size"]
    assert max(by.values()) - min(by.values()) <= 2 * max(sizes) and sum(by.values()) == sum(sizes)


def test_url_parts_and_rules(spark):
    urls = [(1, "http://A.Example.NET/en/5?x#y"), (2, None), (3, "no scheme/x"), (4, "https://b.org/fr/1"),
            (5, "https://borg/fr/1"), (6, "http://x.net"), (7, "s://example.com/de/q"), (7, "s://example.com/de/q")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, good int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, labels).collect()}
    assert got == {1: ("a.example.net", "/en/5", "example.net/en/", "allow"), 2: ("", "", None, "allow"),
                   3: ("", "", None, "allow"), 4: ("b.org", "/fr/1", "org/fr/", "allow"),
                   5: ("borg", "/fr/1", None, "allow"), 6: ("x.net", "", None, "allow"),
                   7: ("example.com", "/de/q", "example.com/de/", "block")}
    assert url_filters.judge(pages, labels).count() == 8
    assert url_filters.judge(pages.limit(0), labels).count() == 0


def test_url_templates_reject_impure_branches(spark):
    pages = spark.createDataFrame([(i, f"http://h.test/{'bad' if i % 3 == 0 else 'ok' + str(i % 2)}/{i}.html")
                                   for i in range(300)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 300, 2)], "page_id long, good int")
    for r in url_filters.judge(pages, labels).collect():
        assert r.verdict == ("block" if "/bad/" in r.path else "allow"), r
        # bad and ok0 each differ from the labelled pages beside them; ok1 has none and is merged
        branch = r.path.split("/")[1]
        assert r.template == f"h.test/{'*' if branch == 'ok1' else branch}/*"


def test_url_templates_reject_deep_branches(spark):
    deep = "a/b/c/d/e/f/g"
    pages = spark.createDataFrame([(i, f"http://h.test/{deep}/{'spam' if i % 3 == 0 else 'ok'}/{i}.html") for i in range(300)],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 300, 2)], "page_id long, good int")
    got = {(r.path.split("/")[-2], r.template.split("/")[-2], r.verdict) for r in url_filters.judge(pages, labels).collect()}
    assert got == {("spam", "spam", "block"), ("ok", "ok", "allow")}


def _shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(w)
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def _components(rows):
    """component of each row by comparing all rows."""
    sets = [_shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {c: min((rows[k][0] for k in range(len(rows)) if comp[k] == c and rows[k][0] is not None), default=None)
             for c in set(comp)}
    return [(rows[k][0], len(sets[k]), least[comp[k]]) for k in range(len(rows))]


def test_near_duplicates(spark, docs, none):
    base = [" ".join(f"w{(i * 7 + k) % 997}" for k in range(60)) for i in range(0, 400, 40)]
    more = [(100 + 10 * n + v, " ".join(w if k != 5 * v else f"edit{v}" for k, w in enumerate(t.split())), "")
            for n, t in enumerate(base) for v in range(4)]
    rows = ROWS + more
    df = spark.createDataFrame(rows, docs.schema)
    got = minhash_dedup.near_duplicates(df, width=2).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        _components([(i, t) for i, t, _ in rows]), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash_dedup.near_duplicates(none).count() == 0
    assert minhash_dedup.drop_near_duplicates(df).columns == df.columns


def _crowd(n, template, own, edits):
    """``n`` documents that share a passage, each with a near copy (its last ``edits`` words changed)."""
    rows = []
    for i in range(n):
        words = [f"t{k}" for k in range(template)] + [f"d{i}x{k}" for k in range(own)]
        rows += [(i, " ".join(words)), (n + i, " ".join(words[:len(words) - edits] + [f"e{i}y{k}" for k in range(edits)]))]
    return rows


def _without_first_pass(monkeypatch):
    whole, calls = minhash_dedup._pairs, []

    def pairs(*args):
        calls.append(args)
        return whole(*args).limit(0) if len(calls) == 1 else whole(*args)
    monkeypatch.setattr(minhash_dedup, "_pairs", pairs)


def test_near_duplicates_without_a_first_pass_partner(spark, monkeypatch):
    _without_first_pass(monkeypatch)
    rows = _crowd(40, 60, 45, 9)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 40 for i, _ in rows}


def test_near_duplicates_in_a_large_node(spark, monkeypatch):
    # no pair is found by the first pass, and the crowd's nodes are larger than what earlier versions reached
    _without_first_pass(monkeypatch)
    for name, value in (("NODE", 2), ("REACH", 4), ("BLOCK", 40)):
        monkeypatch.setattr(minhash_dedup, name, value, raising=False)
    rows = _crowd(300, 85, 25, 8)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 300 for i, _ in rows}


def test_large_groups_count_exactly():
    rng = np.random.default_rng(3)
    sets = np.empty(1200, object)
    sets[:] = [np.unique(np.r_[np.arange(60), rng.integers(100, 400, 40)]) for _ in range(1200)]
    empty = np.zeros(1200, object)
    rows = minhash_dedup._Rows(empty, empty, empty, empty, np.array([len(x) for x in sets]), empty, sets)
    x, y = np.arange(600), np.arange(600, 1200)
    got = minhash_dedup._shared(rows, x, y)
    for i in range(0, 600, 7):
        for j in range(0, 600, 11):
            assert got[i, j] == len(np.intersect1d(sets[x[i]], sets[y[j]]))


def test_quality_figures(docs, none):
    labels = docs.select("doc_id").where("doc_id = 1")
    weights = quality_rules.fit(docs, labels)
    got = quality_rules.judge(docs, weights).collect()
    for r, (i, t, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)),
                            sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        w = WORDS.findall(t or "")
        c = collections.Counter(zip(w, w[1:], w[2:]))
        marked = {p for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        assert (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(marked))
        assert r.base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(none, quality_rules.fit(none, labels)).count() == 0
    assert quality_rules.filter_documents(docs, weights).columns == docs.columns


def _gram_scores(rows, trusted):
    """(score, kept) of (doc_id, text) rows by the plain formula, and the trusted identifiers' counts."""
    def buckets(text):
        w = [x.encode() for x in WORDS.findall(text or "")]
        one = [xxhash.xxh64_intdigest(x, 42) for x in w]
        return [h % quality_rules.BUCKETS for h in one + [xxhash.xxh64_intdigest(b, h) for h, b in zip(one, w[1:])]]
    raw, target = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if i in trusted:
            target.update(buckets(t))
    share = sum(target.values()) / max(1, sum(raw.values()))

    def weight(b):
        return math.log((target[b] + quality_rules.PRIOR) / (raw[b] * share + quality_rules.PRIOR)) if target else 0.0

    return [sum(map(weight, bs)) / len(bs) if (bs := buckets(t)) else 0.0 for _, t in rows]


def test_quality_score_equals_the_formula(spark, none):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = given.unionByName(spark.createDataFrame([r[:2] for r in ROWS if r[0] is None or r[0] < 7], "doc_id long, text string"))
    rows = [tuple(r) for r in df.collect()]
    trusted = {i for i, _ in rows if i is not None and i % 3 == 0}
    weights = quality_rules.fit(df, spark.createDataFrame([(i,) for i in trusted], "doc_id long"))
    got = quality_rules.judge(df, weights).collect()
    want = _gram_scores(rows, trusted)
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 4))
    mine = sorted([(r.doc_id, r.quality_score, r.kept, r.base_failed) for r in got], key=key)
    assert len(mine) == len(rows)
    for (i, score), (j, s, kept, failed) in zip(sorted(((i, s) for (i, _), s in zip(rows, want)), key=key), mine, strict=True):
        assert i == j and abs(score - s) < 1e-4
        if abs(score - quality_rules.THRESHOLD) > 1e-4:
            assert kept == (not failed and score >= quality_rules.THRESHOLD)
    kept = sorted(r.doc_id for r in got if r.kept)
    assert sorted(r.doc_id for r in quality_rules.filter_documents(df, weights).collect()) == kept
    assert quality_rules.fit(df, none.select("doc_id")).any() == False  # noqa: E712 - nothing trusted: the base rules decide


def test_counting_grows_in_proportion_to_a_text(spark):
    """Four times the words, not sixteen times the time."""
    def seconds(n):
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: F.concat(F.lit("w"), x * F.col("id"))), " ")
        docs = spark.range(4).select(F.col("id").alias("doc_id"), text.alias("text"))
        best = math.inf
        for _ in range(2):
            started = time.perf_counter()
            quality_rules.bucket_counts(docs, spark.range(2).toDF("doc_id"), "doc_id", "text").write.format("noop").mode(
                "overwrite").save()
            best = min(best, time.perf_counter() - started)
        return best

    assert seconds(40_000) < 8 * seconds(10_000) + 2


def test_quality_counts_every_trusted_document(spark):
    n = 20_500
    df = spark.range(2 * n).selectExpr("id AS doc_id", "'word' AS text")
    (row,) = quality_rules.bucket_counts(df, spark.range(n).toDF("doc_id"), "doc_id", "text").collect()
    assert (row.raw, row.target) == (2 * n, n)


def test_packing(docs, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    want = collections.Counter()
    for i, t, _ in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for n in range(0, len(ids), 4096):
            part = ids[n:n + 4096]
            want[i, n // 4096, n, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += 1
    got = packing.pack(packing.token_pieces(docs, BPE)).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) == -(-sum(r.length for r in got) // 4096)
    assert packing.pack(packing.token_pieces(none, BPE)).count() == 0


def test_words_are_encoded_as_the_library_does():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABCÄÖÉéüßñøÿÀ×÷0123456789'.,!-_<>|&$@…²µªº\u00a0İΣ漢字é"
    words = {"".join(rng.choices(letters[:rng.choice([26, 40, 60, len(letters)])], k=rng.randint(1, 70 if n % 50 == 0 else 18)))
             for n in range(20_000)}
    words |= {"don't", "it's", "I'LL", "'S", "a'd", "<|endoftext|>", "x<|startoftext|>y", "<|", "STRASSE", "a" * 64, "a" * 65}
    words = [w for w in words if w.encode().split() == [w.encode()]]
    encoder = packing.WordEncoder(BPE)
    mine = encoder.words([w.encode() for w in words])
    for w, ids, e in zip(words, mine, encoder.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
        assert ids == np.array(e.ids, "<u4").tobytes(), w
    assert encoder.encode(["", " ".join(words[:500]), " ", words[0]]) == [b"", b"".join(mine[:500]), b"", mine[0]]


def test_best_fit_closes_the_fullest():
    assert packing.best_fit([6, 5, 4, 5], 10, 8) == ([0, 1, 0, 1], [0, 0, 6, 5])
    assert packing.best_fit([6, 5, 4], 10, 1) == ([0, 1, 1], [0, 0, 5])


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a/\r\nX: y", big), (2, "http://b/", big), (3, "http://c/", "small"), (4, "http://d/", "small"),
            (5, None, None), (2, "http://b/", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(pages, folder)
    got = warc.read_archive(spark, folder).collect()
    assert len(got) == 6
    for r in got:
        html = next(h for i, _, h in rows if i == r.page_id) or ""
        raw = html.encode()
        assert (bytes(r.payload), r.payload_bytes, r.payload_digest) == (raw, len(raw), hashlib.sha1(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 2) if r.page_id == 1 else ("response", None))
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith(raw if r.record_type == "response" else b"\r\n\r\n")
        assert head.count(b"WARC-Target-URI") == 1 and b"\r\nX: y" not in head
    empty = scratch_path(spark, "warc-test")
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_nbest(docs, none):
    lattice = sentencepiece_nbest.Lattice(MODEL, 4)

    def brute(text):
        meta = sentencepiece_nbest.META
        edges = lattice.edges(meta + text.replace(" ", meta) if text else "")
        best = [[0.0]]
        for end in range(1, len(edges)):
            best.append(sorted((s + q for a, q, _ in edges[end] for s in best[a]), reverse=True)[:4])
        return best[-1]

    got = sentencepiece_nbest.encode_nbest(docs, MODEL).collect()
    for r in got:
        text = next(t for i, t, _ in ROWS if i == r.doc_id) or ""
        assert r.scores == brute(text) and len(set(map(bytes, r.ids))) == len(r.ids) and r.round_trip
    best = sentencepiece_nbest.encode_nbest(docs, MODEL).selectExpr("doc_id", "ids[0] AS ids")
    for r in sentencepiece_nbest.decode_ids(best, MODEL).collect():
        assert r.text == (next(t for i, t, _ in ROWS if i == r.doc_id) or "")
    assert sentencepiece_nbest.encode_nbest(none, MODEL).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, none, keep):
    pick = max if keep == "largest" else min
    groups = collections.defaultdict(list)
    for i, t, _ in ROWS:
        groups[t or ""].append(i)
    got = exact_dedup.mark_copies(docs, keep=keep).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = next(t for i, t, _ in ROWS if i == r.doc_id) or ""
        ids = [i for i in groups[text] if i is not None]
        assert (r.keep_id, r.group_size) == (pick(ids) if ids else None, len(groups[text]))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert sum(r.kept for r in got) == len(groups) == exact_dedup.deduplicate(docs, keep=keep).count()
    assert exact_dedup.mark_copies(none).count() == 0 and exact_dedup.deduplicate(none).columns == docs.columns


def test_token_counts_cache(spark, docs, none):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    cache = scratch_path(spark, "cache-test")
    assert token_counts.count_tokens(none, MODEL, cache).count() == 0
    for _ in range(2):  # the second run finds all contents in the cache
        got = token_counts.count_tokens(docs, MODEL, cache, limit=20).collect()
        assert len(got) == len(ROWS)
        for r in got:
            text = next(t for i, t, _ in ROWS if i == r.doc_id) or ""
            n = len(model.encode(text))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 20)
    assert spark.read.parquet(cache).count() == len({t or "" for _, t, _ in ROWS})


def test_nbest_on_hard_texts(spark):
    """Equal scores, letters without a piece, long words that no piece spans, and meta spaces in the text itself."""
    lattice = sentencepiece_nbest.Lattice(MODEL, 4)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("ab 漢ß\u2581é😀\x00", k=rng.randint(1, 12))) for _ in range(rng.randint(1, 6))) for _ in range(150)]
    texts += ["a" * 500, "漢字" * 300, "ab " * 50, " ", "  x", "\u2581\u2581", "word" * 20 + " " + "ß" * 90]
    for text, (scores, paths, n, same) in zip(texts, lattice.encode(texts)):
        meta = sentencepiece_nbest.META
        edges = lattice.edges(meta + text.replace(" ", meta))
        best = [[0.0]]
        for end in range(1, len(edges)):
            best.append(sorted((s + q for a, q, _ in edges[end] for s in best[a]), reverse=True)[:4])
        assert [round(s, 6) for s in scores] == [round(s, 6) for s in best[-1]], text
        assert len(set(paths)) == len(paths) and 4 * n == len(paths[0])
        assert same == (meta not in text)
        for s, p in zip(scores, paths):  # every path is one of the text, with its score
            assert lattice.decode(np.frombuffer(p, "<u4"))[1:].decode() == text.replace(meta, " ")
    assert lattice.encode(texts[:3] + [""]) == [lattice.encode([t])[0] for t in texts[:3] + [""]]


def test_toxicity_equals_a_plain_chain(spark):
    """Fold by fold with dense matrices and Newton steps to the minimum."""
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(30)] + ["vile", "scum"]
    rows = []
    for i in range(120):
        text = [words[k] for k in rng.integers(0, 30, 6)] + (["vile"] if i % 4 == 0 else []) + (["scum"] if i % 8 < 2 else [])
        rows.append((i, " ".join(text), int(i % 8 < 2), int(i % 4 == 0)))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(500, None, 1), (0, 1, 1)], "doc_id long, low int, toxic int")
    labels = labels.where("doc_id <> 0 or low = 1").dropDuplicates(["doc_id"])
    chain = toxicity.fit(df, labels, ["low", "toxic"], folds=3)
    folds = {r.doc_id: r.f for r in df.select("doc_id", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(3)).alias("f")).collect()}
    ids = [toxicity.feature_ids(r[1]) for r in rows]
    used = np.unique(np.concatenate(ids))
    x = np.array([np.isin(used, i) for i in ids], float)
    fold = np.array([folds[r[0]] for r in rows])

    def newton(x, y):
        x1, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
        ridge = np.full(len(w), toxicity.REGULARISATION)
        ridge[-1] = 0
        for _ in range(60):
            p = toxicity.sigmoid(x1 @ w)
            h = (x1 * (p * (1 - p))[:, None]).T @ x1 / len(y) + np.diag(ridge) + 1e-12 * np.eye(len(w))
            w = w - np.linalg.solve(h, x1.T @ (p - y) / len(y) + ridge * w)
        return lambda z: toxicity.sigmoid(np.c_[z, np.ones(len(z))] @ w)

    before, want = np.zeros((len(rows), 0)), []
    given = np.zeros((len(rows), 0))
    for k in (2, 3):
        y = np.array([r[k] for r in rows], float)
        whole = newton(np.c_[x, before], y)
        want.append(whole(np.c_[x, given]))
        unseen = np.empty(len(rows))
        for f in range(3):
            unseen[fold == f] = newton(np.c_[x, before][fold != f], y[fold != f])(np.c_[x, before][fold == f])
        before, given = np.c_[before, unseen], np.c_[given, want[-1]]
    got = {r.doc_id: r for r in toxicity.judge(df, chain).collect()}
    for n, r in enumerate(rows):
        assert abs(got[r[0]].p_low - want[0][n]) < 0.05 and abs(got[r[0]].p_toxic - want[1][n]) < 0.05
        assert got[r[0]].toxic == (got[r[0]].p_toxic >= chain.threshold)
    assert {i for i, r in got.items() if r.toxic} == {r[0] for r in rows if r[3]}


def test_best_threshold(monkeypatch):
    p, y = np.array([.1, .2, .3, .4, .9]), np.array([0, 0, 1, 0, 1.])
    assert toxicity.best_threshold(p, y) == toxicity.THRESHOLD    # too few rows to choose by
    monkeypatch.setattr(toxicity, "EVIDENCE", 2)
    assert toxicity.best_threshold(p, y) == pytest.approx(0.65)   # one other less is worth a toxic row more
    assert toxicity.best_threshold(p, np.array([0, 0, 1, 1, 1.])) == 0.25
    assert toxicity.best_threshold(p, np.ones(5)) == toxicity.THRESHOLD
    assert toxicity.best_threshold(np.full(4, .5), np.array([0, 1, 0, 1.])) == .5


def test_toxicity_chain(spark, docs, none):
    rows = [(i, f"plain word{i} text {'vile scum' if i % 4 == 0 else 'kind folk'}", int(i % 4 == 0)) for i in range(80)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows if i < 40], "doc_id long, never int, toxic int")
    chain = toxicity.fit(df, labels, ["never", "toxic"], folds=2)
    got = {r.doc_id: r for r in toxicity.judge(df, chain).collect()}
    assert all(got[i].toxic == bool(y) and got[i].p_never == 0 for i, _, y in rows)  # held out: 40 and above
    assert toxicity.judge(docs, chain).count() == len(ROWS) and toxicity.judge(none, chain).count() == 0
    assert toxicity.drop_toxic(docs, chain).columns == docs.columns
    untrained = toxicity.fit(df, labels.limit(0), ["never", "toxic"])
    assert not any(r.toxic for r in toxicity.judge(df, untrained).collect())
