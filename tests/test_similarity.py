"""Blocked similarity operators against brute force on small fixtures, with
block sizes forced small so that several blocks and user chunks take part."""

import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
import pytest

from conftest import SF_SMALL
from pickwise.operators import similarity
from pickwise.sources import fixtures as fx


def _edges(df):
    return {(r["productId"], r["simProductId"]): r["score"] for r in df.collect()}


def _brute_cosine(ids, x, threshold):
    x = np.asarray(x, dtype=np.float64)
    n = np.linalg.norm(x, axis=1)
    out = {}
    for i in range(len(ids)):
        for j in range(len(ids)):
            if i == j or n[i] == 0 or n[j] == 0:
                continue
            s = round(float(x[i] @ x[j] / (n[i] * n[j])), 10)
            if s > threshold:
                out[(ids[i], ids[j])] = s
    return out


def test_cosine_blocked_equals_brute_force(spark):
    v = fx.item_vectors(spark, SF_SMALL)
    rows = v.collect()
    ids = [r["productId"] for r in rows]
    want = _brute_cosine(ids, [r["features"] for r in rows], 0.4)
    got = _edges(similarity.cosine_all_pairs(v, block_size=64))   # 500 vectors -> 8 blocks
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert all((b, a) in got for (a, b) in got)                      # symmetric
    assert all(a != b for (a, b) in got)


def test_cosine_zero_vector_dropped(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0])],
                               "productId int, features array<double>")
    got = _edges(similarity.cosine_all_pairs(df, block_size=2))
    assert set(got) == {(2, 3), (3, 2)}


def test_item_cf_blocked_equals_brute_force(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    pairs = {(r["userId"], r["productId"]) for r in r2.select("userId", "productId").distinct().collect()}
    users_of = defaultdict(set)
    for u, p in pairs:
        users_of[p].add(u)
    want = {}
    for p in users_of:
        for q in users_of:
            if p == q:
                continue
            c = len(users_of[p] & users_of[q])
            if c == 0:
                continue
            s = round(c / math.sqrt(len(users_of[p]) * len(users_of[q])), 10)
            if s > 0.4:
                want[(p, q)] = s
    got = _edges(similarity.item_cf_edges(r2, item_block=16, user_chunk=4))   # 7 blocks x 4 chunks
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    default = _edges(similarity.item_cf_edges(r2))
    assert default == got


def test_item_cf_hot_user(spark):
    """A user holding a third of all rows is one row of a chunk matrix; counts stay exact."""
    rows = [(0, p) for p in range(60)] + [(u, u % 60) for u in range(1, 121)]
    df = spark.createDataFrame(rows, "userId int, productId int")
    got = _edges(similarity.item_cf_edges(df, threshold=0.0, item_block=8, user_chunk=16))
    # every product has users {0, two others}; any two products share exactly user 0
    assert len(got) == 60 * 59
    assert all(abs(s - round(1 / 3, 10)) < 1e-12 for s in got.values())


def test_content_features_exact(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, "  ")], "productId int, text string")
    got = {(r["productId"], r["term"]): (r["tf"], r["weight"]) for r in similarity.content_features(df).collect()}
    n = 3
    assert got[(1, "b")][0] == 2
    assert abs(got[(1, "b")][1] - 2 * math.log((n + 1) / (2 + 1))) < 1e-12
    assert abs(got[(2, "c")][1] - math.log((n + 1) / (1 + 1))) < 1e-12
    assert (3, "") not in got


def test_content_based_equals_brute_force(spark):
    d = fx.product_text(spark, SF_SMALL)
    vec = similarity.hashed_tfidf_vectors(d)
    rows = vec.collect()
    assert all(len(r["features"]) == 200 for r in rows)
    want = _brute_cosine([r["productId"] for r in rows], [r["features"] for r in rows], 0.4)
    got = _edges(similarity.cosine_all_pairs(vec, block_size=50))
    assert got.keys() == want.keys()
    assert _edges(similarity.content_based_edges(d)).keys() == want.keys()


@pytest.mark.parametrize("dense_factor,slice_cells", [(0, 7), (10**12, 5), (100, 3), (100, 16_000_000)])
def test_block_counts_kernel_paths(monkeypatch, dense_factor, slice_cells):
    """The in-group kernel gives exact counts on the sparse path, the dense
    path and their mix, with slices small enough to split users."""
    rng = np.random.default_rng(7)
    n_users, n_i, n_j = 40, 9, 11
    ul = rng.integers(0, n_users, 300)
    il = rng.integers(0, n_i, 300)
    ur = rng.integers(0, n_users, 250)
    ir = rng.integers(0, n_j, 250)
    ul = np.concatenate([ul, np.zeros(n_i, dtype=int)])       # user 0 is hot: every left item
    il = np.concatenate([il, np.arange(n_i)])
    # distinct (user, item) rows, as the operator feeds it
    left = np.unique(np.stack([ul, il], 1), axis=0)
    right = np.unique(np.stack([ur, ir], 1), axis=0)
    want = np.zeros((n_i, n_j), dtype=np.int64)
    for u in range(n_users):
        li = left[left[:, 0] == u, 1]
        rj = right[right[:, 0] == u, 1]
        for a in li:
            for b in rj:
                want[a, b] += 1
    monkeypatch.setattr(similarity, "DENSE_FACTOR", dense_factor)
    monkeypatch.setattr(similarity, "SLICE_CELLS", slice_cells)
    got = similarity._block_counts(left[:, 0], left[:, 1], right[:, 0], right[:, 1], n_users, n_i, n_j)
    assert (got == want).all()


def test_item_cf_sparse_and_dense_paths_end_to_end(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    sparse = _edges(similarity.item_cf_edges(r2, item_block=16, user_chunk=4, dense_factor=0))
    dense = _edges(similarity.item_cf_edges(r2, dense_factor=10**12))
    assert sparse == dense and len(dense) > 0


def test_cooc_layout():
    assert similarity.cooc_layout(150, 100, 7000) == (1, 1)
    nb, nc = similarity.cooc_layout(10**8, 10**6, 10**10)
    assert nb <= 245 and 10**6 / nb <= similarity.MAX_ITEM_BLOCK
    assert 2.0 * 10**10 / nb / nc <= similarity.TARGET_GROUP_ROWS
    # mid-size input on a wide cluster: enough groups for the cores, none tiny
    nb, nc = similarity.cooc_layout(10**6, 1000, 10**7, parallelism=64)
    assert nb == 1 and nc == 40
    assert similarity.cooc_layout(150, 100, 7000, parallelism=64) == (1, 1)


@pytest.mark.parametrize("slice_cols", [1, 3, 1000])
def test_cosine_block_kernel_slices(slice_cols):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 4))
    x[5] = 0.0
    ids = np.arange(100, 112)
    want = _brute_cosine(list(ids), x, 0.1)
    diag = similarity._cosine_block(ids, x, ids, x, True, 0.1, slice_cols)
    got = {(int(a), int(b)): v for a, b, v in diag.itertuples(index=False)}
    assert got.keys() == want.keys()
    # off-diagonal: split the same rows into two blocks; the union covers every ordered pair
    a, b = slice(0, 7), slice(7, 12)
    parts = [similarity._cosine_block(ids[a], x[a], ids[a], x[a], True, 0.1, slice_cols),
             similarity._cosine_block(ids[b], x[b], ids[b], x[b], True, 0.1, slice_cols),
             similarity._cosine_block(ids[a], x[a], ids[b], x[b], False, 0.1, slice_cols)]
    got2 = {(int(p), int(q)): v for part in parts for p, q, v in part.itertuples(index=False)}
    assert got2.keys() == want.keys()


def test_hot_item_and_hot_user_stay_in_small_groups(spark):
    """An item that every user rated and a user who rated every item: the largest group stays near its target, copies
    follow the users' histories, and the counts equal brute force."""
    from collections import Counter
    from itertools import permutations

    rng = np.random.default_rng(9)
    pairs = {(u, 0) for u in range(3000)} | {(0, p) for p in range(200)}
    pairs |= {(int(u), int(p)) for u, p in zip(rng.integers(0, 3000, 2000), rng.integers(0, 200, 2000))}
    ui = spark.createDataFrame(sorted(pairs), "userId int, productId int")
    target = 600
    rows = similarity.route(ui, 8, 1, target)
    largest = rows.groupBy("chunk", "lo", "hi").count().agg(F.max("count")).first()[0]
    one_user = 200                                    # the hot user's items can't be cut
    assert largest <= 1.5 * target + one_user
    assert rows.count() < 4 * len(pairs)              # 8 copies of each row if every row went to all its block pairs
    got = {(r["productId"], r["simProductId"]): r["cnt"] for r in similarity.cooccurrence_counts(
        ui, 3000, 200, len(pairs), item_block=25, target_rows=target).collect()}
    of_user = {}
    for u, p in pairs:
        of_user.setdefault(u, []).append(p)
    want = Counter(x for items in of_user.values() for x in permutations(items, 2))
    assert got == dict(want)


def test_ranked_lists_with_counted_products_equal_the_join(spark):
    """Lists that meet counted products by a broadcast give the rows of the general join."""
    from pickwise.operators.ranking import top_k_per_key
    from pickwise.plans import serving

    d = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 7}" for k in range(1, 6))) for i in range(40)] + [(3, "w1 w2 w3")],
                              "productId int, text string")
    edges = similarity.content_based_edges(d, block_size=1000)
    ranked = top_k_per_key(edges, "productId", None, item="simProductId")
    products = spark.createDataFrame([(i, f"n{i}", "", "c", "t") for i in range(0, 60, 2)] + [(2, "again", "", "c", "t")],
                                     "productId int, name string, imageUrl string, categories string, tags string")
    ratings = spark.createDataFrame([(1, 2, 3.0), (2, 2, 4.0), (1, 50, 1.0)], "userId int, productId int, score double")
    cols = ["queryProductId", "rank", "productId", "name", "recScore", "score"]
    got = serving.ranked_to_products(ranked, products, ratings, d).select(cols)
    assert sorted(got.collect()) == sorted(serving.ranked_edges_to_products(edges, None, products, ratings).select(cols).collect())


def _ranked_rows(df):
    return sorted((r["productId"], r["rank"], r["simProductId"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("size,rows,broadcast", [(7, 3, 1 << 20), (7, 3, 0), (1000, 4, 1 << 20), (None, 256, 1 << 20)])
def test_ranked_lists_equal_edges_and_window(spark, monkeypatch, size, rows, broadcast):
    """One row a list entry, ranked as the window does: ids that come twice (with other vectors) have one list, a zero vector
    has none, null ids come out as from the edges; without room for the blocks the window ranks. Some blocks may be empty."""
    from pickwise.operators.ranking import top_k_per_key

    rng = np.random.default_rng(11)
    x = rng.integers(-2, 4, size=(63, 5)).astype(float)  # small integers: many ties
    x[7] = 0.0
    ids = [*range(50), *range(10), -5, None, None]
    v = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, x)], "productId int, features array<double>")
    monkeypatch.setattr(similarity, "MIN_RANKED_ROWS", rows)
    got = similarity.cosine_ranked(v, block_size=size, max_broadcast=broadcast)
    want = top_k_per_key(similarity.cosine_all_pairs(v, block_size=1000), "productId", None, item="simProductId")
    assert _ranked_rows(got) == _ranked_rows(want) != []
    plan = got._jdf.queryExecution().executedPlan().toString()
    if broadcast:
        assert "Window" not in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
    else:
        assert "Window" in plan


def test_ranked_lists_of_few_rows(spark):
    v = spark.createDataFrame([(4, [1.0, 0.0]), (9, [1.0, 0.1])], "productId int, features array<double>")
    assert similarity.cosine_ranked(v.where("productId < 0")).count() == 0
    assert similarity.cosine_ranked(v.where("productId = 4")).count() == 0
    got = similarity.cosine_ranked(v, block_size=1, digits=3)       # a block for each row, or one of them empty
    assert _ranked_rows(got) == [(4, 1, 9, 0.995), (9, 1, 4, 0.995)]


def test_ranked_lists_of_an_id_too_frequent_for_memory(spark, monkeypatch):
    """They are ranked by a window over the edges, with the same rows."""
    v = spark.createDataFrame([(i % 9 if i < 30 else 3, [1.0, float(i % 7), float(i % 5)]) for i in range(60)], "productId int, features array<double>")
    want = _ranked_rows(similarity.cosine_ranked(v, digits=4))
    monkeypatch.setattr(similarity, "RANKED_CELLS", 100)
    by_window = similarity.cosine_ranked(v, digits=4)
    assert _ranked_rows(by_window) == want != []
    assert "Window" in by_window._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("digits", [0, 3, 6, 10])
def test_scores_are_rounded_as_round_does(spark, digits):
    units = np.array([4_123_455_000, 4_123_455_001, 4_123_454_999, 4_999_995_000, 10**10, 5 * 10**9, -4_123_455_000, -1, 0], np.int64)
    df = spark.createDataFrame([(i, float(u) / 10**10) for i, u in enumerate(units)], "i int, s double")
    want = [r["s"] for r in df.select("i", F.round("s", digits).alias("s")).orderBy("i").collect()]
    assert similarity._half_up(units, digits).tolist() == want


def test_ranked_rows():
    assert similarity.ranked_rows(500, 12) == 256 and similarity.ranked_rows(51_282, 6) == 156
    for n in (1, 10_000, 256_410, 10**6, 10**8):
        assert 1 <= similarity.ranked_rows(n, 12) <= max(1, similarity.RANKED_CELLS / n)


def test_content_lists_equal_edges_and_window(spark):
    """M8's lists; as products with rounded scores, the rows of the general join."""
    from pickwise.operators.ranking import top_k_per_key
    from pickwise.plans import serving

    d = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 7}" for k in range(1, 6))) for i in range(40)] + [(3, "w1 w2 w3"), (41, "")],
                              "productId int, text string")
    edges = similarity.content_based_edges(d, block_size=1000)
    ranked = similarity.content_based_ranked(d, block_size=9, digits=6)
    window = top_k_per_key(edges, "productId", None, item="simProductId")
    assert _ranked_rows(ranked) == _ranked_rows(window.withColumn("score", F.round("score", 6))) != []
    products = spark.createDataFrame([(i, f"n{i}", "", "c", "t") for i in range(0, 60, 2)] + [(2, "again", "", "c", "t")],
                                     "productId int, name string, imageUrl string, categories string, tags string")
    ratings = spark.createDataFrame([(1, 2, 3.0), (2, 2, 4.5), (3, 2, 1.0), (1, 50, 1.0)], "userId int, productId int, score double")
    cols = ["queryProductId", "rank", "productId", "name"]
    got = serving.ranked_to_products(ranked, products, ratings, d, 6).select(*cols, "recScore", "score")
    want = serving.ranked_edges_to_products(edges, None, products, ratings).select(
        *cols, F.round("recScore", 6).alias("recScore"), F.round("score", 6).alias("score"))
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("most", [1, 3, 100])
def test_content_features_rare_terms(spark, most):
    """Terms over the broadcast bound meet their idf by a shuffle; ids that come twice count as one text; the term rows meet no
    exchange where all are broadcast."""
    from collections import Counter
    rows = [(i, " ".join(["a", "b" if i % 2 else "B"] + [f"t{i // 3}"] * (i % 3 + 1) + [f"u{i}"])) for i in range(24)] + [(5, "a z"), (6, None)]
    df = spark.createDataFrame(rows, "productId int, text string")
    out = similarity.content_features(df, max_broadcast=most)
    got = {(r["productId"], r["term"]): (r["tf"], r["idf"], r["weight"]) for r in out.collect()}
    tf = Counter((i, w) for i, s in rows for w in (s or "").lower().split())
    dfreq = Counter(w for _, w in tf)
    assert got.keys() == tf.keys() and out.count() == len(tf)
    for (i, w), (n, idf, weight) in got.items():
        assert n == tf[i, w] and abs(idf - math.log((len(rows) + 1) / (dfreq[w] + 1))) < 1e-12 and abs(weight - n * idf) < 1e-12
    if most == 100:
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") >= 1 and "term" not in plan.split("RepartitionByExpression")[-1].split("\n")[0]


def test_text_partitions():
    assert similarity.text_partitions(0, 12) == 1 and similarity.text_partitions(3_000_000, 12) == 3
    assert similarity.text_partitions(25_000_000, 12) == 12 and similarity.text_partitions(10**10, 12) == 1250
