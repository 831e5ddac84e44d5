"""Invariants of the model operators (their outputs are not SQL-checkable)."""

import numpy as np

from conftest import SF_SMALL
from pickwise.operators import als
from pickwise.sources import fixtures as fx


def test_user_recs_invariants_and_brute_force(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    model = als.als_train(r2, blocks=2)
    recs = {r["userId"]: r["recs"] for r in als.user_recs(model).collect()}
    assert recs
    for lst in recs.values():
        assert 0 < len(lst) <= 20
        scores = [e["score"] for e in lst]
        assert scores == sorted(scores, reverse=True)
        assert all(s > 0 for s in scores)
    # brute force from the factors: the full user x item score matrix in NumPy
    uf = {r["id"]: np.array(r["features"], dtype=np.float64) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"], dtype=np.float64) for r in model.itemFactors.collect()}
    items = sorted(itf)
    m = np.stack([itf[i] for i in items])
    for u, lst in recs.items():
        s = m @ uf[u]
        order = sorted(range(len(items)), key=lambda j: (-s[j], items[j]))[:20]
        want = [items[j] for j in order if s[j] > 0]
        got = [e["productId"] for e in lst]
        assert len(got) == len(want)
        assert all(abs(float(s[items.index(g)]) - e["score"]) < 1e-4 for g, e in zip(got, lst))


def test_split_is_deterministic_and_disjoint(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    tr, te = als.train_test_split(r2)
    a = {r["seq"] for r in tr.collect()}
    b = {r["seq"] for r in te.collect()}
    assert not (a & b) and len(a | b) == r2.count()
    assert 0.7 < len(a) / (len(a) + len(b)) < 0.9
    tr2, _ = als.train_test_split(r2.repartition(7))
    assert {r["seq"] for r in tr2.collect()} == a


def test_grid_search_shape(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    tr, te = als.train_test_split(r2)
    grid = als.als_grid_search(spark, tr, te, ranks=(5, 10), regs=(1.0, 0.1), max_iter=3, blocks=2)
    rows = grid.collect()
    assert len(rows) == 4 and all(r["rmse"] > 0 for r in rows)
    best = als.best_params(grid).first()
    assert best["rmse"] == min(r["rmse"] for r in rows)


def test_grid_search_concurrency_does_not_change_results(spark):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    tr, te = als.train_test_split(r2)
    kw = dict(ranks=(5, 10), regs=(0.1, 0.01), max_iter=3, blocks=2)
    seq = sorted(tuple(r) for r in als.als_grid_search(spark, tr, te, parallelism=1, **kw).collect())
    par = sorted(tuple(r) for r in als.als_grid_search(spark, tr, te, parallelism=4, **kw).collect())
    # same grid points and RMSEs; the last bits of a distributed average depend on merge order
    assert [(r, lam) for r, lam, _ in seq] == [(r, lam) for r, lam, _ in par]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(seq, par))


def test_grid_fits_share_the_blocks(spark, monkeypatch):
    """Fits that run at once take their share of the cores as blocks, more where a block would grow too large, and never more than before."""
    cores = spark.sparkContext.defaultParallelism
    train = spark.range(1000).repartition(4 * cores)
    assert als.auto_blocks(train) == cores
    assert als.grid_blocks(train, cores) == 1 and als.grid_blocks(train, 2) == cores // 2 and als.grid_blocks(train, 1) == cores
    assert als.grid_blocks(train.coalesce(1), 2) == 1
    monkeypatch.setattr(als, "GRID_BLOCK_ROWS", 300)
    assert als.grid_blocks(train, cores) == 4


def test_grid_sides_send_the_many_factors_to_few_blocks(spark, monkeypatch):
    """The side with fewer ids has two blocks, more where a block would grow too large; small grids stay as they are."""
    many_users = spark.range(600).selectExpr("cast(id as int) userId", "cast(id % 7 as int) productId", "1.0 score")
    many_products = many_users.selectExpr("productId userId", "userId productId", "score")
    assert als.grid_sides(many_users, 1) == (1, 1) and als.grid_sides(many_users, 2) == (2, 2)
    assert als.grid_sides(many_users, 6) == (6, 2) and als.grid_sides(many_products, 6) == (2, 6)
    monkeypatch.setattr(als, "GRID_BLOCK_ROWS", 200)
    assert als.grid_sides(many_users, 6) == (6, 3)
    monkeypatch.setattr(als, "GRID_BLOCK_ROWS", 10)
    assert als.grid_sides(many_users, 6) == (6, 6)


def _known_ratings(spark):
    rows = [(u, p, float((u * 7 + p * 3) % 9) / 2 + 0.5) for u in range(40) for p in range(12) if (u + p) % 3]
    return spark.createDataFrame(rows + rows[:5], "userId int, productId int, score double")


def test_pairs_are_scored_as_the_model_does(spark, monkeypatch):
    """Same predictions with and without a broadcast, repeated pairs kept, unseen ids dropped, also with more products than users."""
    ratings = _known_ratings(spark)
    unseen = spark.createDataFrame([(1, 99, 2.0), (99, 1, 2.0), (2, 3, None)], ratings.schema)
    for train in (ratings, ratings.selectExpr("productId userId", "userId productId", "score")):
        pairs = train.unionByName(unseen)
        model = als.als_train(train, rank=3, max_iter=2, blocks=(3, 2))
        want = sorted(als.als_predict_pairs(model, pairs).select("score", "prediction").collect(), key=str)
        for cells in (als.FACTOR_BROADCAST_CELLS, 0):
            monkeypatch.setattr(als, "FACTOR_BROADCAST_CELLS", cells)
            got = sorted(als.scored_pairs(model, pairs).collect(), key=str)
            assert [r["score"] for r in got] == [r["score"] for r in want] and len(got) == train.count() + 1
            assert all(abs(a["prediction"] - b["prediction"]) < 1e-6 for a, b in zip(got, want))
        monkeypatch.undo()


def test_scored_pairs_shuffle_no_pair(spark):
    """Pairs that lie by user are not shuffled to be scored: only the users' factors are, and the products' are broadcast."""
    ratings = _known_ratings(spark)
    model = als.als_train(ratings, rank=3, max_iter=1, blocks=2)
    placed = ratings.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "userId").persist()
    placed.count()
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = als.scored_pairs(model, placed)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    placed.unpersist()
    shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "REPARTITION_BY_NUM" not in ln]
    assert len(shuffles) == 1 and "BroadcastExchange" in plan, plan


def test_grid_refuses_null_ids(spark):
    import pytest
    train = _known_ratings(spark)
    test = spark.createDataFrame([(1, None, 2.0)], train.schema)
    with pytest.raises(Exception, match="MUST NOT be Null"):
        als.als_grid_search(spark, train, test, ranks=(2,), regs=(0.1,), max_iter=1)
