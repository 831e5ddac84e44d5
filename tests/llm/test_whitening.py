"""Whitening against NumPy's eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from pickwise.llm import whitening as wh

SF = "/root/testdata/sf0.001"


def check(rows, got, components=8):
    """``rows``: usable vectors; ``got``: collected result."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    y = (x - 100000).astype(float)
    centred = y - y.mean(axis=0)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * k
    deviations = sorted((i, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for (i, _), v in zip(rows, x))
    assert sorted({(r.vec_id, r.deviation) for r in got}) == sorted(set(deviations))
    assert all(r.n == n and r.identity_error < 1e-9 and int(r.deviation_exact) == r.deviation for r in got)
    for c in range(k):
        mine = sorted((r.vec_id, r.whitened) for r in got if r.component == c + 1)
        want = sorted(zip([i for i, _ in rows], centred @ vectors[:, c] / np.sqrt(values[c])))
        a, b = np.array([w for _, w in mine]), np.array([w for _, w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(abs(r.explained - values[c] / np.trace(cov)) < 1e-12 for r in got if r.component == c + 1)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(5)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(rows, wh.whiten(df).collect())


@pytest.mark.parametrize("name", ["copies", "flat", "few", "large"])
def test_hard_tables(spark, name):
    rng = np.random.default_rng(4)
    v = rng.normal(0, .3, (60, 12)) * np.linspace(1, .1, 12)
    v = {"copies": np.repeat(v[:20], 3, axis=0), "flat": np.hstack([v[:, :3], np.zeros((60, 9))]), "few": v[:5],
         "large": v * 1000}[name].astype(np.float32)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(40)
    check(rows, wh.whiten(df).collect())


def test_unusable_rows(spark):
    good = [(i, [float(i % 3), float(i % 5), float(i)]) for i in range(20)] + [(None, [0.5, 0.5, 0.5]), (3, [0.0, 3.0, 3.0])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [float("nan"), 0.0, 0.0]), (93, [float("inf"), 0.0, 0.0]),
           (94, [1.0, 2.0]), (95, []), (96, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in good + bad], "vec_id long, embedding array<float>, component int")
    got = wh.whiten(df).collect()
    assert len(got) == 3 * len(good) and all(r.n == len(good) for r in got)
    assert {r.vec_id for r in got} == {i for i, _ in good}


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    columns = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 4.0])], schema)).columns
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        out = wh.whiten(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns == columns


def test_deviations_are_exact_beyond_a_long():
    y = np.array([[2.0 ** 50, -3.0], [5.0, 7.0]])
    sums = wh.exact_sums(y)
    assert sums == [2 ** 50 + 5, 4]
    want = [sum((10 ** 6 * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in y]
    assert wh.deviations(y, 10 ** 6, sums) == want and want[0] > 2 ** 63


def test_rank_one_updates_keep_the_spectrum():
    rng = np.random.default_rng(0)
    for trial in range(60):
        d = int(rng.integers(1, 30))
        y = np.floor(1024 * rng.normal(0, .125, (int(rng.integers(2, 150)), d)))
        if trial % 3 == 0:
            y[:, :d // 2] = 0
        if trial % 4 == 0:
            y = np.repeat(y, 2, axis=0)
        whole = wh.Spectrum.empty(d)
        for a in range(0, len(y), 37):
            part = wh.Spectrum.empty(d)
            part.add_rows(y[a:a + 37])
            whole.merge(part)
        centred = y - y.mean(axis=0)
        scatter = centred.T @ centred
        assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - scatter).max() <= 1e-11 * max(1, np.abs(scatter).max())
        assert np.abs(whole.vectors.T @ whole.vectors - np.eye(d)).max() < 1e-11
