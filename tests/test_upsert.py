"""The upsert log: equal to one aggregate over all rows, at any point between appends and compactions."""

import os
import random

import pytest
from pyspark.sql import types as T

from pickwise.operators import ranking
from pickwise.sources.upsert import UpsertLog

ROW = "userId int, productId int, score double, timestamp long, seq long"


def _log(spark, root):
    return UpsertLog(spark, root, keys=["userId", "productId"], latest={"score": T.DoubleType()}, order=["timestamp", "seq"],
                     first={"firstTimestamp": "timestamp"}, bucket_key="userId", buckets=8)


def _rows(df, time="firstTimestamp"):
    return sorted(tuple(r) for r in df.select("userId", "productId", "score", time).collect())


def _whole(spark, rows):
    return _rows(ranking.latest_rating_upsert(spark.createDataFrame(rows, ROW)), "timestamp")


def _delta(rng, n, users, start):
    return [(rng.choice(users), rng.randint(1, 4), float(rng.randint(1, 5)), rng.randint(0, 50), start + i) for i in range(n)]


def test_equals_the_whole_aggregate(spark, tmpdir_path):
    rng, log, every = random.Random(3), _log(spark, f"{tmpdir_path}/t"), []
    assert log.read().count() == 0 and log.compact() == 0 and log.retire() == 0
    for n in range(5):
        rows = _delta(rng, 40, [1, 2, 3] if n % 2 else list(range(20)), 100 * n)
        every += rows
        log.append(spark.createDataFrame(rows, ROW), "request", f"r{n}")
        assert _rows(log.read()) == _whole(spark, every)
        if n in (1, 2, 4):
            assert log.compact() == (2 if n != 2 else 1)
            assert _rows(log.read()) == _whole(spark, every)
            log.retire(keep=1)
    log.append(spark.createDataFrame(rows, ROW), "request", "r4")      # run again after it was merged in
    assert _rows(log.read()) == _whole(spark, every) and log.compact() == 0


def test_compaction_rewrites_only_touched_buckets(spark, tmpdir_path):
    log = _log(spark, f"{tmpdir_path}/t")
    log.append(spark.createDataFrame([(u, 1, 1.0, 1, u) for u in range(40)], ROW), "request", "a")
    log.compact()
    first = log.manifest()[1]["files"]
    log.append(spark.createDataFrame([(7, 1, 2.0, 9, 99)], ROW), "request", "b")
    log.compact()
    second = log.manifest()[1]["files"]
    assert sum(first[b] != second[b] for b in first) == 1 and len(second) == len(first) == 8
    run = next(second[b] for b in second if first[b] != second[b])
    assert len([d for d in os.listdir(f"{tmpdir_path}/t/base/{run}") if d.startswith("bucket=")]) == 1
    held = log._base_rows(log.manifest()[1])
    assert log.retire(keep=1, drop_deltas=True) == 3                    # the old bucket and both deltas
    assert held.where("userId = 7").first()["score"] == 2.0 and log.read().count() == 40


def test_crash_between_write_and_publish(spark, tmpdir_path, monkeypatch):
    log = _log(spark, f"{tmpdir_path}/t")
    rows = [(u, 1, 1.0, 1, u) for u in range(10)]
    log.append(spark.createDataFrame(rows, ROW), "request", "a")
    log.compact()
    log.append(spark.createDataFrame([(3, 1, 5.0, 9, 99)], ROW), "request", "b")
    want = _whole(spark, [*rows, (3, 1, 5.0, 9, 99)])

    def dies(self, manifest):
        raise RuntimeError("before the pointer")

    with monkeypatch.context() as m:
        m.setattr(UpsertLog, "_publish", dies)
        with pytest.raises(RuntimeError):
            log.compact()
    assert _rows(log.read()) == want
    assert log.compact() == 1 and _rows(log.read()) == want
    os.makedirs(f"{tmpdir_path}/t/delta/request=unfinished")            # no _SUCCESS: not there yet
    assert _rows(log.read()) == want
