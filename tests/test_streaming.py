"""Stream = batch: replay R2 as rating-line files through the foreachBatch
pipeline and compare the final recommendation table with the batch SP plan."""

import os
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pickwise.operators import priority, ranking, similarity
from pickwise.sources import fixtures as fx
from pickwise.sources.keyed import KeyedTable, current_keyed, publish_keyed
from pickwise.sources.versions import current_path, current_version, publish, retire, versions
from pickwise.streaming.pipeline import (OnlinePaths, compact_stream_recs, rating_stream_query,
                                         read_stream_recs, recent_queue_state)


def _write_line_files(spark, r2, root, n_files=4):
    """Write R2 as text files split by time, oldest first, with increasing mtimes."""
    lines = r2.select(
        "seq", "timestamp",
        F.concat(F.lit("PRODUCT_RATING_PREFIX:"),
                 F.concat_ws("|", "userId", "productId", F.col("score").cast("string"),
                             F.col("timestamp").cast("string"), F.col("seq").cast("string"))).alias("value"))
    rows = lines.orderBy("timestamp", "seq").collect()
    os.makedirs(root, exist_ok=True)
    per = (len(rows) + n_files - 1) // n_files
    base = time.time() - 1000
    for i in range(n_files):
        chunk = rows[i * per:(i + 1) * per]
        extra = ["garbage line", "1|2|x|3"] if i == 1 else []
        p = os.path.join(root, f"part-{i:03d}.txt")
        with open(p, "w") as f:
            f.write("\n".join([r["value"] for r in chunk] + extra) + "\n")
        os.utime(p, (base + i * 10, base + i * 10))


def _recs_rows(df):
    return sorted((r["userId"], tuple((e["productId"], round(e["score"], 9)) for e in r["recs"]))
                  for r in df.collect())


def _paths(root):
    return OnlinePaths(lists=f"{root}/lists", recs=f"{root}/recs", rejects=f"{root}/rejects", metrics=f"{root}/metrics")


def _publish(spark, paths, edges, buckets=8):
    return publish_keyed(spark, paths.lists, ranking.collect_recs_per_key(edges), "productId", buckets)


def test_stream_equals_batch(spark, tmpdir_path):
    r2 = fx.ratings_r2(spark, SF_SMALL)
    edges = similarity.item_cf_edges(r2).persist()
    paths = _paths(tmpdir_path)
    _publish(spark, paths, edges)
    src = f"{tmpdir_path}/in"
    _write_line_files(spark, r2, src)

    def run():
        stream = (spark.readStream.option("maxFilesPerTrigger", 1).text(src))
        q = rating_stream_query(stream, paths, f"{tmpdir_path}/ckpt", trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    # A10: the batches' counts add up to the input
    metrics = spark.read.parquet(paths.metrics)
    assert metrics.select(F.sum("rows"), F.sum("valid"), F.sum("rejected"), F.count_distinct("batch_id")).first() == (
        r2.count() + 2, r2.count(), 2, 4)
    assert {r["model"] for r in metrics.collect()} == {current_version(spark, paths.lists)}
    got = _recs_rows(read_stream_recs(spark, paths.recs))

    prio = priority.stream_priority(r2.select("userId", "productId", "score", "timestamp", "seq"), edges)
    want = _recs_rows(priority.stream_recs_table(prio, r2.select("userId")))
    assert got == want
    assert len(got) == r2.select("userId").distinct().count()

    # malformed lines are kept aside, not lost
    rejects = spark.read.parquet(paths.rejects)
    assert sorted(r["value"] for r in rejects.collect()) == ["1|2|x|3", "garbage line"]

    # compaction: the folded lists are the same
    n_batches = len([d for d in os.listdir(f"{paths.recs}/delta") if d.startswith("batch_id=")])
    assert compact_stream_recs(spark, paths.recs) == n_batches
    assert _recs_rows(read_stream_recs(spark, paths.recs)) == got
    assert compact_stream_recs(spark, paths.recs) == 0          # nothing new: no rewrite

    # restart from the checkpoint: nothing new, nothing changes
    run()
    assert [d for d in os.listdir(f"{paths.recs}/delta") if d.startswith("batch_id=")] == []
    assert _recs_rows(read_stream_recs(spark, paths.recs)) == got
    edges.unpersist()


def _put_lines(root, name, lines, age):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(f"{root}/{name}", (time.time() - age, time.time() - age))


def test_model_published_between_triggers(spark, tmpdir_path):
    """The second trigger uses the version published after the first, in one running query; a reader that holds the
    first version finishes with it."""
    schema = "productId int, simProductId int, score double"
    paths = _paths(tmpdir_path)
    first = _publish(spark, paths, spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9)], schema))
    held = current_keyed(spark, paths.lists, "productId").all()
    src = f"{tmpdir_path}/in"
    _put_lines(src, "a.txt", ["7|1|4.0|10|1"], 100)
    q = rating_stream_query(spark.readStream.text(src), paths, f"{tmpdir_path}/ckpt", trigger={"processingTime": "1 second"})
    try:
        for _ in range(300):
            if os.path.isdir(paths.metrics):
                break
            time.sleep(0.2)
        q.processAllAvailable()
        second = _publish(spark, paths, spark.createDataFrame([(1, 3, 0.8), (3, 1, 0.8)], schema), buckets=4)
        _put_lines(src, "b.txt", ["8|1|4.0|11|2", "broken"], 0)
        q.processAllAvailable()
        assert q.exception() is None and q.isActive
    finally:
        q.stop()
    got = {r["userId"]: [e["productId"] for e in r["recs"]] for r in read_stream_recs(spark, paths.recs).collect()}
    assert got == {7: [2], 8: [3]}
    by_model = spark.read.parquet(paths.metrics).groupBy("model").agg(F.sum("valid").alias("n")).collect()
    assert {r["model"]: r["n"] for r in by_model} == {first: 1, second: 1}
    assert sorted(r["productId"] for r in held.collect()) == [1, 2]


def test_versions_survive_a_crash_and_retire(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"

    def write(n):
        return lambda folder: spark.range(n).write.parquet(folder)

    ids = [publish(spark, table, write(n)) for n in (1, 2, 3)]
    assert spark.read.parquet(current_path(spark, table)).count() == 3

    def dies(folder):
        spark.range(9).write.parquet(folder)
        raise RuntimeError("before the pointer")

    try:
        publish(spark, table, dies)
    except RuntimeError:
        pass
    assert current_version(spark, table) == ids[2] and len(versions(spark, table)) == 4
    assert retire(spark, table, keep=1) == [ids[0]]          # the unfinished version is newer: not touched
    ids.append(publish(spark, table, write(4)))
    assert current_version(spark, table) == ids[3] == versions(spark, table)[-1]
    assert not [n for n in os.listdir(table) if n.endswith(".tmp")]


def test_keyed_reads_open_only_touched_buckets(spark, tmpdir_path):
    from pickwise.sources.keyed import write_keyed
    df = spark.range(1000).selectExpr("cast(id as int) productId", "id * 2 AS v").union(
        spark.createDataFrame([(None, 5)], "productId int, v long"))
    write_keyed(df, f"{tmpdir_path}/k", "productId", buckets=16)
    table = KeyedTable(spark, f"{tmpdir_path}/k", "productId")
    assert table.all().exceptAll(df).count() == df.exceptAll(table.all()).count() == 0
    keys = spark.createDataFrame([(5,), (6,), (5,), (77777,)], "productId int")
    part = table.of_keys(keys)
    assert sorted(r["v"] for r in part.collect()) == [10, 12]
    touched = table.touched(keys)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert len(touched) <= 3 and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scanned = table.part(touched)
    scanned.collect()
    assert scanned.rdd.getNumPartitions() <= 3


def test_every_line_reaches_one_side(spark, tmpdir_path):
    """Random lines over two starts of the query, some arriving between them: valid + rejected = all, once each."""
    import random
    rng = random.Random(5)
    good = [f"{rng.randint(1, 9)}|{rng.randint(1, 5)}|{rng.randint(1, 5)}.0|{i}|{i}" for i in range(200)]
    bad = [rng.choice([f"{i}|1|2.0", f"x{i}|1|2.0|3", f"{i}|1|NaN|3", f"noise {i}", f"{i}|1|2.0|", ""]) for i in range(100)]
    lines = good + bad
    rng.shuffle(lines)
    paths = _paths(tmpdir_path)
    _publish(spark, paths, spark.createDataFrame([(1, 2, 0.9)], "productId int, simProductId int, score double"))
    src = f"{tmpdir_path}/in"
    for start in range(2):
        for part in range(2):
            at = (2 * start + part) * len(lines) // 4
            _put_lines(src, f"{start}{part}.txt", lines[at:(2 * start + part + 1) * len(lines) // 4], 100 - 10 * (2 * start + part))
        q = rating_stream_query(spark.readStream.option("maxFilesPerTrigger", 1).text(src), paths, f"{tmpdir_path}/ckpt",
                                trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None
    rejected = spark.read.parquet(paths.rejects)
    assert sorted(r["value"] for r in rejected.collect()) == sorted(bad)
    assert {"partition", "offset"} <= set(rejected.columns)
    counts = spark.read.parquet(paths.metrics).select(F.sum("rows"), F.sum("valid"), F.sum("rejected")).first()
    assert tuple(counts) == (len(lines), len(good), len(bad))


def test_replayed_batch_counts_once(spark, tmpdir_path):
    """A batch run twice (as after a failure between the sinks and the commit) leaves the same tables."""
    from pickwise.streaming.pipeline import ONLINE_OUT, ModelLists, process_ratings_batch
    paths = _paths(tmpdir_path)
    _publish(spark, paths, spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9)], "productId int, simProductId int, score double"))
    rows = spark.createDataFrame([(7, 2, 1, [1, 1], [4.0, 2.0], [1])], ONLINE_OUT).withColumn("kind", F.lit("user")).unionByName(
        spark.createDataFrame([("reject", "bad", 0, 17)], "kind string, value string, partition int, offset long"),
        allowMissingColumns=True)
    for _ in range(2):
        process_ratings_batch(rows, 3, paths, ModelLists(spark, paths.lists))
    m = spark.read.parquet(paths.metrics).collect()
    assert [(r["rows"], r["valid"], r["rejected"], r["users"], r["batch_id"]) for r in m] == [(3, 2, 1, 1, 3)]
    assert [tuple(r) for r in spark.read.parquet(paths.rejects).select("value", "partition", "offset").collect()] == [("bad", 0, 17)]
    (recs,) = read_stream_recs(spark, paths.recs).collect()
    # avg(0.9 * 4, 0.9 * 2) + log10(1) - log10(1)
    assert [(e["productId"], round(e["score"], 9)) for e in recs["recs"]] == [(2, 2.7)]


def test_recent_queue_state(spark, tmpdir_path):
    """The keyed state holds each user's 40 newest ratings, newest first,
    whatever the arrival order of the files."""
    r2 = fx.ratings_r2(spark, SF_SMALL).select("userId", "productId", "score", "timestamp", "seq")
    src = f"{tmpdir_path}/ratings"
    # newest rows first on disk: arrival order is the reverse of event order
    halves = r2.withColumn("half", (F.col("seq") % 2).cast("int"))
    halves.filter("half = 1").drop("half").write.parquet(f"{src}/a")
    halves.filter("half = 0").drop("half").write.parquet(f"{src}/b")
    out = f"{tmpdir_path}/queue"
    stream = spark.readStream.schema(r2.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")

    def sink(df, bid):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={bid}")

    q = (recent_queue_state(stream).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{tmpdir_path}/qckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    final = (spark.read.parquet(out)
             .withColumn("mx", F.max("batch_id").over(Window.partitionBy("userId")))
             .filter("batch_id = mx").drop("mx", "batch_id"))
    got = sorted(tuple(r) for r in final.select("userId", "position", "productId", "seq").collect())
    w = Window.partitionBy("userId").orderBy(F.col("timestamp").desc(), F.col("seq").desc())
    want_df = r2.withColumn("position", F.row_number().over(w)).filter("position <= 40")
    want = sorted(tuple(r) for r in want_df.select("userId", "position", "productId", "seq").collect())
    assert got == want


def test_compaction_then_new_batches(spark, tmpdir_path):
    root = f"{tmpdir_path}/recs"
    schema = "userId int, recs array<struct<productId:int,score:double>>"

    def write(bid, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/delta/batch_id={bid}")

    assert read_stream_recs(spark, root).count() == 0
    write(0, [(1, [(10, 1.0)]), (2, [(20, 2.0)])])
    write(1, [(1, [(11, 1.5)])])
    assert compact_stream_recs(spark, root) == 2
    write(2, [(2, [])])                                  # an empty list replaces the old one
    got = {r["userId"]: [(e["productId"], e["score"]) for e in r["recs"]]
           for r in read_stream_recs(spark, root).collect()}
    assert got == {1: [(11, 1.5)], 2: []}
    assert compact_stream_recs(spark, root) == 1
    got2 = {r["userId"]: [(e["productId"], e["score"]) for e in r["recs"]]
            for r in read_stream_recs(spark, root).collect()}
    assert got2 == got


def test_queue_without_sequence_numbers(spark, tmpdir_path):
    """Sources without an arrival sequence give every event seq 0: repeated
    and distinct ratings must all stay in the queue (no collapse on seq)."""
    r2 = fx.ratings_r2(spark, SF_SMALL).select("userId", "productId", "score", "timestamp",
                                               F.lit(0).cast("bigint").alias("seq"))
    src = f"{tmpdir_path}/ratings0"
    r2.write.parquet(src)
    out = f"{tmpdir_path}/queue0"
    stream = spark.readStream.schema(r2.schema).parquet(src)
    q = (recent_queue_state(stream).writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(f"{out}/batch_id={bid}"))
         .option("checkpointLocation", f"{tmpdir_path}/q0ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = {r["userId"]: r["n"] for r in spark.read.parquet(out).groupBy("userId")
           .agg(F.count("*").alias("n")).collect()}
    want = {r["userId"]: min(40, r["n"]) for r in r2.groupBy("userId").agg(F.count("*").alias("n")).collect()}
    assert got == want


def _run_lines(spark, tmp, lines, edges_rows, history_rows=None):
    paths = _paths(tmp)
    _publish(spark, paths, spark.createDataFrame(edges_rows, "productId int, simProductId int, score double"))
    os.makedirs(f"{tmp}/in", exist_ok=True)
    with open(f"{tmp}/in/part-0.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    hist = None
    if history_rows is not None:
        hist = f"{tmp}/ratings"
        spark.createDataFrame(history_rows, "userId int, productId int, score double, timestamp bigint, seq bigint") \
            .write.parquet(hist)
    q = rating_stream_query(spark.readStream.text(f"{tmp}/in"), paths, f"{tmp}/ckpt",
                            trigger={"availableNow": True}, history_path=hist)
    q.awaitTermination(300)
    assert q.exception() is None
    return {r["userId"]: [e["productId"] for e in r["recs"]] for r in read_stream_recs(spark, paths.recs).collect()}


def test_history_feeds_the_rated_set(spark, tmpdir_path):
    edges = [(12, 20, 0.9), (12, 21, 0.8), (20, 10, 0.5), (20, 11, 0.6), (21, 12, 0.7)]
    lines = ["1|10|2.0|1|1", "1|11|1.0|2|2", "1|10|2.0|3|3", "1|12|4.0|4|4"]
    without = _run_lines(spark, f"{tmpdir_path}/a", lines, edges)
    assert without == {1: [21, 20]}
    with_hist = _run_lines(spark, f"{tmpdir_path}/b", lines, edges, history_rows=[(1, 21, 3.0, 0, 0)])
    assert with_hist == {1: [20]}


class _FakeState:
    def __init__(self, value=None):
        self.value = value

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_online_update_fold_equals_one_sort():
    """A hot user's rows split into many Arrow batches give the same state and
    output as one batch: ties on (timestamp, seq) included (seq-less source)."""
    import numpy as np
    import pandas as pd

    from pickwise.streaming.pipeline import _online_update
    rng = np.random.default_rng(7)
    n = 5000
    pdf = pd.DataFrame({
        "userId": np.full(n, 1, np.int32),
        "productId": rng.integers(0, 100, n).astype(np.int32),
        "score": rng.integers(1, 6, n).astype(np.float64),
        "timestamp": rng.integers(0, 30, n).astype(np.int64),   # many ties
        "seq": np.zeros(n, np.int64),                           # seq-less source
        "part": rng.integers(0, 2, n).astype(np.int32),
        "live": np.where(rng.random(n) < 0.9, 1, 0).astype(np.int32),
    })
    old = ([5, 6], [4.0, 2.0], [29, 29], [0, 0], [0, 0], [5, 6, 7])
    whole_state, split_state = _FakeState(old), _FakeState(old)
    whole = pd.concat(list(_online_update((1,), iter([pdf]), whole_state)))
    chunks = [pdf.iloc[i:i + 317] for i in range(0, n, 317)]
    split = pd.concat(list(_online_update((1,), iter(chunks), split_state)))
    pd.testing.assert_frame_equal(whole.reset_index(drop=True), split.reset_index(drop=True))
    assert whole_state.value == split_state.value
    assert len(whole_state.value[0]) == 40 and whole["n_events"].sum() == (pdf["live"] == 1).sum()


def test_queue_update_fold_equals_one_sort():
    import numpy as np
    import pandas as pd

    from pickwise.streaming.pipeline import _queue_update
    rng = np.random.default_rng(11)
    n = 3000
    pdf = pd.DataFrame({"userId": np.full(n, 1, np.int32), "productId": rng.integers(0, 50, n).astype(np.int32),
                        "score": rng.integers(1, 6, n).astype(np.float64),
                        "timestamp": rng.integers(0, 10, n).astype(np.int64), "seq": np.zeros(n, np.int64)})
    a, b = _FakeState(([9], [1.0], [9], [0])), _FakeState(([9], [1.0], [9], [0]))
    whole = pd.concat(list(_queue_update((1,), iter([pdf]), a))).reset_index(drop=True)
    split = pd.concat(list(_queue_update((1,), iter([pdf.iloc[i:i + 101] for i in range(0, n, 101)]), b)))
    pd.testing.assert_frame_equal(whole, split.reset_index(drop=True))
    assert a.value == b.value and len(whole) == 40
