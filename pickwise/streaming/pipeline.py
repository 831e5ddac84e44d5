"""Online re-ranking with Structured Streaming.

Rating lines arrive on a stream (Kafka, or a directory of text files). One query reads them, so one
checkpoint holds one set of start offsets, and every line goes to exactly one side:

1. the lines are typed (P1/P2); malformed ones become ``reject`` rows of the same micro-batch;
2. ``applyInPandasWithState`` keyed by user keeps the user's recent-ratings queue (newest 40) and
   rated-product set and gives one row per user with new events: the newest event's product, the 21 newest ratings,
   and the rated set. No history table is read: per-trigger work grows with the batch, not with the history;
3. ``foreachBatch`` resolves the model version in use (a model published between two triggers serves the
   second one), reads of its neighbour lists only the buckets of the products asked for, takes the 20 best unrated
   neighbours inside the row, joins them and the recent ratings with the similarities (SP), and writes the users' new
   lists; an empty list replaces the old one (Q6). Rejects and the batch's counts (A10) are written beside them.

Every write goes to ``<table>/batch_id=<id>`` in overwrite mode, so a batch
replayed after a failure rewrites the same files (idempotent sink); readers
resolve the newest list per user by ``batch_id``. State and offsets live in
the query checkpoint (the shared folder on a cluster).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.operators.priority import candidates_in_row, hits, pairs_of_rows, score_candidates, stream_recs_table
from pickwise.schemas import MAX_SIM_PRODUCTS_NUM, RATING_QUEUE_SIZE, RECENT_ROWS, RECS
from pickwise.sources.keyed import KeyedTable
from pickwise.sources.upsert import DELTA, UpsertLog
from pickwise.sources.versions import VERSIONS, current_version
from pickwise.streaming.parse import typed_lines

HISTORY_COLS = ["userId", "productId", "score", "timestamp", "seq"]


#: Measured bytes of a micro-batch's users up to which their side of the list joins is broadcast.
BROADCAST_BYTES = 64 << 20


@dataclass
class OnlinePaths:
    lists: str          # versioned table (sources.versions) of keyed neighbour lists: productId, recs
    recs: str           # log of lists (sources.upsert), a delta per batch: userId, recs
    rejects: str        # parquet, partitioned by batch_id: value, partition, offset
    metrics: str        # parquet, partitioned by batch_id: query, rows, valid, rejected, users, model, ms


class ModelLists:
    """The neighbour lists of the version in use; a version's files are listed once, when it is first seen."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.version: str | None = None
        self.lists: KeyedTable | None = None

    def resolve(self) -> KeyedTable:
        version = current_version(self.spark, self.table)
        if version != self.version:
            self.lists = KeyedTable(self.spark, f"{self.table}/{VERSIONS}/{version}", "productId")
            self.version = version
        return self.lists


def source_lines(lines: DataFrame) -> DataFrame:
    """value, partition, offset: the two null where the source has no such columns."""
    return lines.select("value", *[(F.col(c) if c in lines.columns else F.lit(None)).cast(t).alias(c)
                                   for c, t in (("partition", "int"), ("offset", "bigint"))])


def parse_stream_lines(lines: DataFrame) -> DataFrame:
    """Typed ratings and rejects of the lines: a fifth field, else the source's offset, is the arrival sequence used
    as the tie-break after timestamp. Offsets count within their partition only; events of one user are in one
    order if the producer keys its records by user. Otherwise equal timestamps and offsets are told apart by
    partition number, which is fixed but says nothing about time."""
    typed = typed_lines(source_lines(lines))
    return typed.withColumn("seq", F.coalesce("fifth", "offset", F.lit(0).cast("bigint"))).withColumn(
        "part", F.coalesce("partition", F.lit(0)))


def _write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")


def stream_recs_log(spark: SparkSession, root: str) -> UpsertLog:
    """T5: the lists as a log of batches; of a user's lists the one of the latest batch counts."""
    return UpsertLog(spark, root, keys=["userId"], latest={"recs": RECS}, order=["batch_id"], bucket_key="userId")


def read_stream_recs(spark: SparkSession, root: str) -> DataFrame:
    """The newest list per user: the compacted lists, and the batches since."""
    return stream_recs_log(spark, root).read().select("userId", "recs")


def compact_stream_recs(spark: SparkSession, root: str) -> int:
    """Fold the batches written since the last compaction into the lists (only the buckets of their users are
    rewritten) and delete what no reader of the last two states needs. Safe next to a running stream. Returns
    how many batches were folded."""
    log = stream_recs_log(spark, root)
    folded = log.compact()
    if folded:
        log.retire(drop_deltas=True)
    return folded


# --- keyed state: recent queue + rated set per user ------------------------------

ONLINE_OUT = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("n_events", T.LongType()),
    T.StructField("productId", T.IntegerType()),                    # of the newest event of this trigger
    T.StructField("recentProducts", T.ArrayType(T.IntegerType())),  # newest first (<= 21), repeats count
    T.StructField("recentScores", T.ArrayType(T.DoubleType())),
    T.StructField("rated", T.ArrayType(T.IntegerType())),           # sorted
])
ONLINE_STATE = T.StructType([
    T.StructField("qProduct", T.ArrayType(T.IntegerType())),   # recent queue, newest first (<= 40)
    T.StructField("qScore", T.ArrayType(T.DoubleType())),
    T.StructField("qTimestamp", T.ArrayType(T.LongType())),
    T.StructField("qSeq", T.ArrayType(T.LongType())),
    T.StructField("qPart", T.ArrayType(T.IntegerType())),
    T.StructField("rated", T.ArrayType(T.IntegerType())),     # every product the user rated, sorted
])
QUEUE_TYPES = (np.int64, np.float64, np.int64, np.int64, np.int64)


def _online_update(key, pdfs, state, recent_k: int = RECENT_ROWS, cap: int = RATING_QUEUE_SIZE):
    """One user's new events -> updated (queue, rated set) and one row: how many events, the newest
    event's product, the 21 newest queued ratings, the rated set.

    Vectorised with NumPy. The user's rows arrive as Arrow batches and are folded in one batch at a time,
    so memory holds one batch plus the <= cap queue and the rated set, however many events a hot user has in the
    trigger. Queue order is (timestamp, seq, partition) newest first, ties by arrival
    position (later first), so the fold equals one sort over all rows. A
    replayed batch starts again from the state version before it (the state
    store commits per batch), so events are not de-duplicated here: a repeated
    rating counts again, as it should."""
    if state.exists:
        st = state.get
        queue = [np.asarray(st[i] or [], dtype=t) for i, t in enumerate(QUEUE_TYPES)]
        rated = np.asarray(st[5] or [], dtype=np.int64)
    else:
        queue = [np.empty(0, t) for t in QUEUE_TYPES]
        rated = np.empty(0, np.int64)
    pos = np.arange(len(queue[0]), dtype=np.int64)      # arrival position: old state first, then events
    base, n_events, newest, product = len(pos), 0, None, None
    for pdf in pdfs:
        live = pdf["live"].to_numpy() == 1
        all_products = pdf["productId"].to_numpy(np.int64)
        rated = np.union1d(rated, all_products)          # live events and stored history alike
        if not live.any():
            continue
        ev = pdf[live]
        n_events += len(ev)
        new = [ev[c].to_numpy(t) for c, t in zip(("productId", "score", "timestamp", "seq", "part"), QUEUE_TYPES)]
        new_pos = base + np.arange(len(ev), dtype=np.int64)
        base += len(ev)
        j = int(np.lexsort((new[4], new[3], new[2]))[-1])    # newest of this Arrow batch, last on ties
        rank = (new[2][j], new[3][j], new[4][j])
        if newest is None or rank >= newest:
            newest, product = rank, int(new[0][j])
        queue = [np.concatenate([a, b]) for a, b in zip(queue, new)]
        pos = np.concatenate([pos, new_pos])
        order = np.lexsort((pos, queue[4], queue[3], queue[2]))[::-1][:cap]          # newest first
        queue, pos = [a[order] for a in queue], pos[order]
    state.update((*[a.tolist() for a in queue], rated.tolist()))
    if newest is None:          # only history rows for this user in this trigger: nothing to score
        return
    yield pd.DataFrame({"userId": np.array([int(key[0])], np.int32), "n_events": np.array([n_events], np.int64),
                        "productId": np.array([product], np.int32),
                        "recentProducts": [queue[0][:recent_k].astype(np.int32)], "recentScores": [queue[1][:recent_k]],
                        "rated": [rated.astype(np.int32)]})


def online_rows(lines: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Streaming rows of each trigger: ``kind`` 'user' (``ONLINE_OUT``) for the users with new events, and
    'reject' (value, partition, offset) for malformed lines. ``history`` (a stream over the
    stored ratings table) feeds each user's rated set, so candidates exclude
    products rated before the stream started, and those appended later."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    typed = parse_stream_lines(lines)
    rows = typed.where("valid").select(*HISTORY_COLS, "part", F.lit(1).alias("live"))
    if history is not None:
        past = history.select(F.col("userId").cast("int"), F.col("productId").cast("int"),
                              F.col("score").cast("double"), F.col("timestamp").cast("bigint"),
                              F.col("seq").cast("bigint"), F.lit(0).alias("part"), F.lit(0).alias("live"))
        rows = rows.unionByName(past)
    users = (rows.groupBy("userId")
             .applyInPandasWithState(_online_update, ONLINE_OUT, ONLINE_STATE, "update", GroupStateTimeout.NoTimeout)
             .withColumn("kind", F.lit("user")))
    rejects = typed.where("not valid").select(F.lit("reject").alias("kind"), "value", "partition", "offset")
    return users.unionByName(rejects, allowMissingColumns=True)


def process_ratings_batch(rows: DataFrame, batch_id: int, paths: OnlinePaths, model: ModelLists,
                          query: str = "online") -> None:
    """Score one micro-batch and write its users' lists, rejects and counts to
    ``<table>/batch_id=<id>`` (overwrite: a replayed batch rewrites the same files, and counts once).
    The model version is resolved here, once for the batch (T4)."""
    started = time.time()
    spark = rows.sparkSession
    rows, top = rows.persist(StorageLevel.MEMORY_AND_DISK), None
    try:
        # one full pass materialises every state partition once (a partial
        # action such as isEmpty would run the stateful stage twice)
        user = F.col("kind") == "user"
        size = F.sum(F.when(user, 4 * F.size("rated") + 12 * F.size("recentProducts") + 64))
        n_users, valid, rejected, bytes_ = rows.agg(
            F.count_if(user), F.coalesce(F.sum("n_events"), F.lit(0)), F.count_if(~user), F.coalesce(size, F.lit(0))).first()
        if not n_users + rejected:
            return
        if rejected:
            _write_batch(rows.where(~user).select("value", "partition", "offset"), paths.rejects, batch_id)
        if n_users:
            # the batch's side of both list joins is measured; a user has at most 20 x 21 pairs of some 48 bytes
            small = bytes_ + n_users * MAX_SIM_PRODUCTS_NUM * RECENT_ROWS * 48 <= BROADCAST_BYTES
            users, lists = rows.where(user), model.resolve()
            asked = users.select("userId", "productId", "recentProducts", "recentScores", "rated")
            top = candidates_in_row(F.broadcast(asked) if small else asked,
                                    lists.part(lists.touched(users))).persist(StorageLevel.MEMORY_AND_DISK)
            asked = top.select(F.explode("candidates.productId").alias("productId")).distinct()
            similar = lists.of_keys(asked).select("productId", F.explode("recs").alias("r")).select(
                "productId", F.col("r.productId").alias("simProductId"), F.col("r.score").alias("score"))
            pairs = pairs_of_rows(top)
            prio = score_candidates(hits(F.broadcast(pairs) if small else pairs, similar))
            _write_batch(stream_recs_table(prio, users), f"{paths.recs}/{DELTA}", batch_id)
        counts = [(query, valid + rejected, valid, rejected, n_users, model.version, int(1000 * (time.time() - started)))]
        _write_batch(spark.createDataFrame(counts, METRICS_SCHEMA).coalesce(1), paths.metrics, batch_id)
    finally:
        if top is not None:
            top.unpersist()
        rows.unpersist()


METRICS_SCHEMA = "query string, rows long, valid long, rejected long, users long, model string, ms long"
RATING_LOG_SCHEMA = "userId int, productId int, score double, timestamp bigint, seq bigint"


def rating_stream_query(lines: DataFrame, paths: OnlinePaths, checkpoint: str,
                        trigger: dict | None = None, query_name: str | None = None,
                        history_path: str | None = None):
    """One checkpointed query over the rating lines: typing, keyed state, and a foreachBatch that writes lists,
    rejects and counts. With ``history_path`` (the stored
    ratings table) every user's rated set also covers past ratings. Default trigger: 2 seconds;
    tests pass ``{"availableNow": True}``."""
    spark = lines.sparkSession
    history = spark.readStream.schema(RATING_LOG_SCHEMA).parquet(history_path) if history_path else None
    model = ModelLists(spark, paths.lists)
    name = query_name or "online"
    main = (online_rows(lines, history).writeStream.outputMode("update")
            .foreachBatch(lambda df, bid: process_ratings_batch(df, bid, paths, model, name))
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/main")
            .trigger(**(trigger or {"processingTime": "2 seconds"})))
    if query_name:
        main = main.queryName(query_name)
    return main.start()


# --- T3: per-user bounded recent-ratings queue as keyed state ---------------------

QUEUE_OUT = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("seq", T.LongType()),
])
QUEUE_STATE = T.StructType([
    T.StructField("qProduct", T.ArrayType(T.IntegerType())),
    T.StructField("qScore", T.ArrayType(T.DoubleType())),
    T.StructField("qTimestamp", T.ArrayType(T.LongType())),
    T.StructField("qSeq", T.ArrayType(T.LongType())),
])


def _queue_update(key, pdfs, state, cap: int = RATING_QUEUE_SIZE):
    """Merge the new ratings of one user into the state queue: newest first,
    at most ``cap`` entries; the oldest fall off. Rows are ordered by
    (timestamp, seq), not arrival, so a stale event lands in its place; ties
    by arrival position, later first. Arrow batches are folded in one at a
    time, so memory stays one batch plus the queue, however hot the user."""
    dtypes = (np.int64, np.float64, np.int64, np.int64)
    qp, qs, qt, qn = ([np.asarray(state.get[i] or [], dtype=t) for i, t in enumerate(dtypes)] if state.exists
                      else [np.empty(0, t) for t in dtypes])
    qpos = np.arange(len(qp), dtype=np.int64)
    base = len(qp)
    cols = ("productId", "score", "timestamp", "seq")
    for ev in pdfs:
        if len(ev) == 0:
            continue
        new = [ev[c].to_numpy(t) for c, t in zip(cols, dtypes)]
        pos = base + np.arange(len(ev), dtype=np.int64)
        base += len(ev)
        qp, qs, qt, qn, qpos = (np.concatenate([a, b]) for a, b in zip((qp, qs, qt, qn, qpos), (*new, pos)))
        order = np.lexsort((qpos, qn, qt))[::-1][:cap]
        qp, qs, qt, qn, qpos = qp[order], qs[order], qt[order], qn[order], qpos[order]
    state.update((qp.tolist(), qs.tolist(), qt.tolist(), qn.tolist()))
    yield pd.DataFrame({
        "userId": np.full(len(qp), int(key[0]), dtype=np.int32),
        "position": np.arange(1, len(qp) + 1, dtype=np.int32),
        "productId": qp.astype(np.int32), "score": qs, "timestamp": qt, "seq": qn,
    })


def recent_queue_state(ratings: DataFrame, cap: int = RATING_QUEUE_SIZE) -> DataFrame:
    """Streaming (userId, position, productId, score, timestamp, seq) — the
    full current queue of every user updated in a trigger (output mode update).
    State per user is bounded by ``cap`` entries."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    def fn(key, pdfs, state):
        return _queue_update(key, pdfs, state, cap)

    return (ratings.select(*HISTORY_COLS)
            .groupBy("userId")
            .applyInPandasWithState(fn, QUEUE_OUT, QUEUE_STATE, "update", GroupStateTimeout.NoTimeout))
