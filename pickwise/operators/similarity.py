"""Item-item similarity: dense cosine (C1), co-occurrence item-CF (M9) and
TF-IDF content features (M7, M8).

All-pairs work is done as a *blocked matrix product*, never as a cross join
and never by emitting every pair inside a user/term group:

* items are hashed into ``nb`` blocks; each row is replicated to the
  ``nb`` block-pair keys ``(min(b, j), max(b, j))`` it takes part in;
* one ``applyInPandas`` call per block pair computes that block of the
  product in NumPy and emits only the pairs that pass the threshold: dense
  vectors with BLAS in column slices (C1, M8); user x item 0/1 rows with a
  heavy/light kernel (M9) - dense BLAS slices for users with many items in
  the two blocks, a bounded expansion of their own pairs for the rest.

A group therefore holds at most two item blocks (times one user chunk for
item-CF), whatever the skew of users, items or terms: a user holding a third
of all ratings is one row of a user-chunk matrix, a hot item is one column.
Block sizes come from measured counts, so memory per task is bounded.

Whole ranked lists (``cosine_ranked``) shuffle no edges: the vectors are packed
into blocks once, and a task for some of a block's rows meets every block by
its number and ranks its rows' lists itself.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.joins import BROADCAST_MAX_ROWS, bounded_broadcast
from pickwise.operators.ranking import top_k_per_key
from pickwise.schemas import HASHING_TF_FEATURES, SIM_DIGITS, SIM_THRESHOLD
from pickwise.session import materialize

RANKED_SCHEMA = "productId int, simProductId int, score double, rank int"
EDGE_SCHEMA = "productId int, simProductId int, score double"
COUNT_SCHEMA = "productId int, simProductId int, cnt long"

DEFAULT_VECTOR_BLOCK = 2048       # rows per dense-vector block: B x B float64 scores = 32 MiB
DEFAULT_ITEM_BLOCK = 1024         # smallest item-CF block


def _n_blocks(n: int, block: int) -> int:
    return max(1, int(math.ceil(n / float(block))))


def _replicate_to_block_pairs(df: DataFrame, block: str, nb: int) -> DataFrame:
    """Each row of block b goes to every block pair (min(b, j), max(b, j))."""
    if nb == 1:
        return df.withColumn("lo", F.lit(0)).withColumn("hi", F.lit(0))
    j = F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))
    return (df.withColumn("_j", j)
            .withColumn("lo", F.least(F.col(block), F.col("_j")))
            .withColumn("hi", F.greatest(F.col(block), F.col("_j")))
            .drop("_j"))


def _round_sim(s: np.ndarray) -> np.ndarray:
    return np.round(s, SIM_DIGITS)


def _emit_pairs(ids_l, ids_r, s: np.ndarray, diagonal: bool, threshold: float | None,
                value_name: str = "score", one_way: bool = False) -> pd.DataFrame:
    """Rows (a, b, value) for cells passing ``value > threshold`` (NaN never passes);
    off-diagonal blocks are emitted in both directions, the diagonal block once
    per ordered pair with a != b (``one_way``: the caller already covers both
    directions)."""
    mask = np.isfinite(s)
    if threshold is not None:
        mask &= s > threshold
    if diagonal:
        np.fill_diagonal(mask, False)
    i, j = np.nonzero(mask)
    a, b, v = ids_l[i], ids_r[j], s[i, j]
    if not diagonal and not one_way:
        a, b, v = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([v, v])
    return pd.DataFrame({"productId": a.astype(np.int32), "simProductId": b.astype(np.int32),
                         value_name: v})


MAX_VECTOR_BLOCK = 8192           # rows per block at most; scores are computed in column slices
SCORE_SLICE_COLS = 2048           # B x 2048 float64 scores per slice (<= 128 MiB)


def vector_block_size(n: int, block_size: int | None = None) -> int:
    """Rows per block: at least DEFAULT_VECTOR_BLOCK, growing with n so a row is
    replicated to at most ~64 block pairs, capped by MAX_VECTOR_BLOCK."""
    if block_size is not None:
        return block_size
    return min(MAX_VECTOR_BLOCK, max(DEFAULT_VECTOR_BLOCK, int(math.ceil(n / 64.0))))


def _cosine_block(ids_l, xl, ids_r, xr, diagonal: bool, threshold: float | None,
                  slice_cols: int = SCORE_SLICE_COLS) -> pd.DataFrame:
    """Edges between two dense blocks, scores computed in column slices.
    A diagonal block (both sides the same rows) masks a == b and emits every
    ordered pair once; an off-diagonal block emits both directions."""
    out = [pd.DataFrame({"productId": np.array([], np.int32), "simProductId": np.array([], np.int32),
                         "score": np.array([], np.float64)})]
    with np.errstate(divide="ignore", invalid="ignore"):
        nl = np.linalg.norm(xl, axis=1)
        nr = np.linalg.norm(xr, axis=1)
        for c0 in range(0, len(ids_r), slice_cols):
            c1 = min(len(ids_r), c0 + slice_cols)
            s = _round_sim((xl @ xr[c0:c1].T) / np.outer(nl, nr[c0:c1]))
            if diagonal:
                s = np.where(ids_l[:, None] == ids_r[None, c0:c1], np.nan, s)
            out.append(_emit_pairs(ids_l, ids_r[c0:c1], s, False, threshold, one_way=diagonal))
    return pd.concat(out, ignore_index=True)


def cosine_all_pairs(vectors: DataFrame, threshold: float = SIM_THRESHOLD,
                     block_size: int | None = None, n_items: int | None = None) -> DataFrame:
    """(productId, features ARRAY<num>) -> edges (productId, simProductId, score)
    for all ordered pairs a != b with round(cos, 10) > threshold.
    Zero vectors give NaN and are dropped (Q13)."""
    v = vectors.select(F.col("productId").cast("int").alias("productId"),
                       F.col("features").cast("array<double>").alias("features"))
    n = n_items if n_items is not None else v.count()
    nb = _n_blocks(n, vector_block_size(n, block_size))
    v = v.withColumn("blk", F.pmod(F.xxhash64("productId"), F.lit(nb)).cast("int"))
    rep = _replicate_to_block_pairs(v, "blk", nb)

    def block_cosine(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        left = pdf[pdf["blk"] == lo]
        right = left if lo == hi else pdf[pdf["blk"] == hi]
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"productId": [], "simProductId": [], "score": []})
        xl = np.stack(left["features"].to_numpy()).astype(np.float64)
        xr = xl if lo == hi else np.stack(right["features"].to_numpy()).astype(np.float64)
        return _cosine_block(left["productId"].to_numpy(), xl, right["productId"].to_numpy(), xr,
                             lo == hi, threshold)

    return rep.groupBy("lo", "hi").applyInPandas(block_cosine, schema=EDGE_SCHEMA)


RANKED_CELLS = 8_000_000          # own rows x all rows: the float64 scores that one task holds (64 MB)
MIN_RANKED_ROWS = 256             # own rows that are worth a task
RANKED_BROADCAST = 128 << 20      # bytes of packed blocks that are broadcast
RANKED_OUT_ROWS = 65_536          # rows of an output batch, if no list is longer
NULL_ID = -2**31                  # what a null id comes out as, here and in cosine_all_pairs
_UNIT = 10**SIM_DIGITS
_PLACE_BITS = 28                  # a sort key is 35 bits of 1 - score and 28 of the id's place


def ranked_rows(n: int, parallelism: int) -> int:
    """Own rows of a task over ``n`` vectors: two tasks a core when there are enough rows, at most RANKED_CELLS scores."""
    return max(1, min(RANKED_CELLS // max(1, n), max(MIN_RANKED_ROWS, math.ceil(n / (2 * parallelism)))))


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block as one row, in the order of its ids; by columns the vectors repeat themselves, so they compress well."""
    pdf = pdf.sort_values("productId", kind="stable")
    x = np.stack(pdf["features"].to_numpy()).astype(np.float64)
    return pd.DataFrame({"blk": pdf["blk"].iloc[:1].to_numpy(), "n": [len(pdf)], "ids": [pdf["productId"].to_numpy().astype(np.int32).tobytes()],
                         "x": [pa.compress(np.ascontiguousarray(x.T).tobytes(), codec="zstd", asbytes=True)], "bytes": [x.nbytes]})


def _unpack_block(ids, x, n_bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids.as_buffer(), np.int32)
    x = pa.decompress(x.as_buffer(), decompressed_size=n_bytes.as_py(), codec="zstd")
    return ids, np.frombuffer(x, np.float64).reshape(-1, len(ids)).T


def _own_scores(cols, part: int, rows: int, n: int):
    """(own ids, all ids, scores in units of the last digit) of a task's rows, None without rows; ``cols``: its block,
    then all others. The rows of an id are in one part."""
    own = ids = s = None
    at = 0
    for k, *packed in cols:
        if own is None and k.as_py():    # no id is in its block
            if not all(c[0].as_py() for c in cols):
                raise RuntimeError("a task's own block has to come first")
            break
        to, y = _unpack_block(*packed)
        if own is None:
            _, first, inverse = np.unique(to, return_index=True, return_inverse=True)
            mine = first[inverse] // rows == part
            if not mine.any():
                break
            own, x = to[mine], np.ascontiguousarray(y[mine])
            nx = np.linalg.norm(x, axis=1)
            ids, s = np.empty(n, np.int32), np.empty((len(own), n))
        c = slice(at, at + len(to))
        ids[c], s[:, c] = to, x @ y.T
        with np.errstate(divide="ignore", invalid="ignore"):
            s[:, c] /= np.outer(nx, np.linalg.norm(y, axis=1))
        at += len(to)
    if own is None:
        return None
    if at != n:
        raise RuntimeError(f"{at} of {n} vectors met a task")
    s *= _UNIT
    return own, ids, np.rint(s, out=s)


def _half_up(units: np.ndarray, digits: int) -> np.ndarray:
    """Whole units of the last of SIM_DIGITS digits as doubles of ``digits`` digits, rounded as F.round does."""
    step = 10**(SIM_DIGITS - digits)
    return np.sign(units) * ((np.abs(units) + step // 2) // step) / 10**digits


def _ranked_lists(own: np.ndarray, ids: np.ndarray, s: np.ndarray, threshold: float, digits: int):
    """(id, its neighbours, their scores) by falling score, then id; equal ids aren't neighbours. An id's rows follow each other."""
    names, place = np.unique(ids, return_inverse=True)
    for lo, hi in itertools.pairwise([*np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), len(own)]):
        other = (ids != own[lo]) | (own[lo] == NULL_ID)
        keys = []
        for r in s[lo:hi]:
            j = np.flatnonzero(other & np.isfinite(r) & (r / _UNIT > threshold))
            keys.append((_UNIT - r[j].astype(np.int64) << _PLACE_BITS) | place[j])
        key = np.sort(keys[0] if hi == lo + 1 else np.concatenate(keys))
        yield own[lo], names[key & (1 << _PLACE_BITS) - 1], _half_up(_UNIT - (key >> _PLACE_BITS), digits)


def _ranked_batches(lists):
    """Whole lists as record batches of RANKED_SCHEMA."""
    held, rows = [], 0
    for a, to, score in itertools.chain(lists, [(0, None, None)]):
        if to is not None and len(to):
            held.append((np.full(len(to), a, np.int32), to, score, np.arange(1, len(to) + 1, dtype=np.int32)))
            rows += len(to)
        if held and (to is None or rows >= RANKED_OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["productId", "simProductId", "score", "rank"])
            held, rows = [], 0


def cosine_ranked(vectors: DataFrame, threshold: float = SIM_THRESHOLD, block_size: int | None = None,
                  max_broadcast: int = RANKED_BROADCAST, digits: int = SIM_DIGITS) -> DataFrame:
    """C1 and W3 at once: the edges of ``cosine_all_pairs`` with their rank by score (falling) and id within each
    productId. All scores of a task's rows are in its memory, so it ranks whole lists: no edge is shuffled or sorted on disk.

    The blocks, packed into the shared checkpoint folder, are broadcast and meet the tasks by their number. Blocks of more
    than ``max_broadcast`` bytes, or an id that comes so often that its list has no place in memory, leave the ranking
    to a window over the edges. The scores are rounded to ``digits`` digits after the ranking."""
    spark = vectors.sparkSession
    v = vectors.select(F.col("productId").cast("int").alias("productId"), F.col("features").cast("array<double>").alias("features"))
    size = v.groupBy("productId").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    n, most = size["n"] or 0, size["most"] or 0
    if n == 0:
        return spark.createDataFrame([], RANKED_SCHEMA)

    def by_window():
        edges = cosine_all_pairs(v, threshold, block_size, n)
        return top_k_per_key(edges, "productId", None, item="simProductId").withColumn("score", F.round("score", digits))

    if n * most > 4 * RANKED_CELLS:
        return by_window()
    nb = _n_blocks(n, block_size or DEFAULT_VECTOR_BLOCK)
    known = v.withColumn("productId", F.coalesce("productId", F.lit(NULL_ID)))
    blocks = materialize(known.withColumn("blk", F.pmod(F.xxhash64("productId"), F.lit(nb)).cast("int")).groupBy("blk")
                         .applyInPandas(_pack_block, schema="blk int, n int, ids binary, x binary, bytes long"))
    packed = blocks.agg(F.max("n").alias("n"), F.sum(F.octet_length("x") + F.octet_length("ids")).alias("bytes")).first()
    if packed["bytes"] > max_broadcast:
        return by_window()
    rows = ranked_rows(n, spark.sparkContext.defaultParallelism)
    parts = _n_blocks(packed["n"], rows)
    # task t: part t % parts of block t // parts; it meets that block first
    meets = spark.range(0, nb * parts, 1, nb * parts).select(F.col("id").alias("task"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("k"))
    meets = meets.withColumn("blk", F.pmod(F.floor(F.col("task") / F.lit(parts)) + F.col("k"), F.lit(nb)).cast("int"))

    def rank(batches):
        met_rows = (r for b in batches for r in zip(*(b.column(c) for c in ("task", "k", "ids", "x", "bytes"))))
        for task, cols in itertools.groupby(met_rows, lambda r: r[0].as_py()):
            scores = _own_scores((c[1:] for c in cols), task % parts, rows, n)
            if scores is not None:
                yield from _ranked_batches(_ranked_lists(*scores, threshold, digits))

    return meets.join(F.broadcast(blocks), "blk").select("task", "k", "ids", "x", "bytes").mapInArrow(rank, schema=RANKED_SCHEMA)


DENSE_FACTOR = 100               # a user goes the dense way when |h∩I|·|h∩J|·DENSE_FACTOR > |I|·|J|
SLICE_CELLS = 16_000_000          # bound on dense slice cells / sparse pairs handled at once
MAX_ITEM_BLOCK = 4096             # |I| x |J| count accumulator <= 16M cells
TARGET_GROUP_ROWS = 4_000_000     # (user, item) rows per (chunk, block pair) group


def _block_counts(ul, il, ur, ir, n_users: int, n_i: int, n_j: int,
                  dense_factor: float | None = None) -> np.ndarray:
    """C[i, j] = #users holding item i (left block) and item j (right block).

    Heavy users (many items in both blocks) are summed as dense 0/1 slices
    with BLAS; light users by expanding only their own (i, j) pairs in
    bounded slices and counting them with ``bincount``. Either way memory is
    bounded by the block sizes, never by one user's history."""
    factor = DENSE_FACTOR if dense_factor is None else dense_factor
    c = np.zeros((n_i, n_j), dtype=np.int64)
    al = np.bincount(ul, minlength=n_users).astype(np.int64)
    ar = np.bincount(ur, minlength=n_users).astype(np.int64)
    heavy = (al * ar) * factor > n_i * n_j
    # dense part, over slices of heavy users
    hu = np.nonzero(heavy)[0]
    if len(hu):
        pos = np.full(n_users, -1, dtype=np.int64)
        pos[hu] = np.arange(len(hu))
        step = max(1, SLICE_CELLS // max(1, n_i + n_j))
        pl, pr = pos[ul], pos[ur]
        for s0 in range(0, len(hu), step):
            s1 = min(len(hu), s0 + step)
            a_l = np.zeros((s1 - s0, n_i), dtype=np.float32)
            a_r = np.zeros((s1 - s0, n_j), dtype=np.float32)
            ml = (pl >= s0) & (pl < s1)
            mr = (pr >= s0) & (pr < s1)
            a_l[pl[ml] - s0, il[ml]] = 1.0
            a_r[pr[mr] - s0, ir[mr]] = 1.0
            c += np.rint(a_l.T @ a_r).astype(np.int64)      # exact: counts < 2^24 per slice
    # sparse part: light users expand their own pairs
    lm, rm = ~heavy[ul], ~heavy[ur]
    ul2, il2, ur2, ir2 = ul[lm], il[lm], ur[rm], ir[rm]
    if len(ul2) and len(ur2):
        order = np.argsort(ur2, kind="stable")
        ir_sorted = ir2[order]
        cnt_r = np.bincount(ur2, minlength=n_users).astype(np.int64)
        start_r = np.concatenate([[0], np.cumsum(cnt_r)[:-1]])
        rep_all = cnt_r[ul2]
        bounds = np.concatenate([[0], np.cumsum(rep_all)])
        s0 = 0
        while s0 < len(ul2):
            s1 = int(np.searchsorted(bounds, bounds[s0] + SLICE_CELLS, side="right")) - 1
            s1 = max(s1, s0 + 1)
            rep = rep_all[s0:s1]
            total = int(rep.sum())
            if total:
                li = np.repeat(il2[s0:s1], rep)
                first = np.repeat(start_r[ul2[s0:s1]], rep)
                within = np.arange(total) - np.repeat(np.cumsum(rep) - rep, rep)
                rj = ir_sorted[first + within]
                c += np.bincount(li * n_j + rj, minlength=n_i * n_j).reshape(n_i, n_j)
            s0 = s1
    return c


MIN_ROWS_PER_GROUP = 250_000       # below this a group is not worth its task


def cooc_layout(n_users: int, n_items: int, nnz: int, item_block: int | None = None,
                user_chunk: int | None = None, parallelism: int = 1) -> tuple[int, int]:
    """(item blocks, user chunks). Blocks are as large as the count accumulator
    allows, so each row is replicated to few block pairs; user chunks are sized
    so a (chunk, block pair) group holds about TARGET_GROUP_ROWS rows, and -
    when there is enough data - so there are at least ``parallelism`` groups."""
    if item_block is None:
        item_block = min(MAX_ITEM_BLOCK, max(DEFAULT_ITEM_BLOCK, int(math.ceil(n_items / 32.0))))
    nb = _n_blocks(n_items, item_block)
    if user_chunk is None:
        pairs = nb * (nb + 1) // 2
        rows_per_block_pair = 2.0 * nnz / nb if nb > 1 else float(nnz)
        nc = max(1, int(math.ceil(rows_per_block_pair / TARGET_GROUP_ROWS)))
        if pairs * nc < parallelism:
            nc = max(nc, min(int(math.ceil(parallelism / pairs)),
                             int(rows_per_block_pair // MIN_ROWS_PER_GROUP)))
        nc = max(1, min(nc, max(1, n_users)))
    else:
        nc = _n_blocks(n_users, user_chunk)
    return nb, nc


def route(user_items: DataFrame, nb: int, chunks: int, target_rows: int = TARGET_GROUP_ROWS) -> DataFrame:
    """The groups' rows: userId, productId, blk, lo, hi, chunk. A user's rows go only to the pairs (lo, hi) of item
    blocks in which that user has items, so copies follow the user's own history, not the catalogue. The users
    of a pair are dealt to at least ``chunks`` groups, and to so many that none has more than about ``target_rows`` rows by
    the blocks' measured sizes: a block with a hot item is cut finer than the others."""
    ui = user_items.select("userId", "productId").withColumn("blk", F.pmod(F.xxhash64("productId"), F.lit(nb)).cast("int"))
    sizes = F.broadcast(user_items.sparkSession.createDataFrame(
        ui.groupBy("blk").agg(F.count("*").alias("n")).collect(), "b int, n long"))      # nb rows
    own = ui.groupBy("userId").agg(F.collect_set("blk").alias("own"))                    # nb numbers at most
    pairs = ui.join(own, "userId").select("userId", "productId", "blk", F.explode("own").alias("other")).select(
        "userId", "productId", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))
    rows = F.col("n_lo") + F.when(F.col("lo") == F.col("hi"), 0).otherwise(F.col("n_hi"))
    groups = F.greatest(F.lit(chunks), F.ceil(rows / F.lit(target_rows)))
    return (pairs.join(sizes.select(F.col("b").alias("lo"), F.col("n").alias("n_lo")), "lo")
            .join(sizes.select(F.col("b").alias("hi"), F.col("n").alias("n_hi")), "hi")
            .select("userId", "productId", "blk", "lo", "hi", F.pmod(F.xxhash64("userId"), groups).cast("int").alias("chunk")))


def cooccurrence_counts(user_items: DataFrame, n_users: int, n_items: int, nnz: int | None = None,
                        item_block: int | None = None, user_chunk: int | None = None,
                        dense_factor: float = DENSE_FACTOR, target_rows: int = TARGET_GROUP_ROWS) -> DataFrame:
    """|U_p ∩ U_q| for all ordered pairs p != q with a common user, from distinct
    (userId, productId) rows: the blocked product A^T A of the user x item 0/1
    matrix. Each (user chunk, item block pair) group computes its partial
    counts in memory (``_block_counts``); partials of the chunks are summed by
    a combining aggregate."""
    nb, nc = cooc_layout(n_users, n_items, nnz if nnz is not None else n_users * 8, item_block, user_chunk,
                         user_items.sparkSession.sparkContext.defaultParallelism)
    rep = route(user_items, nb, nc, target_rows)

    def block_cooc(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        users, uidx = np.unique(pdf["userId"].to_numpy(), return_inverse=True)
        blk = pdf["blk"].to_numpy()
        prod = pdf["productId"].to_numpy()
        left = blk == lo
        items_l, il = np.unique(prod[left], return_inverse=True)
        if lo == hi:
            items_r, ir, right = items_l, il, left
        else:
            right = blk == hi
            items_r, ir = np.unique(prod[right], return_inverse=True)
        if len(items_l) == 0 or len(items_r) == 0:
            return pd.DataFrame({"productId": [], "simProductId": [], "cnt": []})
        c = _block_counts(uidx[left], il, uidx[right], ir, len(users), len(items_l), len(items_r),
                          dense_factor)
        return _emit_pairs(items_l, items_r, c, lo == hi, 0, value_name="cnt")

    counts = rep.groupBy("chunk", "lo", "hi").applyInPandas(block_cooc, schema=COUNT_SCHEMA)
    return counts.groupBy("productId", "simProductId").agg(F.sum("cnt").alias("cnt"))


def item_cf(ratings: DataFrame, threshold: float = SIM_THRESHOLD,
            item_block: int | None = None, user_chunk: int | None = None,
            dense_factor: float = DENSE_FACTOR) -> tuple[DataFrame, int]:
    """M9: cosine co-occurrence |Ui ∩ Uj| / sqrt(|Ui| |Uj|) over distinct
    (user, product) pairs, rounded to 10 digits, kept when > threshold.
    No cap on partners: every qualifying pair is returned.

    Returns the edges and a proven bound on their row count, n_items * (n_items - 1),
    from one exact sizing job (no count of the edges themselves)."""
    ui = ratings.select("userId", "productId").distinct().persist()
    sizes = ui.agg(F.countDistinct("userId").alias("u"), F.countDistinct("productId").alias("p"),
                   F.count("*").alias("nnz")).first()
    n_users, n_items, nnz = int(sizes["u"]), int(sizes["p"]), int(sizes["nnz"])
    deg = ui.groupBy("productId").agg(F.count("*").alias("deg"))
    counts = cooccurrence_counts(ui, n_users, n_items, nnz, item_block, user_chunk, dense_factor)
    d = bounded_broadcast(deg, n_items)
    sim = (counts
           .join(d.select("productId", F.col("deg").alias("deg_p")), "productId")
           .join(d.select(F.col("productId").alias("simProductId"), F.col("deg").alias("deg_q")),
                 "simProductId")
           .select("productId", "simProductId",
                   F.round(F.col("cnt") / F.sqrt(F.col("deg_p").cast("double") * F.col("deg_q")),
                           SIM_DIGITS).alias("score")))
    return sim.filter(F.col("score") > F.lit(threshold)), n_items * max(n_items - 1, 0)


def item_cf_edges(ratings: DataFrame, threshold: float = SIM_THRESHOLD,
                  item_block: int | None = None, user_chunk: int | None = None,
                  dense_factor: float = DENSE_FACTOR) -> DataFrame:
    """M9 edges only (see ``item_cf``)."""
    return item_cf(ratings, threshold, item_block, user_chunk, dense_factor)[0]


# --- content features --------------------------------------------------------

def tokenize(text_col: str = "text"):
    """Lower-cased whitespace tokens of the whole text (no prefixes, no caps)."""
    return F.filter(F.split(F.lower(F.col(text_col)), r"\s+"), lambda t: t != F.lit(""))


TEXT_PARTITION_BYTES = 8_000_000  # texts whose term counts one task holds in memory


def text_partitions(n_bytes: int, parallelism: int) -> int:
    """Partitions of ``n_bytes`` of text: none much over TEXT_PARTITION_BYTES, so counting doesn't spill; one a core from a megabyte each."""
    return max(1, math.ceil(n_bytes / TEXT_PARTITION_BYTES), min(parallelism, math.ceil(n_bytes / 1_000_000)))


def content_features(docs: DataFrame, n_docs: int | None = None, vocab_bound: int | None = None,
                     max_broadcast: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """M7 (exact variant): productId, term, tf, idf, weight with
    idf = ln((N + 1) / (df + 1)), MLlib's IDF formula, weight = tf * idf.

    Texts are shuffled, by productId, and counted there; their far larger term rows are not. The idf of the terms of
    most texts, as many as may be broadcast, meets the rows in place; only rows of the rarer terms are shuffled to theirs."""
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    n = n_docs if n_docs is not None else size["n"]
    parts = text_partitions(size["bytes"], docs.sparkSession.sparkContext.defaultParallelism)
    # explode first, then drop empty tokens with a plain (code-generated) filter
    terms = (docs.select("productId", "text").repartition(parts, "productId")
             .select("productId", F.explode(F.split(F.lower(F.col("text")), r"\s+")).alias("term"))
             .filter(F.col("term") != F.lit("")))
    tf = terms.groupBy("productId", "term").agg(F.count("*").alias("tf"))
    idf = (tf.groupBy("term").agg(F.count("*").alias("df"))
           .select("term", "df", F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)).alias("idf")))
    cut = 0
    if vocab_bound is None or vocab_bound > max_broadcast:
        idf = idf.persist()
        cut = _broadcast_cut(idf, max_broadcast)
    out = ["productId", "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("weight")]
    common = F.broadcast(idf.where(F.col("df") >= cut).drop("df"))
    if not cut:
        return tf.join(common, "term").select(*out)
    met = tf.join(common, "term", "left")
    rest = met.where(F.col("idf").isNull()).drop("idf").join(idf.where(F.col("df") < cut).drop("df"), "term")
    return met.where(F.col("idf").isNotNull()).select(*out).unionByName(rest.select(*out))


def _broadcast_cut(idf: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` terms are in so many texts; 0 when all terms are."""
    sizes = idf.groupBy((F.length(F.bin("df")) - 1).alias("p")).agg(F.count("*").alias("n")).collect()   # <= 63 rows
    total = 0
    for p, k in sorted(((r["p"], r["n"]) for r in sizes), reverse=True):
        total += k
        if total > most:
            return 2 ** (p + 1)
    return 0


def hashed_tfidf_vectors(docs: DataFrame, num_features: int = HASHING_TF_FEATURES) -> DataFrame:
    """M7 (hashed): HashingTF(200) -> IDF, as dense ARRAY<DOUBLE> per product."""
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array

    words = docs.select("productId", tokenize("text").alias("words"))
    # the hashed term counts (<= num_features entries per text) are cached, so the
    # whole texts are tokenised once for both the IDF fit and the transform
    tf = (HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=num_features).transform(words)
          .select("productId", "rawFeatures").persist())
    model = IDF(inputCol="rawFeatures", outputCol="tfidf").fit(tf)
    return model.transform(tf).select("productId", vector_to_array("tfidf").alias("features"))


def content_based_edges(docs: DataFrame, threshold: float = SIM_THRESHOLD,
                        num_features: int = HASHING_TF_FEATURES,
                        block_size: int = DEFAULT_VECTOR_BLOCK) -> DataFrame:
    """M8: cosine of hashed TF-IDF vectors, > threshold, via the blocked C1 product."""
    vec = hashed_tfidf_vectors(docs, num_features).persist()
    return cosine_all_pairs(vec, threshold, block_size, n_items=vec.count())


def content_based_ranked(docs: DataFrame, threshold: float = SIM_THRESHOLD, num_features: int = HASHING_TF_FEATURES,
                         block_size: int | None = None, digits: int = SIM_DIGITS) -> DataFrame:
    """M8 as ranked lists: the edges of ``content_based_edges`` with their rank, without a shuffle of them."""
    return cosine_ranked(hashed_tfidf_vectors(docs, num_features), threshold, block_size, digits=digits)
