"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets are one class. Each of ``TREES`` independent trees
branches the classes by minwise tokens: a class goes to the node of its tree's first
two tokens, and below it to the child of the next token, and so on. A tree is held
as its rows in path order (range-partitioned, so a node that holds a third of all
rows lies in many tasks): every subtree is a run of neighbouring rows, and
comparing a row with the next ``NODE`` rows of its first node compares all
nodes of up to ``NODE`` classes exhaustively, however deep their path. Two sets of similarity 0.8 meet in one tree's
first node with probability 0.64; over 12 trees they miss with probability 5e-6.

Comparison is by 64-token signatures first; pairs whose signatures agree in ``AGREE``
tokens (a pair of similarity 0.8 fails with probability 2e-5) are confirmed
on their full sets. The first pass confirms one partner for each row and tree (in a node
larger than ``NODE`` every row also has the node's first to agree with), which joins most
rows cheaply. The second compares all pairs of different components of every first node, whatever
its size: a node is cut into blocks, and each pair of blocks is a group of its own, so a large node
is split over tasks. It finds the rows that agree with a row of another component, brings their
sets to their blocks, and confirms there all agreeing pairs; only rows and links leave the task.
Its work grows with the square of a node's classes; no pair that shares a node is left out.
Components of all links give one row per document.

Defined results: null, empty or blank text has no shingle, size 0, and is linked
with nothing; equal sets are linked whatever their texts; ``component_id`` is the
smallest identifier reachable, null only if all are null; rows that repeat an identifier
each get a row; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import written
from pickwise.llm.components import components
from pickwise.llm.shingles import hash_functions, minwise_tokens, shingle_set

TREES, TOKENS, NODE, AGREE = 12, 64, 64, 37
#: A block of a large node: rows and shingles at most (about); all pairs of blocks are compared, each in a task's group.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 22
#: Rows of a tile, columns of an incidence matrix; up to FEW pairs of a tile are confirmed one by one.
TILE, COLUMNS, FEW = 512, 4096, 2000
#: Words of a shingle; a link needs PERCENT of the union in the intersection.
WIDTH, PERCENT = 5, 80
#: Bits of the map of documents whose sets are needed: 512 KB whatever the corpus size.
MAP_BITS = 1 << 22
TEXTS_PER_CALL = 256

Batches = Iterator[pa.RecordBatch]


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature); the last two null for an empty set."""
    def sign(batches: Batches) -> Batches:
        functions = hash_functions(TOKENS)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_PER_CALL):
                part = batch.slice(at, TEXTS_PER_CALL)
                sets = [shingle_set(t, width) for t in part.column(1).to_pylist()]
                full = [s for s in sets if len(s)]
                tokens = iter(minwise_tokens(full, functions)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([next(tokens).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "signature"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        sign, "doc_id long, n_shingles long, set_key binary, signature binary")


def tree_rows(classes: DataFrame) -> DataFrame:
    """(node, set_key, rep, path, n_shingles) for the nodes with two classes or more, each tree in path order."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    first = F.substring("signature", F.lit(8) * F.col("tree") + 1, F.lit(8))  # the tree's own two tokens
    rows = classes.select("set_key", "signature", tree).select(
        "set_key", "tree", F.xxhash64("tree", first).alias("node"))
    shared = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    path = F.concat(F.substring("signature", F.lit(8) * F.col("tree") + 1, F.lit(4 * TOKENS)),
                    F.substring("signature", F.lit(1), F.lit(8) * F.col("tree")))
    return rows.join(shared, "node").join(classes, "set_key").select(
        "node", "set_key", "rep", path.alias("path"), "n_shingles")


def _in_path_order(rows: DataFrame) -> DataFrame:
    return (rows.repartitionByRange("node", F.substring("path", 9, 16))
            .sortWithinPartitions("node", "path"))


class _Rows:
    """Rows of a partition as arrays; ``label`` is the key and ``sets`` None where not given."""

    def __init__(self, node, key, rep, tokens, size, label, sets):
        self.node, self.key, self.rep, self.tokens, self.size, self.label, self.sets = (
            node, key, rep, tokens, size, label, sets)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        def objects(i: int) -> np.ndarray:
            out = np.empty(batch.num_rows, object)
            out[:] = batch.column(i).to_pylist()
            return out
        key = objects(1)
        tokens = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u4").reshape(-1, TOKENS)
        sets = np.empty(batch.num_rows, object)
        if batch.num_columns > 6:
            flat, ends = batch.column(6).flatten().to_numpy(), np.cumsum(batch.column(6).value_lengths().to_numpy())
            sets[:] = np.split(flat, ends[:-1])
        return cls(batch.column(0).to_numpy(), key, objects(2), tokens, batch.column(4).to_numpy(),
                   objects(5) if batch.num_columns > 5 else key, sets)

    def take(self, at) -> _Rows:
        return _Rows(*(x[at] for x in vars(self).values()))

    def __add__(self, other: _Rows) -> _Rows:
        return _Rows(*(np.concatenate([x, y]) for x, y in zip(vars(self).values(), vars(other).values(), strict=True)))


def _agreeing(rows: _Rows, new_from: int, has_first: bool, reach: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (i, j) of one node and different labels whose signatures agree, j at
    ``new_from`` or later and at most ``reach`` rows behind i, with their agreeing
    tokens; also each row beyond ``reach`` with its node's first row. ``has_first``: row 0
    is that first row for the rows next to it, at whatever distance."""
    found: list[tuple] = []
    label = np.unique(rows.label, return_inverse=True)[1]

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        # a smaller set than percent of the larger can't be similar enough
        small, large = np.minimum(rows.size[i], rows.size[j]), np.maximum(rows.size[i], rows.size[j])
        possible = (label[i] != label[j]) & (100 * small >= percent * large)
        i, j = i[possible], j[possible]
        for at in range(0, len(i), 50_000):
            x, y = i[at:at + 50_000], j[at:at + 50_000]
            same = (rows.tokens[x] == rows.tokens[y]).sum(axis=1)
            ok = same >= AGREE
            found.append((x[ok], y[ok], same[ok]))

    n = len(rows.node)
    starts = np.flatnonzero(np.r_[True, rows.node[1:] != rows.node[:-1]])
    first = np.repeat(starts, np.diff(np.r_[starts, n]))  # of each row's node
    at, j = np.arange(n) - first, np.arange(new_from, n)
    for d in range(1, min(reach, n - 1) + 1):
        j = j[at[j] >= d]
        if not len(j):
            break
        compare(j - d, j)
    far = np.arange(new_from, n)
    compare(first[far], far) if has_first else None
    far = far[at[far] > reach]
    compare(first[far], far)
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _streamed(emit: Callable, reach: int, percent: int) -> Callable[[Batches], Batches]:
    """A function over a partition in path order: the batches' rows are compared
    with those kept from before (the last ``reach`` rows of the last node, and its first),
    and ``emit`` makes a batch of the rows and their agreeing pairs."""
    def run(batches: Batches) -> Batches:
        kept, has_first = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, new_from = _Rows.of(batch), 0
            if kept is not None:
                rows, new_from = kept + rows, len(kept.node)
            yield emit(rows, *_agreeing(rows, new_from, has_first, reach, percent))
            n = len(rows.node)
            start = int(np.flatnonzero(np.r_[True, rows.node[1:] != rows.node[:-1]])[-1])
            tail = np.arange(max(start, n - reach), n)
            has_first = start < tail[0]
            kept = rows.take(np.r_[start, tail] if has_first else tail)
    return run


def _pair_batch(rows: _Rows, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    swap = rows.key[i] > rows.key[j]
    a, b = np.where(swap, j, i).astype(int), np.where(swap, i, j).astype(int)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.key[a].tolist(), pa.binary()), pa.array(rows.key[b].tolist(), pa.binary()),
         pa.array(rows.rep[a].tolist(), pa.int64()), pa.array(rows.rep[b].tolist(), pa.int64())],
        names=["a", "b", "rep_a", "rep_b"])


def _one_partner(rows: _Rows, i: np.ndarray, j: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
    """For each row its agreeing partner with the smallest key."""
    x, y = np.r_[i, j], np.r_[j, i]
    rank = np.empty(len(rows.key), int)
    rank[np.argsort(rows.key, kind="stable")] = np.arange(len(rows.key))
    order = np.lexsort((rank[y], x))
    x, y = x[order], y[order]
    first = np.r_[True, x[1:] != x[:-1]] if len(x) else np.empty(0, bool)
    return _pair_batch(rows, x[first], y[first])


def _contested_batch(rows: _Rows, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.node[at], pa.int64()), pa.array(rows.key[at].tolist(), pa.binary()),
         pa.array(rows.rep[at].tolist(), pa.int64()), pa.array(rows.size[at], pa.int64()),
         pa.array(rows.label[at].tolist(), pa.binary())],
        names=["node", "set_key", "rep", "n_shingles", "label"])


def _contested(rows: _Rows, i: np.ndarray, j: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
    """The rows that agree with a row of another component."""
    return _contested_batch(rows, np.unique(np.r_[i, j]))


def _linking(percent: int) -> Callable:
    """Confirms agreeing pairs on their full sets, the best first; a pair whose components
    an earlier link has joined needs no confirming."""
    def emit(rows: _Rows, i: np.ndarray, j: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
        label = np.unique(rows.label, return_inverse=True)[1]
        parent = list(range(int(label.max()) + 1 if len(label) else 0))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        left, right = [], []
        for k in np.argsort(-agree, kind="stable").tolist():
            x, y = int(i[k]), int(j[k])
            p, q = root(label[x]), root(label[y])
            if p == q:
                continue
            both = len(np.intersect1d(rows.sets[x], rows.sets[y], assume_unique=True))
            if 100 * both >= percent * (len(rows.sets[x]) + len(rows.sets[y]) - both):
                parent[p] = q
                left.append(x)
                right.append(y)
        return _pair_batch(rows, np.array(left, int), np.array(right, int))
    return emit


def _tiles(rows: _Rows, left: np.ndarray, right: np.ndarray, label: np.ndarray, percent: int) -> Iterator[tuple]:
    """All pairs of ``left`` and ``right`` (row numbers) by tiles: (x, y, mask of the pairs of different
    labels that agree). ``label`` may change between tiles."""
    tokens = rows.tokens.astype(np.uint8)  # a low byte agrees whenever its token does
    by_size = [side[np.argsort(rows.size[side], kind="stable")] for side in (left, right)]
    for a in range(0, len(left), TILE):
        x = by_size[0][a:a + TILE]
        tx, sx = np.ascontiguousarray(tokens[x].T), rows.size[x]
        for b in range(a if left is right else 0, len(right), TILE):
            y = by_size[1][b:b + TILE]
            sy = rows.size[y]
            if 100 * sx[-1] < percent * sy[0] or 100 * sy[-1] < percent * sx[0]:
                continue
            mask = label[x][:, None] != label[y][None, :]
            if not mask.any():
                continue
            ty, same = np.ascontiguousarray(tokens[y].T), np.zeros(mask.shape, np.uint8)
            for k in range(TOKENS):
                same += tx[k][:, None] == ty[k][None, :]
            mask &= same >= AGREE
            mask &= 100 * np.minimum(sx[:, None], sy[None, :]) >= percent * np.maximum(sx[:, None], sy[None, :])
            if mask.any():
                yield x, y, mask


def _shared(rows: _Rows, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Size of the intersection of each of ``x`` with each of ``y``, as a product of incidence matrices."""
    sets = [rows.sets[k] for k in np.r_[x, y]]
    row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1  # the others are in no intersection
    column, row = (np.cumsum(often) - 1)[column[often[column]]], row[often[column]]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, int(often.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), np.float32)
        m[row[lo:hi], column[lo:hi] - at] = 1
        out += m[:len(x)] @ m[len(x):].T
    return out


def _tile_contested(percent: int) -> Callable:
    def emit(rows: _Rows, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        hit = np.zeros(len(rows.key), bool)
        for x, y, mask in _tiles(rows, left, right, np.unique(rows.label, return_inverse=True)[1], percent):
            hit[x[mask.any(axis=1)]] = True
            hit[y[mask.any(axis=0)]] = True
        return _contested_batch(rows, np.flatnonzero(hit))
    return emit


def _tile_links(percent: int) -> Callable:
    def emit(rows: _Rows, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        label = np.unique(rows.label, return_inverse=True)[1]
        parent, out = np.arange(int(label.max()) + 1), []

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = k = parent[parent[k]]
            return k

        for x, y, mask in _tiles(rows, left, right, label, percent):
            i, j = np.nonzero(mask)
            if len(i) <= FEW:
                both = np.array([len(np.intersect1d(rows.sets[p], rows.sets[q], assume_unique=True))
                                 for p, q in zip(x[i], y[j], strict=True)])
            else:
                both = _shared(rows, x, y)[i, j].astype(np.int64)
            i, j = x[i], y[j]
            similar = 100 * both >= percent * (rows.size[i] + rows.size[j] - both)
            for k, m in zip(i[similar].tolist(), j[similar].tolist(), strict=True):
                p, q = root(label[k]), root(label[m])
                if p != q:
                    parent[p] = q
                    out.append((k, m))
            label[:] = np.array([root(k) for k in range(len(parent))])[label]
        return _pair_batch(rows, np.array([k for k, _ in out], int), np.array([m for _, m in out], int))
    return emit


def _exhaustive(small: Callable, large: Callable, percent: int) -> Callable[[Batches], Batches]:
    """A function over a partition of ``in_blocks`` rows: all pairs of every group are compared,
    those of groups of up to ``NODE`` rows together (``small``), larger ones each by itself (``large``)."""
    def done(batch: pa.RecordBatch, starts: np.ndarray, node_rows: int) -> Batches:
        sizes = np.diff(np.r_[starts, batch.num_rows])
        rows = _Rows.of(batch.select(batch.schema.names[3:]))
        low, high, block = (batch.column(k).to_numpy() for k in range(3))
        few = (sizes <= node_rows) & (low[starts] == high[starts])
        at = np.flatnonzero(np.repeat(few, sizes))
        if len(at):
            some = rows.take(at)
            yield small(some, *_agreeing(some, 0, False, node_rows, percent))
        for start, size in zip(starts[~few], sizes[~few], strict=True):
            group = np.arange(start, start + size)
            one, of = rows.take(group), block[group]
            left = np.flatnonzero(of == low[start])
            yield large(one, left, left if low[start] == high[start] else np.flatnonzero(of == high[start]))

    def run(batches: Batches) -> Batches:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if kept is None else pa.concat_batches([kept, batch])
            group = [batch.column(k).to_numpy() for k in (0, 1, 3)]
            new = np.logical_or.reduce([g[1:] != g[:-1] for g in group])
            starts = np.flatnonzero(np.r_[True, new])
            kept = batch.slice(starts[-1])
            if starts[-1]:
                yield from done(batch.slice(0, starts[-1]), starts[:-1], NODE)
        if kept is not None:
            yield from done(kept, np.array([0]), NODE)
    return run


PAIRS = "a binary, b binary, rep_a long, rep_b long"


ROWS = "node long, set_key binary, rep long, n_shingles long, label binary"


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (node, set_key, rep, n_shingles, label) of the nodes with two labels or more, once for
    each pair (low, high) of blocks of their node that their own ``block`` belongs to. A block has
    about ``BLOCK`` rows and ``BLOCK_SHINGLES`` shingles at most; most nodes are one."""
    n = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    nodes = rows.groupBy("node").agg(n.alias("blocks"), F.min("label").alias("least"), F.max("label").alias("most")).where(
        "least != most").select("node", "blocks")
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    return rows.join(nodes, "node").select(
        "*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", *rows.columns)


def _grouped(rows: DataFrame, more: list[str]) -> DataFrame:
    return (rows.select("low", "high", "block", "node", "set_key", "rep", "signature", "n_shingles", "label", *more)
            .repartition("node", "low", "high").sortWithinPartitions("node", "low", "high"))


def _pairs(rows: DataFrame, emit: Callable, reach: int, percent: int) -> DataFrame:
    return (rows.mapInArrow(_streamed(emit, reach, percent), PAIRS).where("a < b")
            .groupBy("a", "b").agg(F.first("rep_a").alias("rep_a"), F.first("rep_b").alias("rep_b")))


def _bit(column) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(MAP_BITS)).cast("int")


def needed_sets(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(set_key, shingles) of all classes in ``pairs``, from a second scan of the texts.
    A bit map of their documents (``MAP_BITS``, at most 64 bits a row to the driver) tells
    the scan which texts to shingle; documents that share a bit only add unused rows."""
    bits = pairs.select(F.explode(F.array("rep_a", "rep_b")).alias("id")).select(_bit("id").alias("bit"))
    words = bits.groupBy(F.expr("bit div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("mask")).collect()
    bitmap = np.zeros(MAP_BITS // 64, np.int64)
    for word, mask in words:
        bitmap[word] = mask
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap)

    def shingle(batches: Batches) -> Batches:
        for batch in batches:
            bit = batch.column(0).to_numpy()
            wanted = np.flatnonzero((bitmap.value[bit >> 6] >> (bit & 63)) & 1)
            for at in range(0, len(wanted), TEXTS_PER_CALL):
                texts = batch.column(1).take(pa.array(wanted[at:at + TEXTS_PER_CALL])).to_pylist()
                sets = [s for s in (shingle_set(t, width) for t in texts) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_key(s) for s in sets], pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set_key", "shingles"])

    scanned = docs.select(_bit(F.col(id_col).cast("long")).alias("bit"), F.col(text_col).alias("text")).mapInArrow(
        shingle, "set_key binary, shingles array<long>")
    return scanned.groupBy("set_key").agg(F.first("shingles").alias("shingles"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def side(c: str) -> DataFrame:
        return sets.select(F.col("set_key").alias(c), F.col("shingles").alias(f"set_{c}"))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("inter")
    return both.withColumn("inter", inter).where(100 * F.col("inter") >= percent * union).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per document."""
    signed = written(signatures(docs, id_col, text_col, width), "near-signatures")
    classes = written(signed.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature"),
        F.first("n_shingles").alias("n_shingles")), "near-classes")
    rows = written(_in_path_order(tree_rows(classes)), "near-rows")
    first = written(_pairs(rows, _one_partner, NODE, percent), "near-pairs")
    sets = written(needed_sets(docs, first, id_col, text_col, width), "near-sets")
    links = written(confirmed(first, sets, percent), "near-links")
    labels = components(links).withColumnsRenamed({"vertex": "set_key", "component": "label"})
    labelled = written(rows.select("node", "set_key", "rep", "n_shingles").join(labels, "set_key", "left").select(
        "node", "set_key", "rep", "n_shingles", F.coalesce("label", "set_key").alias("label")), "near-labelled")
    tokens = classes.select("set_key", "signature")
    contested = written(_grouped(in_blocks(labelled).join(tokens, "set_key"), []).mapInArrow(
        _exhaustive(_contested, _tile_contested(percent), percent), ROWS).distinct(), "near-contested")
    missing = written(contested.select("set_key", "rep").distinct().join(sets.select("set_key"), "set_key", "left_anti"),
                      "near-missing")
    late = needed_sets(docs, missing.select(F.col("rep").alias("rep_a"), F.col("rep").alias("rep_b")),
                       id_col, text_col, width).join(missing.select("set_key"), "set_key", "left_semi")
    sets = sets.union(written(late, "near-sets"))
    with_sets = _grouped(in_blocks(contested).join(tokens, "set_key").join(sets, "set_key"), ["shingles"])
    more = written(with_sets.mapInArrow(_exhaustive(_linking(percent), _tile_links(percent), percent), PAIRS)
                   .where("a < b").select("a", "b").distinct(), "near-links")
    grouped = classes.select("set_key", "rep").join(
        components(links.union(more)).withColumnRenamed("vertex", "set_key"), "set_key", "left").select(
        "set_key", "rep", F.coalesce("component", "set_key").alias("component"))
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = grouped.join(least, "component").select("set_key", "component_id")
    linked = signed.where("set_key is not null").join(of_class, "set_key").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("set_key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                         percent: int = PERCENT) -> DataFrame:
    """The documents of which ``kept`` holds, with all their columns."""
    stay = near_duplicates(docs, id_col, text_col, width, percent).where("kept").select(
        F.col("doc_id").alias("stay_id")).distinct()
    return docs.join(stay, docs[id_col].cast("long").eqNullSafe(F.col("stay_id")), "left_semi")
