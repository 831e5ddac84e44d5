"""Embedding whitening by an incrementally kept eigendecomposition.

Entries are brought to integers, x = floor(1024 c) + 100000, so that counts and sums are exact. The
covariance's eigenvectors come in three steps:

1. Every task keeps the spectrum (eigenvalues, eigenvectors) of the scatter matrix of the rows it has
   seen, about their mean, and changes it by centred rank-one updates: the secular equation gives the
   new eigenvalues, after deflation of directions that the update doesn't touch and of equal
   eigenvalues (``rank_one``). An Arrow batch X, centred at its own mean, enters through the rows of its triangular
   factor R (XᵀX = RᵀR): as many updates as dimensions however many rows the batch has, and one more for the
   distance of the means. (One update for each row, of some 0.5 to 1.4 ms in NumPy, would take thousands of CPU seconds a GB.)
2. The tasks' spectra are combined, ``FAN_IN`` at a time in tasks, by successive rank-one updates.
3. Rayleigh-Ritz: the covariance is taken once more over all rows, centred, inside the orthonormalised
   basis of step 2, and the small matrix's eigenvectors turn that basis into the components.

Memory is a few matrices of dimension x dimension in a task and on the driver, whatever the number
of rows; vectors are narrow and are read three times. Nothing is shuffled but one spectrum for each task.

Defined results: rows whose vector is null, has null or non-finite entries, or an entry with
|1024 c| above 2^52 are dropped; vectors should have one length, those of another length than the most frequent
(of equally frequent ones the longer) are dropped too; null and repeated identifiers are kept as rows of their
own; components whose eigenvalue is zero (up to rounding) aren't given, so a single vector or equal
vectors give no rows, as does an empty table; equal eigenvalues have any orthonormal basis of their space;
``deviation`` is null where the exact value is beyond a long, ``deviation_exact`` has it with up to 38
digits; other columns are not read."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import written

SCALE, SHIFT = 1024.0, 100_000
LARGEST = 2.0 ** 52
COMPONENTS = 8
#: So many states of tasks are merged by one task.
FAN_IN = 16
#: Entries worked on together.
CELLS = 1 << 20
EPS = float(np.finfo(float).eps)
STATE = "part int, state binary"


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for rising, different ``d`` and positive ``z2``: (k, t), the
    i-th root being d[k[i]] + t[i], with d[k[i]] the nearer of its two poles. All roots are sought together, by
    interpolation with the two poles around each, and by bisection where that leaves the bracket."""
    n = len(d)
    width = np.append(np.diff(d), z2.sum())
    middle = d + width / 2
    at_middle = 1 + (z2 / (d[None, :] - middle[:, None])).sum(axis=1)
    k = np.arange(n)
    right = (at_middle < 0) & (k < n - 1)
    k = k + right
    delta = d[None, :] - d[k][:, None]
    below = np.arange(n)[None, :] <= np.arange(n)[:, None]
    pole_a = np.where(right, -width, 0.0)  # the poles around a root, from its own origin
    pole_b = np.where(right, 0.0, width)
    lo = np.where(right | (at_middle >= 0), pole_a, width / 2)
    lo = np.where(right, -width / 2, lo)
    hi = np.where(right, 0.0, np.where(at_middle >= 0, width / 2, width))
    t = (lo + hi) / 2
    open_ = np.ones(n, bool)
    for _ in range(200):
        gap = delta - t[:, None]
        term = z2 / gap
        slope = term / gap
        f = 1 + term.sum(axis=1)
        open_ &= np.abs(f) > 4 * EPS * n * (1 + np.abs(term).sum(axis=1))
        lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
        open_ &= (hi - lo) > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if not open_.any():
            break
        psi, dpsi = np.where(below, term, 0.0).sum(axis=1), np.where(below, slope, 0.0).sum(axis=1)
        phi, dphi = f - 1 - psi, slope.sum(axis=1) - dpsi
        a, b = pole_a - t, pole_b - t
        c = 1 + psi - dpsi * a + np.where(np.arange(n) < n - 1, phi - dphi * b, 0.0)
        s, big_s = dpsi * a * a, np.where(np.arange(n) < n - 1, dphi * b * b, 0.0)
        q, w = c * (a + b) + s + big_s, a * b * f
        root = np.sqrt(np.maximum(q * q - 4 * c * w, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(q > 0, 2 * w / (q + root), (q - root) / (2 * c))
            step = np.where(np.arange(n) < n - 1, step, a + s / c)
        new = t + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        t = np.where(open_, np.where(inside, new, (lo + hi) / 2), t)
    return k, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of ``vectors @ diag(values) @ vectors.T + v v.T``."""
    z = vectors.T @ v
    size = float(z @ z)
    scale = max(float(np.abs(values).max(initial=0.0)), size)
    if size <= EPS * EPS * scale or size == 0.0:
        return values, vectors
    vectors = vectors.copy()
    # equal eigenvalues: turn their vectors so that one of them takes the whole update
    cuts = np.flatnonzero(np.diff(values) > 8 * EPS * scale) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(values)], strict=True):
        if b - a > 1:
            w = z[a:b].copy()
            length = float(np.sqrt(w @ w))
            if length == 0.0:
                continue
            sign = 1.0 if w[0] >= 0 else -1.0
            w[0] += sign * length
            vectors[:, a:b] -= np.outer(vectors[:, a:b] @ w, w * (2.0 / (w @ w)))
            z[a:b] = 0.0
            z[a] = -sign * length
    live = np.abs(z) * np.sqrt(size) > 8 * EPS * scale  # the others are eigenvectors already
    if not live.any():
        return values, vectors
    d, zl = values[live], z[live]
    n = len(d)
    k, t = secular_roots(d, zl * zl)
    away = (d[k][:, None] - d[None, :]) + t[:, None]  # root i minus pole j
    # the update that has exactly these roots, so that the vectors are orthogonal
    ratio = np.ones((n, n))
    poles = d[None, :] - d[:, None]  # [i, j]: pole j minus pole i
    i, j = np.indices((n, n))
    low, high = j < i, (j >= i) & (j < n - 1)
    ratio[low] = (away.T[low]) / poles[low]
    ratio[high] = away.T[high] / np.roll(poles, -1, axis=1)[high]
    exact = np.sqrt(np.maximum(ratio.prod(axis=1) * away[n - 1, :], 0.0)) * np.where(zl < 0, -1.0, 1.0)
    turn = exact[:, None] / -away.T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors
    new_values[live] = d[k] + t
    new_vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


@dataclass
class Spectrum:
    """Count and sums of integer rows, and the eigendecomposition of their scatter about their mean."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, [0] * dim, np.zeros(dim), np.eye(dim))

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def add(self, n: int, sums: list[int], directions: np.ndarray) -> None:
        """Rows known by their count, sums and vectors whose outer products add up to their scatter."""
        if self.n:
            apart = np.array([s / n for s in sums]) - self.mean()
            directions = np.vstack([directions, apart * np.sqrt(self.n * n / (self.n + n))])
        for v in directions:
            self.values, self.vectors = rank_one(self.values, self.vectors, v)
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]

    def add_rows(self, y: np.ndarray) -> None:
        sums = exact_sums(y)
        centred = y - np.array([s / len(y) for s in sums])
        self.add(len(y), sums, np.linalg.qr(centred, mode="r") if len(y) > y.shape[1] else centred)

    def merge(self, other: Spectrum) -> None:
        self.add(other.n, other.sums, other.vectors.T * np.sqrt(np.maximum(other.values, 0.0))[:, None])


def exact_sums(y: np.ndarray) -> list[int]:
    """Column sums of integers held as doubles."""
    whole = y.astype(np.int64)
    if float(np.abs(y).max(initial=0.0)) * len(y) >= 2.0 ** 62:
        whole = whole.astype(object)
    return [int(s) for s in whole.sum(axis=0)]


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """x - SHIFT of a column of vectors that have passed ``usable``, as doubles (they are exact)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(-1, dim)


def _rows(dim: int) -> int:
    return max(dim, CELLS // dim)


def usable(vector: Column) -> Column:
    """Not null, and neither null nor non-finite nor too large entries."""
    fits = F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST / SCALE), F.lit(False)))
    return vector.isNotNull() & F.coalesce(fits, F.lit(False))


def per_task(rows: DataFrame, dim: int, start: Callable, step: Callable) -> DataFrame:
    """``STATE`` rows, one for each task that has rows: ``start()`` changed by ``step(state, y)`` for each run of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            y = integers(batch.column(0), dim)
            for at in range(0, len(y), _rows(dim)):
                state = step(start() if state is None else state, y[at:at + _rows(dim)])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([pickle.dumps(state)], pa.binary())], names=["part", "state"])

    return rows.select("v").mapInArrow(run, STATE)


def merged(states: DataFrame, name: str, merge: Callable):
    """All states as one, ``FAN_IN`` at a time inside tasks, in the order of their parts; None without states."""
    def fold(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [pickle.loads(s) for s in group.sort_values("part")["state"]]
        state = parts[0]
        for other in parts[1:]:
            state = merge(state, other)
        return pd.DataFrame({"part": [int(key[0])], "state": [pickle.dumps(state)]})

    states = written(states, name)
    last = states.agg(F.max("part")).first()[0]
    while last:
        states = written(states.groupBy(F.expr(f"part div {FAN_IN}").cast("int").alias("to")).applyInPandas(fold, STATE), name)
        last //= FAN_IN
    left = states.select("state").collect()  # one row
    return pickle.loads(left[0][0]) if left else None


@dataclass
class Whitener:
    """``components``: unit eigenvectors as columns, by falling eigenvalue (``values``)."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _added(state: Spectrum, y: np.ndarray) -> Spectrum:
    state.add_rows(y)
    return state


def _merged(state: Spectrum, other: Spectrum) -> Spectrum:
    state.merge(other)
    return state


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener | None:
    """``rows``: (v), usable vectors of length ``dim``. Without rows: None."""
    spectrum = merged(per_task(rows, dim, lambda: Spectrum.empty(dim), _added), "spectra", _merged)
    if spectrum is None:
        return None
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    mean = spectrum.mean()

    def inside(state: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = (y - mean) @ basis
        return state + p.T @ p

    small = merged(per_task(rows, dim, lambda: np.zeros((dim, dim)), inside), "ritz", lambda a, b: a + b) / spectrum.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    k = int(min(components, (values > dim * EPS * max(values[0], 0.0)).sum())) if dim else 0
    return Whitener(spectrum.n, spectrum.sums, basis @ turn[:, :k], values[:k], float(np.trace(small)))


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n y - sums)^2 of each row, exact."""
    largest = n * float(np.abs(y).max(initial=0.0)) + max((abs(s) for s in sums), default=0)
    kind = np.int64 if largest * largest * max(1, y.shape[1]) < 2.0 ** 62 else object
    t = y.astype(np.int64).astype(kind) * n - np.array(sums, kind)
    return (t * t).sum(axis=1).tolist()


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact."""
    given = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")).where(usable(F.col(vector_col)))
    common = given.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("dim")).first()
    dim = common["dim"] if common else 0
    rows = given.where(F.size("v") == dim)
    model = fit(rows, dim, components) if dim else None
    found = len(model.values) if model else 0
    id_type = given.schema["vec_id"].dataType.simpleString()
    if not found:
        return given.where("false").select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
            F.lit(0).cast("decimal(38,0)").alias("deviation_exact"))
    mean, n, sums = model.mean(), model.n, model.sums
    scaled = model.components / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = _rows(dim)
            for at in range(0, batch.num_rows, size):
                y = integers(batch.column(1).slice(at, size), dim)
                exact = deviations(y, n, sums)
                w = (y - mean) @ scaled
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, size),
                     pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64()),
                     pa.array([None if e < 2 ** 63 else str(e) for e in exact], pa.string()),
                     pa.FixedSizeListArray.from_arrays(pa.array(w.ravel(), pa.float64()), found).cast(pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "digits", "w"])

    table = written(rows.select("vec_id", "v").mapInArrow(
        project, f"vec_id {id_type}, deviation long, digits string, w array<double>"), "whitened")
    pairs = [(i, j) for i in range(found) for j in range(i + 1)]
    sums_w = table.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(found)],
                       *[F.avg(F.col("w")[i] * F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(sums_w[f"c{i}_{j}"] - sums_w[f"m{i}"] * sums_w[f"m{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return (table.select("vec_id", "deviation", F.coalesce(
                F.col("deviation").cast("decimal(38,0)"), F.col("digits").try_cast("decimal(38,0)")).alias("deviation_exact"),
                F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"), "deviation_exact"))
