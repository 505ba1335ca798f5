r"""Embedding whitening; principal components by QDWH spectral divide-and-conquer.

The vectors are put on an integer grid, ``x = floor(scale * c) + shift``, and
the covariance is taken over the distinct grid vectors. Spark finds these (a
vector that a third of all rows share is combined map-side), and sums them in
two passes: their number and exact per-dimension sums, then the exact sums of
products after an integer centre (the floor of the mean) is taken off. What is
left of the centring is done on whole numbers, so the covariance is the exact
one, rounded once, whatever the order of the tasks.

The covariance (dimensions squared; its size does not depend on the rows) is
decomposed on the driver. The polar factor ``U`` of ``V - m I`` comes from the
dynamically weighted Halley iteration in its QR form; ``(I + U) / 2`` projects
on the components above ``m``. Bases of its range and of the rest split ``V`` in
two smaller matrices, and so on to single components.

The mean and the scaled components (at most ``components`` of them) go to the
tasks, which whiten every row. The covariance of the whitened fit list is
measured in one more pass and given as ``identity_error``.

Cases: rows whose vector is null or holds null or non-finite entries are
dropped. Vectors whose length is not the commonest one (of ties the longest)
are dropped too. Repeated rows and null ids are kept as rows of the result;
equal vectors count once in the fit. Components whose eigenvalue is zero to
double precision (constant or dependent dimensions, fewer vectors than
dimensions) are left out, so a table with one distinct vector, of empty vectors
or without rows gives an empty result. Equal eigenvalues have any orthonormal
basis. ``deviation`` is exact; null where it does not fit 64 bits. Grid values
beyond 2^61 are put on it. Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import give_back, table
from tallyspark.session import stage, unstage

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
ROWS = 2048             # vectors handled together
EPS = float(np.finfo(np.float64).eps)
EXACT = 1 << 53         # whole numbers up to here are exact in a double
GRID = 1 << 61          # entries beyond are put on it
PART = 10 ** 18         # sums go between tasks as high and low part
HALLEY = 40             # iterations; six reach double precision for any condition


# Polar decomposition and the splitting of a symmetric matrix.

def _halley_weights(low: float) -> tuple[float, float, float]:
    """Weights of one iteration when the singular values lie in ``[low, 1]``."""
    d = (4 * (1 - low * low) / low ** 4) ** (1 / 3)
    a = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)))
    b = (a - 1) ** 2 / 4
    return float(a), float(b), float(a + b - 1)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix (its matrix sign), by
    QR-based dynamically weighted Halley iterations."""
    n = len(a)
    norm = float(np.linalg.norm(a))
    if norm == 0:
        return np.eye(n)
    x = a / norm
    low = max(EPS, min(1.0, 1 / (np.sqrt(n) * max(float(np.linalg.cond(x, 1)), 1.0))))
    for _ in range(HALLEY):
        wa, wb, wc = _halley_weights(low)
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        moved = float(np.linalg.norm(new - x))
        x = new
        if moved < 1e-9 and 1 - low < 1e-9:
            break
    return x


def _split(v: np.ndarray, at: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``at``;
    None if one of them is empty or ``at`` is an eigenvalue."""
    n = len(v)
    projector = (polar_factor(v - at * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(float(np.trace(projector))))
    # an eigenvalue at the split itself leaves no projector
    if not 0 < rank < n or np.linalg.norm(projector @ projector - projector) > 1e-8:
        return None
    upper, _ = np.linalg.qr(projector[:, _pivots(projector, rank)])
    upper, _ = np.linalg.qr(projector @ upper)  # one step of subspace iteration
    full, _ = np.linalg.qr(upper, mode="complete")
    return upper, full[:, rank:]


def _pivots(p: np.ndarray, rank: int) -> list[int]:
    """Columns that span the range, each the longest of what is left."""
    rest, picked = p.copy(), []
    for _ in range(rank):
        lengths = (rest * rest).sum(axis=0)
        k = int(lengths.argmax())
        picked.append(k)
        unit = rest[:, k] / np.sqrt(lengths[k])
        rest -= np.outer(unit, unit @ rest)
    return picked


def _shifts(v: np.ndarray) -> list[float]:
    """Where to split: the middle of the diagonal, then the mean of the
    eigenvalues, which has some on either side, and points near it."""
    diag = np.sort(np.diag(v))
    n = len(diag)
    middle = (diag[(n - 1) // 2] + diag[n // 2]) / 2
    mean = diag.mean()
    spread = np.sqrt(max(float(((v - mean * np.eye(n)) ** 2).sum()) / n, 0.0))
    return [float(s) for s in (middle, *[mean + spread * t for t in (0, 0.5, -0.5, 0.01, -0.01, 0.001, -0.001, 1e-5, -1e-5)])]


def spectral_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues, unit eigenvectors as columns)`` of a symmetric matrix,
    falling; the largest entry of every eigenvector is positive."""
    n = len(v)
    total = float(np.linalg.norm(v))
    found: list[tuple[float, np.ndarray]] = []
    work = [(v, np.eye(n))] if n else []
    while work:
        a, basis = work.pop()
        k = len(a)
        off = float(np.linalg.norm(a - np.diag(np.diag(a))))
        if k == 1 or off <= EPS * total:
            found += [(float(a[i, i]), basis[:, i]) for i in range(k)]
            continue
        halves = None
        for at in _shifts(a):
            halves = _split(a, at)
            if halves is not None:
                break
        if halves is None:  # equal to double precision: any basis will do
            found += [(float(a[i, i]), basis[:, i]) for i in range(k)]
            continue
        for part in halves:
            inner = part.T @ a @ part
            work.append(((inner + inner.T) / 2, basis @ part))
    found.sort(key=lambda f: -f[0])
    if not found:
        return np.zeros(0), np.zeros((0, 0))
    vectors = np.stack([f[1] for f in found], axis=1)
    vectors, r = np.linalg.qr(vectors)
    vectors = vectors * np.sign(np.diag(r))
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(n)]
    vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    values = np.einsum("ij,ik,kj->j", vectors, v, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Sums over the rows.

def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """A column of grid vectors as a matrix of 64-bit whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _bound(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y``, exact: in doubles while every sum fits, else in Python's
    whole numbers."""
    if _bound(y) ** 2 * max(len(y), 1) < EXACT:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T.dot(o)


def _grid(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """``(id, x array<long>)`` of the rows that are not dropped."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.where(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    floor = lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(GRID)), F.lit(-GRID))
    return kept.select("id", F.transform("v", lambda c: (floor(c) + F.lit(shift)).cast("long")).alias("x"))


def _commonest_length(vectors: DataFrame) -> int | None:
    sizes = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.orderBy(F.col("rows").desc(), F.col("d").desc()).first()
    return None if top is None else top["d"]


def _totals(fit: DataFrame, d: int, cells: list[tuple[int, int]], add) -> dict[tuple[int, int], int]:
    """Exact sums of ``add(matrix)`` (whole numbers of any size, one per cell)
    over the fit list. A task sums its own rows; what it found goes on as high
    and low part, which Spark adds up. The driver gets one row per cell."""
    rows, cols = (np.array(c, np.int32) for c in zip(*cells))

    def run(batches):
        total = np.zeros(len(cells), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total = total + add(_matrix(batch.column(0).slice(at, ROWS), d))
        yield pa.RecordBatch.from_arrays(
            [rows, cols, pa.array([str(int(t) // PART) for t in total]), pa.array([int(t) % PART for t in total], pa.int64())],
            names=["i", "j", "high", "low"])
        give_back()

    parts = fit.select("x").mapInArrow(run, "i int, j int, high string, low long")
    found = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                        F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    return {(r["i"], r["j"]): int(r["high"]) * PART + int(r["low"]) for r in found}


def fit_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """``(n, S)`` of the fit list ``x``: its size and exact sums."""
    def add(x: np.ndarray) -> np.ndarray:
        own = x.sum(axis=0) if _bound(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
        return np.array([len(x), *[int(t) for t in own]], object)

    totals = _totals(fit, d, [(-1, -1), *[(i, i) for i in range(d)]], add)
    return totals.get((-1, -1), 0), [totals.get((i, i), 0) for i in range(d)]


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit list, divisor ``n``."""
    d = len(sums)
    centre = [s // n for s in sums]
    upper = np.triu_indices(d)

    def add(x: np.ndarray) -> np.ndarray:
        wide = max(_bound(x), max(map(abs, centre))) >= 1 << 61
        y = x.astype(object) - np.array(centre, object) if wide else x - np.array(centre, np.int64)
        return _products(y)[upper]

    rest = [s - n * c for s, c in zip(sums, centre)]  # sums after the integer centre
    v = np.zeros((d, d))
    for (i, j), total in _totals(fit, d, list(zip(*(u.tolist() for u in upper))), add).items():
        # true division of whole numbers rounds once
        v[i, j] = v[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
    return v


class Whitening:
    """Mean and scaled components; bounded by dimensions times components."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, components: int):
        values, vectors = spectral_components(v)
        floor = EPS * len(v) * (float(values[0]) if len(values) else 0.0)
        k = min(components, int((values > max(floor, 0.0)).sum()))
        self.n, self.sums, self.k = n, sums, k
        self.values = values[:k]
        self.explained = (values[:k] / np.trace(v)).tolist() if k else []
        self.scaled = vectors[:, :k] / np.sqrt(values[:k])

    def apply(self, x: np.ndarray) -> tuple[list, np.ndarray]:
        """``(deviations, whitened)`` of grid vectors."""
        n, sums = self.n, self.sums
        if _bound(x) * n < 1 << 61 and max(map(abs, sums), default=0) < 1 << 61:
            off = n * x - np.array(sums, np.int64)
            if _bound(off) ** 2 * off.shape[1] < 1 << 63:
                return (off * off).sum(axis=1).tolist(), (off / n) @ self.scaled
        else:
            off = n * x.astype(object) - np.array(sums, object)
        exact = (off.astype(object) ** 2).sum(axis=1)
        return ([int(e) if e < 1 << 63 else None for e in exact],
                np.array([[o / n for o in row] for row in off.tolist()], np.float64).reshape(x.shape) @ self.scaled)


def identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity."""
    k, n, d = fitted.k, fitted.n, len(fitted.sums)
    rows, cols = np.triu_indices(k)

    def run(batches):
        total = np.zeros(k + len(rows))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                z = fitted.apply(_matrix(batch.column(0).slice(at, ROWS), d))[1]
                total += np.concatenate((z.sum(axis=0), (z.T @ z)[rows, cols]))
        yield pa.RecordBatch.from_arrays([np.concatenate((np.full(k, -1), rows)).astype(np.int32),
                                          np.concatenate((np.arange(k), cols)).astype(np.int32), total],
                                         names=["i", "j", "part"])
        give_back()

    found = (fit.select("x").mapInArrow(run, "i int, j int, part double")
             .groupBy("i", "j").agg(F.sum("part").alias("total")).collect())
    mean = {r["j"]: r["total"] / n for r in found if r["i"] < 0}
    # z is centred before the products; what rounding left of its mean goes too
    return max(abs(r["total"] / n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in found if r["i"] >= 0)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per kept row of ``vectors`` and component: ``id_col, component,
    n, deviation, whitened, explained, identity_error``."""
    grid = _grid(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")), scale, shift)
    d = _commonest_length(grid)
    grid = grid.where(F.size("x") == F.lit(d or 0))
    fit = stage(grid.select("x").distinct(), "whiten-fit")
    n, sums = fit_sums(fit, d) if d else (0, [])
    v = covariance(fit, n, sums) if n else np.zeros((0, 0))
    fitted = Whitening(n, sums, v, components)
    error = identity_error(fit, fitted) if fitted.k else 0.0
    unstage(fit)
    id_type = grid.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                m, k = part.num_rows, fitted.k
                deviations, z = fitted.apply(_matrix(part.column(1), d))
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)), pa.array(deviations, pa.int64()).take(each),
                     pa.array(z.reshape(-1)), pa.array(np.tile(fitted.explained, m)), pa.array(np.full(m * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
        give_back()

    source = grid if fitted.k else grid.limit(0)
    return source.mapInArrow(run, f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, "
                                  "explained double, identity_error double")


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
