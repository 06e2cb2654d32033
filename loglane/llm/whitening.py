"""Whitening of embeddings by QDWH spectral divide-and-conquer.

Spark does what grows with the table: the distinct grid vectors (the fit
list), their exact sums, the sum of centred products, and the whitening of every row. The d x d
covariance is all that the driver sees. Its components come from
``spectral_components``: the polar factor U of the covariance shifted by a
value s inside its spectrum (QDWH iterations) gives the projector (U + I) / 2
on the invariant subspace of the eigenvalues above s; the matrix is restricted
to that subspace and its complement, and each part is split again until the
parts are diagonal. Only parts that can hold a wanted component are split. The
components, mean and scales (d x 16 numbers) go to the tasks in the closure.

Grid: entry c becomes the integer x = floor(64 * c) + 1,000,000. Sums and
deviations are exact integers; products are taken of (n*x - S) / n in double.

Defined results: vectors null or empty, or with null, non-finite or
out-of-range entries (64 * c beyond 2^53) give no row; of vectors of unlike
length those count whose length most distinct vectors have (ties: the longer).
Repeated rows count once in the fit list and are all returned; null vec_ids
are kept. A component whose eigenvalue is nothing but rounding has explained as
computed and a null ``whitened``, and stays out of identity_error (0 where no
component remains). Equal eigenvalues give some orthonormal basis of their
space, the same for all rows. A deviation beyond the range of long is null.
Fewer than 16 dimensions give as many components; an empty table an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, ship_package, stored

COMPONENTS = 16
SCALE, SHIFT = 64.0, 1_000_000
RANGE = float(1 << 53)
EPS = np.finfo(np.float64).eps
_LONG = (1 << 63) - 1


# --- the spectrum of a symmetric matrix ----------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor U of a = U H by QDWH: dynamically weighted Halley
    steps, through QR while the weights are large, then through Cholesky."""
    n = len(a)
    eye = np.eye(n)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)  # the Frobenius norm bounds the largest singular value
    low = EPS  # as good as singular; costs a step or two where the matrix is not
    for _ in range(20):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        w = np.sqrt(1 + d)
        wa = w + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * w))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            r = np.linalg.cholesky(eye + wc * (x.T @ x))
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(r.T, np.linalg.solve(r, x.T)).T
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(low - 1) < 10 * EPS and moved < EPS ** (1 / 3):
            break
    return (x + x.T) / 2


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below a
    shift; None where rounding leaves nothing to split."""
    n = len(a)
    mean = float(np.trace(a)) / n
    spread = float(np.linalg.norm(a - mean * np.eye(n))) / np.sqrt(n)
    if spread <= 4 * EPS * np.linalg.norm(a):
        return None
    shifts = [float(np.median(np.diag(a))), mean, *(mean + f * spread for f in (0.05, -0.05, 0.15, -0.15, 0.3, -0.3))]
    for shift in shifts:
        p = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(float(np.trace(p))))
        # an eigenvalue at the shift is neither above nor below: take another
        if not (0 < k < n and np.linalg.norm(p @ p - p) <= 1e-10 * n):
            continue
        for attempt in range(4):  # a random start that misses a direction shows in what couples the parts
            g = np.random.default_rng([n, k, attempt]).standard_normal((n, n))
            above, _ = np.linalg.qr(p @ (p @ g[:, :k]))
            rest = g[:, k:] - p @ g[:, k:]
            rest -= p @ rest + above @ (above.T @ rest)
            below, _ = np.linalg.qr(rest)
            below, _ = np.linalg.qr(below - above @ (above.T @ below))
            if np.linalg.norm(below.T @ a @ above) <= 1e-12 * n * np.linalg.norm(a):
                return above, below
    return None


def spectral_components(a: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns."""
    found: list[np.ndarray] = []  # bases of finished parts, larger eigenvalues first
    parts = [np.eye(len(a))]  # bases still to be split, the next one last
    while parts and sum(v.shape[1] for v in found) < top:
        v = parts.pop()
        own = v.T @ a @ v
        own = (own + own.T) / 2
        off = np.linalg.norm(own - np.diag(np.diag(own)))
        bases = None if len(own) == 1 or off <= EPS * np.linalg.norm(own) else split(own)
        if bases is None:
            found.append(v[:, np.argsort(-np.diag(own), kind="stable")])
        else:
            parts += [v @ bases[1], v @ bases[0]]
    v = np.hstack(found)
    v, _ = np.linalg.qr(v)
    e = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-e, kind="stable")[:top]
    return e[order], v[:, order]


# --- sums over the fit list -------------------------------------------------------

def usable(vector: str = "embedding") -> Column:
    """Rows that take part, before lengths are compared."""
    c = F.col(vector)
    return (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * SCALE < RANGE))


def on_grid(vector: str = "embedding") -> Column:
    return F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n*x - S, exact: as int64 where that surely fits, else as Python integers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, s)) < 1 << 62:
        return x * n - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each dimension."""
    def run(batches):
        n, s = 0, [0] * d
        for b in batches:
            x = _matrix(b.column(0), d)
            n += len(x)
            for at in range(0, len(x), 256):  # 256 values of 2^54 fit
                s = [a + int(v) for a, v in zip(s, x[at:at + 256].sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(v) for v in [n, *s]])],
                                         ["i", "s"])

    rows = (fit.select("x").mapInArrow(run, "i int, s string").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    total = {r["i"]: int(r["s"]) for r in rows}
    return total.get(0, 0), [total.get(i + 1, 0) for i in range(d)]


def mean_product(fit: DataFrame, d: int, values, k: int) -> np.ndarray:
    """The k x k matrix of mean products of ``values(x)`` (rows of k doubles)
    over the fit list."""
    def run(batches):
        total, n = np.zeros((k, k)), 0
        for b in batches:
            y = values(_matrix(b.column(0), d))
            total += y.T @ y
            n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64())),
                                          pa.array([n] * k, pa.int64())], ["i", "row", "n"])

    parts = fit.select("x").mapInArrow(run, "i int, row array<double>, n long")
    cells = parts.select("i", "n", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(
        F.sum("v").alias("v"), F.sum("n").alias("n")).collect()  # k x k cells
    out = np.zeros((k, k))
    for r in cells:
        out[r["i"], r["j"]] = r["v"] / r["n"]
    return (out + out.T) / 2


class Whitening:
    """What the tasks need: n, exact sums, components and scales."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.vectors = n, sums, vectors
        self.explained = values / trace if trace > 0 else np.zeros_like(values)
        real = values > 64 * len(sums) * EPS * max(float(values.max(initial=0.0)), 0.0)
        self.scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), np.nan)
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (_centred(x, self.n, self.sums) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) * self.scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        y = _centred(x, self.n, self.sums)
        if y.dtype == np.int64 and int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] <= _LONG:
            return (y * y).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in y]
        return [v if v <= _LONG else None for v in exact]


def fit_whitening(vectors: DataFrame, top: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct grid vectors of (embedding); None without any."""
    ship_package(vectors.sparkSession)
    grid = stored(vectors.where(usable()).select(on_grid().alias("x")).distinct(), "whitening-fit")
    size = grid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return None
    d = int(size["d"])
    grid = grid.where(F.size("x") == d)
    n, sums = exact_sums(grid, d)
    blank = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    v = mean_product(grid, d, blank.centred, d)
    w = Whitening(n, sums, *spectral_components(v, min(top, d)), float(np.trace(v)))
    kept = np.isfinite(w.scale)
    if kept.any():
        k = int(kept.sum())
        c = mean_product(grid, d, lambda x: np.ascontiguousarray(w.whitened(x)[:, kept]), k)
        w.identity_error = float(np.abs(c - np.eye(k)).max())
    return w


def whiten(vectors: DataFrame, w: Whitening) -> DataFrame:
    """A row per (vec_id, component) of the rows of (vec_id, embedding) that take part."""
    d, k = w.vectors.shape

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x, m = _matrix(part.column(1), d), part.num_rows
                white = w.whitened(x).ravel()
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n, np.int64)),
                    pa.array(w.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(white, pa.float64(), mask=~np.isfinite(white)),
                    pa.array(np.tile(w.explained, m)),
                    pa.array(np.full(m * k, w.identity_error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = vectors.where(usable() & (F.size("embedding") == d)).select(
        F.col("vec_id").cast("long").alias("vec_id"), on_grid().alias("x"))
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    w = fit_whitening(vectors)
    return whiten(vectors, w or Whitening(0, [0], np.zeros(0), np.zeros((1, 0)), 0.0))
