"""Whitening of vectors by the leading eigenvectors of their covariance.

The covariance comes from exact integer sums that Spark makes. Its spectrum is cut: the signs in D of an LDL^T
factorisation of V - sI count the eigenvalues above s (Sylvester), so halving an interval isolates the j-th largest
one. Rayleigh quotient iteration then converges to it cubically, and counts on both sides of the result certify that
it is number j. Everything the driver holds grows with the square of the vectors' length, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..session import staged
from .exact import LONG_MAX, PARTIAL, by_size, integers, partial, summed

EPS = float(np.finfo(np.float64).eps)
#: Rows of one exact product in doubles, and how large its factors may be: 2^12 * 2^20 * 2^20 stays below 2^53.
BLOCK_ROWS = 1 << 12
BLOCK_MOST = 1 << 20
#: Cells of covariance that a task keeps before it hands them on.
HELD_CELLS = 4_000_000


@dataclass(frozen=True)
class Settings:
    components: int = 32
    scale: int = 64
    shift: int = 1_000_000


def above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of symmetric v exceed s: the positive ones of D in P(V - sI)P' = LDL'.

    Pivots of size 1 or 2 are the largest of what remains (Bunch and Parlett), so growth stays bounded.
    """
    a = v - s * np.eye(len(v))
    positive = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        i = int(diagonal.argmax())
        most = float(size.max())
        if most == 0.0:
            break
        if diagonal[i] >= 0.6403882032022076 * most:
            pivot, rest = a[i, i], np.delete(np.arange(len(a)), i)
            positive += bool(pivot > 0)
            col = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(col / pivot, col)
        else:
            i, j = divmod(int(size.argmax()), len(a))
            rest = np.delete(np.arange(len(a)), [i, j])
            block = a[np.ix_([i, j], [i, j])]
            positive += 1  # its off-diagonal part dominates: one eigenvalue of each sign
            cols = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - cols @ np.linalg.solve(block, cols.T)
        a = (a + a.T) / 2
    return positive


def _solve(v: np.ndarray, s: float, x: np.ndarray, nudge: float) -> np.ndarray:
    eye = np.eye(len(v))
    while True:
        try:
            y = np.linalg.solve(v - s * eye, x)
            if np.isfinite(y).all():
                return y
        except np.linalg.LinAlgError:
            pass
        s, nudge = s + nudge, 2 * nudge  # exactly an eigenvalue


def _apart(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """x without its part along the vectors found, as a unit vector."""
    for _ in range(2):
        for f in found:
            x = x - (f @ x) * f
    return x / np.linalg.norm(x)


def leading(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray, float]]:
    """(eigenvalue, unit eigenvector, radius) of the k largest eigenvalues of symmetric v, falling; fewer where the
    rest are zero to rounding.

    `radius` is certified: fewer than j eigenvalues exceed value + radius and at least j exceed value - radius.
    """
    norm = float(np.abs(v).sum(axis=1).max()) if len(v) else 0.0
    if norm == 0.0:
        return []
    floor = 16 * len(v) * EPS * norm
    counts = {-2 * norm: len(v), 2 * norm: 0}

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = above(v, s)
        return counts[s]

    positive = count(floor)
    random = np.random.default_rng(0)
    found: list[tuple[float, np.ndarray, float]] = []
    for j in range(1, min(k, positive) + 1):
        vectors = [x for _, x, _ in found]
        while True:
            lo = max(s for s, c in counts.items() if c >= j)
            hi = min(s for s, c in counts.items() if c < j and s > lo)
            alone = counts[lo] - counts[hi] == 1
            middle = (lo + hi) / 2
            if not alone and hi - lo > floor:
                count(middle)
                continue
            x = _apart(random.standard_normal(len(v)), vectors)
            for _ in range(3):
                x = _apart(_solve(v, middle, x, floor), vectors)
            rho = float(x @ v @ x)
            for _ in range(30 if hi - lo > floor else 0):
                x = _apart(_solve(v, rho, x, floor * 2**-10), vectors)
                last, rho = rho, float(x @ v @ x)
                if abs(rho - last) <= 4 * EPS * norm and np.linalg.norm(v @ x - rho * x) <= floor:
                    break
            if hi - lo <= floor or (lo - floor <= rho <= hi + floor and np.linalg.norm(v @ x - rho * x) <= floor):
                break
            count(middle)  # it went to another eigenvalue: start nearer
        radius = floor
        while not (above(v, rho + radius) < j <= above(v, rho - radius)):
            radius *= 4
        x = x * (1 if x[np.abs(x).argmax()] > 0 else -1)
        found.append((rho, x, radius))
    return sorted(found, key=lambda f: -f[0])


@dataclass
class Fit:
    """`n` rows, sums, the integers nearest to the means, covariance, eigenvalues and vectors of one vector length."""

    n: int
    sums: list[int]
    centre: np.ndarray
    trace: float = 0.0
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    error: float = 0.0

    def left(self) -> list[int]:
        """Per dimension: the sum of what the rows have above the centre."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components, over the root of their eigenvalues."""
        away = np.array([t / self.n for t in self.left()], dtype=np.float64)
        return ((x - self.centre).astype(np.float64) - away) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact; beyond a long it stays at the largest one."""
        z, left = x - self.centre, self.left()
        most = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, left), default=0)
        exact = z if most * most * max(1, len(left)) < 2**62 else z.astype(object)
        d = exact * self.n - np.array(left, dtype=exact.dtype)
        return [min(int(t), LONG_MAX) for t in (d * d).sum(1)]


def products(z: np.ndarray) -> np.ndarray:
    """z' z in exact integers."""
    if not z.size or int(np.abs(z).max()) < BLOCK_MOST:
        total = np.zeros((z.shape[1], z.shape[1]), dtype=np.int64)
        for at in range(0, len(z), BLOCK_ROWS):
            f = z[at : at + BLOCK_ROWS].astype(np.float64)
            total += (f.T @ f).astype(np.int64)
        return total
    z = z.astype(object)
    return z.T @ z


def _partials(rows: DataFrame, schema: StructType, of, release) -> DataFrame:
    """Per task and vector length, the sum over batches of `of(size, x)`, handed on as `release(size, n, total)`."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}

        def out() -> Iterator[pa.RecordBatch]:
            for size, (n, total) in sums.items():
                for batch in release(size, n, total):
                    yield pa.RecordBatch.from_pylist(batch, schema=arrow)
            sums.clear()

        for batch in batches:
            for size, _, x in by_size(batch):
                n, total = sums.get(size, (0, 0))
                sums[size] = n + len(x), total + of(size, x)
                if sums[size][0] >= 1 << 20 or sum(np.size(t) for _, t in sums.values()) > HELD_CELLS:
                    yield from out()
        yield from out()

    return rows.mapInArrow(run, schema)


def fit(rows: DataFrame, s: Settings = Settings()) -> dict[int, Fit]:
    """A fit for each vector length of rows (size, x): sums first, then products of what lies above the centres."""
    sc = rows.sparkSession.sparkContext
    rows = rows.select("size", "x")
    sums = summed(_partials(rows, PARTIAL, lambda size, x: x.sum(0).astype(object), lambda size, n, total: [[partial(size, 0, 0, n, total)]]))
    fits = {size: Fit(n, total, np.array([(2 * t + n) // (2 * n) for t in total], dtype=np.int64)) for (size, _, _), (n, total) in sums.items()}
    centres = sc.broadcast({size: f.centre for size, f in fits.items()})

    def release(size: int, n: int, total) -> Iterator[list[dict]]:
        for i in range(size):
            yield [partial(size, i, 0, n, total[i, i:])]

    squares = summed(_partials(rows, PARTIAL, lambda size, x: products(x - centres.value[size]), release))
    for size, f in fits.items():
        left = f.left()
        v = np.zeros((size, size))
        for i in range(size):
            for j, t in enumerate(squares[size, i, 0][1], start=i):
                v[i, j] = v[j, i] = (f.n * t - left[i] * left[j]) / (f.n * f.n)  # exact up to this division
        pairs = leading(v, s.components)
        f.trace = float(np.trace(v))
        f.values = np.array([e for e, _, _ in pairs])
        f.vectors = np.array([x for _, x, _ in pairs]).reshape(len(pairs), size).T
    return fits


MOMENTS = StructType([StructField("size", IntegerType()), StructField("i", IntegerType()), StructField("j", IntegerType()), StructField("v", DoubleType())])


def measure(rows: DataFrame, fits: dict[int, Fit]) -> None:
    """Set each fit's `error`: the largest entry of the whitened rows' covariance minus the identity, as measured."""
    held = rows.sparkSession.sparkContext.broadcast(fits)

    def of(size: int, x: np.ndarray) -> np.ndarray:
        w = held.value[size].project(x)
        return np.vstack([w.T @ w, w.sum(0)[None, :]])

    def release(size: int, n: int, total) -> Iterator[list[dict]]:
        k = total.shape[1]
        for i in range(k + 1):
            if k:
                yield [{"size": size, "i": i, "j": j, "v": float(total[i, j])} for j in range(k)]

    got = _partials(rows.select("size", "x"), MOMENTS, of, release).groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect()
    cells: dict[int, dict] = {}
    for r in got:
        cells.setdefault(r["size"], {})[r["i"], r["j"]] = r["v"]
    for size, at in cells.items():
        f, k = fits[size], len(fits[size].values)
        mean = np.array([at[k, j] for j in range(k)]) / f.n
        covariance = np.array([[at[i, j] for j in range(k)] for i in range(k)]) / f.n - np.outer(mean, mean)
        f.error = float(np.abs(covariance - np.eye(k)).max())


def whiten(df: DataFrame, s: Settings = Settings(), *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each sound vector and component.

    Rows whose vector is null or holds null or non-finite entries go; other columns are not read; null ids and rows
    that repeat count like any other. Vectors of one length have a fit of their own. Components end with the length;
    an empty vector has none. A component whose eigenvalue is zero to rounding (fewer different rows than
    components, say) has no direction to scale: whitened is null, explained 0, and identity_error leaves it out.
    Integers beyond 2^48 and deviations beyond a long stay at that bound.
    """
    rows = staged(integers(df, id_col, vector_col, s.scale, s.shift), "vectors")
    fits = fit(rows, s)
    measure(rows, fits)
    held = rows.sparkSession.sparkContext.broadcast(fits)
    schema = StructType([rows.schema["vec_id"], StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for size, at, x in by_size(part):
                    f = held.value[size]
                    k, known = min(s.components, size), len(f.values)
                    whitened = np.full((len(at), k), np.nan)
                    whitened[:, :known] = f.project(x)
                    explained = np.zeros(k)
                    explained[:known] = f.values / f.trace if known else 0
                    rows = len(at) * k
                    yield pa.RecordBatch.from_arrays([
                        part.column("vec_id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                        pa.array(np.full(rows, f.n), pa.int64()), pa.array(np.repeat(np.array(f.deviations(x), dtype=np.int64), k), pa.int64()),
                        pa.array(whitened.reshape(-1), pa.float64(), from_pandas=True), pa.array(np.tile(explained, len(at)), pa.float64()),
                        pa.array(np.full(rows, f.error), pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
