"""Embedding whitening by LOBPCG over distributed covariance-block products.

Entries become whole numbers, x = floor(scale * c) + offset, so that counts, sums and sums of squares are exact whatever the order of
tasks. The covariance (divisor n) is never formed: each step asks Spark for its product with a block of a few columns. A task centres its rows,
(n x - S) / n from exact numerators, multiplies a batch of them by the block and the result by the batch again, and sends one row for each dimension.
Only blocks of dimension x columns pass the driver or are shipped with a task; nothing there grows with the rows. Every product is a job of its own
that reads the table again, so a lost executor costs the batches it held.

LOBPCG keeps an iterate X, its residuals W and its previous directions P. All three are kept orthonormal by turns: products of X and P follow from
coordinates of the last basis, which loses no digits, and only W's product needs a pass. A Rayleigh-Ritz step on the basis [X P W] gives the next X. When the residuals of
the wanted columns are small enough, a certifying pass takes their products from the rows anew, together with the covariance of the whitened rows;
only residuals of that pass let the fit end. A block has guard columns beside the wanted ones; where basis and dimension meet, the step is exact.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are those of another length than most rows have (of
two lengths as frequent the longer stays). Whole numbers saturate at +-2^46. There are at most as many components as the covariance has directions: one
whose eigenvalue is below the dimension times 2^-52 of the largest has nothing to divide by and is left out, so equal vectors only, or one row, give none.
Rows that repeat count as often as they occur. ``deviation`` is a decimal, null beyond 38 digits. An empty table gives no rows. Extra columns stay, those named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspar.llm.common import free_name

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Columns of a block beside the wanted ones, the residual (of the largest eigenvalue) that ends the fit, and the most steps.
GUARD, TOLERANCE, STEPS = 16, 1e-12, 500
_LIMIT = 1 << 46
_SAFE = 1 << 62


@dataclass(frozen=True)
class Fit:
    """n rows with per-dimension sums; the columns of vectors are components of falling eigenvalue; largest residual of a component relative to the first eigenvalue; passes made."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    residual: float
    identity_error: float
    passes: int
    scale: int = SCALE
    offset: int = OFFSET


def whole(c: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.clip(np.floor(c * float(scale)), -_LIMIT, _LIMIT).astype(np.int64) + offset


def _rows_of(column: pa.Array, dim: int, scale: int, offset: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim), scale, offset)


def numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exact: in 64 bits where these hold it, else in Python's integers."""
    if not x.size:
        return x
    if n * int(np.abs(x).max()) + max(map(abs, sums)) < _SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (numerators(x, n, sums) / n).astype(np.float64)


def valid(df: DataFrame, vector_col: str) -> DataFrame:
    """The rows with a vector of finite entries."""
    infinite = float("inf")
    finite = F.forall(F.col(vector_col), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < infinite))
    return df.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(finite)


def _moments(rows: DataFrame, dim: int, scale: int, offset: int) -> tuple[int, list[int], list[int]]:
    """n, and the exact sums of entries and of their squares by dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, [0] * dim, [0] * dim
        for b in batches:
            x = _rows_of(b.column(0), dim, scale, offset)
            if not len(x):
                continue
            n += len(x)
            small = int(np.abs(x).max()) ** 2 * len(x) < _SAFE
            own = x if small else x.astype(object)
            s = [a + int(v) for a, v in zip(s, own.sum(axis=0), strict=True)]
            q = [a + int(v) for a, v in zip(q, (own * own).sum(axis=0), strict=True)]
        if n:
            # Decimals of 38 digits hold squares of 2^46 over 10^10 rows.
            at = pa.array(range(dim), pa.int32())
            yield pa.RecordBatch.from_pydict({"at": at, "n": pa.array([n] * dim, pa.int64()), "s": pa.array([str(v) for v in s]), "q": pa.array([str(v) for v in q])})

    parts = rows.mapInArrow(partial, "at int, n bigint, s string, q string")
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.col("q").cast("decimal(38,0)")).alias("q")).orderBy("at").collect()
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found], [int(r["q"]) for r in found]


def _summed(rows: DataFrame, dim: int, width: int, part) -> np.ndarray:
    """Sum over all rows of part(batch), a matrix of width columns: one row of it for each task and matrix row, added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = part(b.column(0))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(total)), pa.int32()), "v": pa.array(list(total), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(partial, "at int, v array<double>")
    found = parts.groupBy("at").agg(F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(width)]).alias("v")).orderBy("at").collect()
    return np.array([r["v"] for r in found], np.float64).reshape(-1, width)


def _orthonormal(block: np.ndarray, against: np.ndarray | None = None) -> np.ndarray:
    """An orthonormal basis of what block's columns add to those of against, without directions that are rounding only."""
    kept = []
    for _ in range(2):  # once more, as the first pass leaves rounding where columns nearly cancel
        if against is not None and against.size:
            block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        if not block.shape[1]:
            return block
        left, size, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, size > 1e-10 * size[0]]
        kept.append(block.shape[1])
    return block


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, guard: int = GUARD, tolerance: float = TOLERANCE, steps: int = STEPS) -> tuple[DataFrame, Fit | None]:
    """The rows that take part, and their principal components (None without rows). Raises RuntimeError if ``steps`` don't certify them."""
    lengths = valid(df, vector_col).groupBy(F.size(vector_col).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return valid(df, vector_col), None
    dim = lengths["dim"]
    used = valid(df, vector_col).filter(F.size(vector_col) == dim)
    rows = used.select(vector_col)
    n, s, q = _moments(rows, dim, scale, offset)
    sums, passes = tuple(s), 2
    trace = float(sum(n * b - a * a for a, b in zip(s, q, strict=True))) / n / n
    found = _lobpcg(rows, dim, n, sums, trace, components, scale, offset, guard, tolerance, steps)
    vectors, values, residual, error, more = found
    return used, Fit(n, sums, vectors, values, values / trace if trace else values, residual, error, passes + more, scale, offset)


def _lobpcg(rows, dim, n, sums, trace, components, scale, offset, guard, tolerance, steps):
    empty = np.zeros((dim, 0))
    if trace <= 0 or components < 1:
        return empty, np.zeros(0), 0.0, 0.0, 0
    passes = 0

    def product(block: np.ndarray) -> np.ndarray:
        """The covariance times block: one pass over the rows."""
        nonlocal passes
        passes += 1
        if not block.shape[1]:
            return block

        def part(column):
            a = centred(_rows_of(column, dim, scale, offset), n, sums)
            return a.T @ (a @ block)

        return _summed(rows, dim, block.shape[1], part) / n

    def certified(block: np.ndarray, values: np.ndarray):
        """Fresh products of block, mean and covariance of the whitened rows: one pass."""
        nonlocal passes
        passes += 1
        m = block.shape[1]

        def part(column):
            a = centred(_rows_of(column, dim, scale, offset), n, sums)
            y = a @ block
            w = y / np.sqrt(values)
            return np.vstack([a.T @ y, w.T @ w, w.sum(axis=0)[None, :]])

        total = _summed(rows, dim + m + 1, m, part) / n
        mean = total[-1]
        return total[:dim], total[dim:-1] - np.outer(mean, mean)

    width = min(dim, components + guard)
    x = _orthonormal(np.random.default_rng(0).standard_normal((dim, width)))
    ax = product(x)
    p, ap = empty, empty
    for _ in range(steps):
        # Ritz vectors of X first: residuals mean nothing before.
        values, turn = _ritz(x, ax)
        x, ax = x @ turn, ax @ turn
        residual = ax - x * values
        wanted = min(components, int((values > dim * 2.0**-52 * values[0]).sum()))
        left = np.linalg.norm(residual[:, :wanted], axis=0) / values[0]
        basis = np.hstack([x, p])
        if left.max() <= tolerance:
            fresh, covariance = certified(x[:, :wanted], values[:wanted])
            values_now = np.einsum("ij,ij->j", x[:, :wanted], fresh)
            sure = float((np.linalg.norm(fresh - x[:, :wanted] * values_now, axis=0) / values_now[0]).max())
            if sure <= tolerance:
                return x[:, :wanted], values[:wanted], sure, float(np.abs(covariance - np.eye(wanted)).max()), passes
            ax[:, :wanted] = fresh
            residual = ax - x * values
        w = _orthonormal(residual, basis)
        if not w.shape[1] and left.max() > tolerance:  # the residuals are rounding within the basis: other directions may be left
            w = _orthonormal(np.random.default_rng(passes).standard_normal((dim, width)), basis)
        aw = product(w)
        q, aq = np.hstack([basis, w]), np.hstack([ax, ap, aw])
        _, turn = _ritz(q, aq)
        first = turn[:, :width]
        # The step's own directions: what the new iterate has outside the old one, in coordinates of the basis.
        beside = first.copy()
        beside[:width] = 0
        other = _orthonormal(beside, first)
        x, ax, p, ap = q @ first, aq @ first, q @ other, aq @ other
    raise RuntimeError(f"residuals of {left.max():.1e} after {steps} steps, {tolerance:.1e} wanted")


def _ritz(basis: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and coordinates of the Ritz vectors in an orthonormal basis."""
    small = basis.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], turn[:, ::-1]


RESULT = ["deviation", "whitened"]


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, **settings) -> tuple[DataFrame, Fit | None]:
    """The rows that take part with ``deviation`` (decimal, sum over dimensions of (n x - S)^2) and ``whitened`` (one double for each component), and the fit.

    A narrow pass: rows are neither shuffled nor joined.
    """
    used, model = fit(df, vector_col, components, **settings)
    added = free_name(df, "whitening_found")
    kept = [f"`{c}`" for c in df.columns if c.lower() not in RESULT]
    if model is None:
        empty = used.limit(0).select(*kept, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
        return empty, None
    dim, back = len(model.sums), model.vectors / np.sqrt(model.values)

    @F.arrow_udf("deviation string, whitened array<double>")
    def projected(vectors: pa.Array) -> pa.Array:
        x = _rows_of(vectors, dim, model.scale, model.offset)
        parts = numerators(x, model.n, model.sums)
        most = int(np.abs(parts).max()) if parts.size else 0
        wide = parts if most * most * dim < _SAFE else parts.astype(object)
        deviation = [str(v) if v < 10**38 else None for v in map(int, (wide * wide).sum(axis=1))]
        whitened = (parts / model.n).astype(np.float64) @ back
        return pa.StructArray.from_arrays([pa.array(deviation, pa.string()), pa.array(list(whitened), pa.list_(pa.float64()))], ["deviation", "whitened"])

    out = used.withColumn(added, projected(F.col(vector_col)))
    return out.select(*kept, F.col(added)["deviation"].cast("decimal(38,0)").alias("deviation"), F.col(added)["whitened"].alias("whitened")), model
