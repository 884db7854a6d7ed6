"""Whitening of embeddings by their leading principal components: block Jacobi-Davidson.

1.  *Fit list.* Vectors become integers, equal ones count once; the list is written as blocks of packed
    integers. Its size n and sums S are exact.
2.  *Products.* The covariance is never formed. A product with a few columns is one Spark job: every
    task centres its blocks, multiplies them with the columns and back, and sends one sum of the
    columns' size; Spark adds these up, and only that many numbers reach the driver.
3.  *Outer iteration.* Rayleigh-Ritz on a small subspace gives Ritz pairs. Pairs whose residual has
    reached double precision are locked, from the largest on, and projected out of everything later.
4.  *Correction equations* ``(I - QQ')(A - t)(I - QQ') x = -r`` of the other wanted pairs (Q: locked
    vectors and the pair's own) are solved by MINRES, all in step, so one product serves all of
    them. Their solutions extend the subspace.
5.  A last Rayleigh-Ritz over the locked vectors; rows are then projected, where they lie.

On the driver are matrices of (dimensions x subspace) only, whatever the number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are left out, and so
are vectors of a length other than the commonest (ties: the shorter) and empty ones. A row without an
id stays, its id null; repeated rows each have their result, and count once in the fit list. A
component without variance cannot be scaled and is not returned, so a fit list of one vector gives no
rows; so does an empty table. Of equal eigenvalues any orthonormal vectors are components. A
deviation beyond 64 bits is an error, never a wrapped number. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import materialize

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4096
EXTRA = 8  # pairs next to the wanted ones, and further columns of the first subspace
GOAL = 0.05
INNER = 4  # MINRES steps for one correction; each is one pass over the fit list
MOST_ROUNDS = 200
_SEED = 20_240_517
_EPS = np.finfo(float).eps

Product = Callable[[np.ndarray], np.ndarray]


def integer_vectors(table: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of every usable row."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.where(F.coalesce(finite & (F.size(v) > 0), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (length.d if length else 0))


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1), np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0))
        for low in range(0, len(x), BLOCK_ROWS):
            part = np.ascontiguousarray(x[low : low + BLOCK_ROWS], "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(part)]), pa.array([part.tobytes()], pa.binary())], ["n", "data"]
            )


class FitList(NamedTuple):
    """The distinct integer vectors, in blocks, with their number and exact sums."""

    blocks: DataFrame
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _added(self, of_block: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all blocks of ``size`` numbers each; ``of_block`` gets centred rows."""
        mean = self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for data in batch.column(0):
                    x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, len(mean))
                    total += of_block(x - mean).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

        parts = self.blocks.select("data").mapInArrow(run, "i long, v double")
        out = np.zeros(size)
        for i, v in parts.groupBy("i").agg(F.sum("v")).collect():
            out[i] = v
        return out

    def product(self, columns: np.ndarray) -> np.ndarray:
        """Covariance times columns."""
        shape = columns.shape
        return self._added(lambda c: c.T @ (c @ columns), columns.size).reshape(shape) / self.n

    def trace(self) -> float:
        return float(self._added(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.n

    def covariance_of(self, projection: np.ndarray) -> np.ndarray:
        """The covariance of ``(x - mean) @ projection``, centred once more."""
        k = projection.shape[1]
        mean = self._added(lambda c: (c @ projection).sum(axis=0), k) / self.n

        def squares(c: np.ndarray) -> np.ndarray:
            y = c @ projection - mean
            return y.T @ y

        return self._added(squares, k * k).reshape(k, k) / self.n


def fit_list(rows: DataFrame) -> FitList | None:
    """The fit list of ``integer_vectors``; None if there is none."""
    blocks = rows.select("x").distinct().mapInArrow(_packed, "n long, data binary")
    blocks = materialize(blocks, "fit-list")
    n = blocks.agg(F.sum("n")).first()[0]
    if not n:
        return None
    sums = _column_sums(blocks, len(rows.first().x))
    return FitList(blocks, n, sums)


def _column_sums(blocks: DataFrame, d: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, d)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(x.sum(axis=0))], ["i", "s"])

    parts = blocks.select("data").mapInArrow(run, "i long, s long")
    return [s for _, s in sorted(map(tuple, parts.groupBy("i").agg(F.sum("s")).collect()))]


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """``new`` made orthonormal to the bases and in itself; columns that vanish are left out."""
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):  # again, as each pass loses digits
            for basis in bases:
                column = column - basis @ (basis.T @ column)
            for other in kept:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-8:
                break
            column = column / size
        else:
            kept.append(column)
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def minres(operator: Callable[[np.ndarray, np.ndarray], np.ndarray], b: np.ndarray, goal: float, most: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column of ``b``, in step: each residual falls
    to ``goal`` times that of zero, or ``most`` steps are done. ``operator(v, which)`` applies the
    systems ``which`` to the columns of ``v``."""
    x = np.zeros_like(b)
    size = np.linalg.norm(b, axis=0)
    which = np.flatnonzero(size > 0)
    v, v_old = b[:, which] / size[which], np.zeros_like(b[:, which])
    w, w_old = np.zeros_like(v), np.zeros_like(v)
    c = c_old = np.ones(len(which))
    s = s_old = np.zeros(len(which))
    beta, eta = size[which], size[which].copy()
    for _ in range(most):
        if not len(which):
            break
        av = operator(v, which)
        alpha = (v * av).sum(axis=0)
        u = av - alpha * v - beta * v_old
        beta_next = np.linalg.norm(u, axis=0)
        diagonal = c * alpha - c_old * s * beta
        length = np.hypot(diagonal, beta_next)
        length = np.where(length > 0, length, 1)
        upper, upper_two = s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old, c, s = c, s, diagonal / length, beta_next / length
        w_old, w = w, (v - upper_two * w_old - upper * w) / length
        x[:, which] += c * eta * w
        eta = -s * eta
        going = (np.abs(eta) > goal * size[which]) & (beta_next > _EPS * size[which])
        v_old, v = v, u / np.where(beta_next > 0, beta_next, 1)
        which, beta, eta = which[going], beta_next[going], eta[going]
        v, v_old, w, w_old = v[:, going], v_old[:, going], w[:, going], w_old[:, going]
        c, c_old, s, s_old = c[going], c_old[going], s[going], s_old[going]
    return x


def leading_pairs(product: Product, d: int, want: int, seed: int = _SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues, falling, and their unit eigenvectors as columns, of the symmetric
    matrix that ``product`` multiplies with."""
    want = min(want, d)
    most_columns = min(d, 8 * (want + EXTRA))
    rng = np.random.default_rng(seed)
    locked, locked_a = np.zeros((d, 0)), np.zeros((d, 0))
    v = _orthonormal(rng.normal(size=(d, min(d, want + EXTRA))))
    w = product(v)
    best, idle = np.inf, 0
    for _ in range(MOST_ROUNDS):
        theta, s = np.linalg.eigh((v.T @ w + w.T @ v) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        v, w = v @ s, w @ s
        scale = max([abs(theta[0]), *np.abs((locked * locked_a).sum(axis=0))])
        r = w - v * theta
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        left = want - locked.shape[1]
        whole = v.shape[1] + locked.shape[1] == d  # nothing is outside the subspace
        tolerance = np.sqrt(d) * _EPS * scale
        idle = 0 if size[:left].max() < best / 2 else idle + 1
        best = min(best, size[:left].max())
        # Products of many rows round: what no longer falls at that level has converged too.
        done = size[:left] <= (64 * d * tolerance if idle >= 4 else tolerance)
        n = left if whole else int(np.argmin(done)) if not done.all() else left
        if n:
            locked, locked_a = np.hstack((locked, v[:, :n])), np.hstack((locked_a, w[:, :n]))
            v, w, r, theta = v[:, n:], w[:, n:], r[:, n:], theta[n:]
            best, idle = np.inf, 0
        left -= n
        if not left:
            break
        if v.shape[1] + left > most_columns - locked.shape[1] and not whole:
            v, w, r, theta = (a[..., : left + EXTRA] for a in (v, w, r, theta))
        # Pairs next to the wanted ones are corrected too: they are what slows these down.
        wide = min(left + EXTRA, v.shape[1])
        u, shift = v[:, :wide], theta[:wide]

        def projected(x: np.ndarray, which: np.ndarray) -> np.ndarray:
            x = x - locked @ (locked.T @ x)
            return x - u[:, which] * (u[:, which] * x).sum(axis=0)

        def operator(x: np.ndarray, which: np.ndarray) -> np.ndarray:
            x = projected(x, which)
            return projected(product(x) - shift[which] * x, which)

        every = np.arange(wide)
        step = minres(operator, projected(-r[:, :wide], every), GOAL, INNER)
        new = _orthonormal(projected(step, every), locked, v)
        if not new.shape[1]:
            new = _orthonormal(rng.normal(size=(d, 1)), locked, v)
        if new.shape[1]:
            v, w = np.hstack((v, new)), np.hstack((w, product(new)))
    else:
        raise ArithmeticError("the residuals did not reach double precision")
    q, a = locked, locked_a
    theta, s = np.linalg.eigh((q.T @ a + a.T @ q) / 2)
    vectors = q @ s[:, ::-1]
    return theta[::-1], vectors / np.linalg.norm(vectors, axis=0)


class Whitening(NamedTuple):
    """A fitted whitening."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # as columns
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = _SEED) -> Whitening | None:
    """Fits ``integer_vectors``; None if there is nothing to fit."""
    fitted = fit_list(rows)
    if fitted is None:
        return None
    d, trace = len(fitted.sums), fitted.trace()
    if trace == 0:
        return Whitening(fitted.n, fitted.sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)
    values, vectors = leading_pairs(fitted.product, d, components, seed)
    varies = values > d * _EPS * trace
    values, vectors = values[varies], vectors[:, varies]
    spread = fitted.covariance_of(vectors / np.sqrt(values))
    error = float(np.abs(spread - np.eye(len(values))).max())
    return Whitening(fitted.n, fitted.sums, values, vectors, values / trace, error)


def transform(rows: DataFrame, whitening: Whitening) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    mean = np.array([s / whitening.n for s in whitening.sums])
    projection = whitening.vectors / np.sqrt(whitening.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = (_matrix(batch.column(2)) - mean) @ projection if batch.num_rows else np.zeros((0, 1))
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(0, y.size + 1, max(y.shape[1], 1)), pa.int32()), pa.array(y.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), flat], ["vec_id", "deviation", "y"]
            )

    projected = rows.select("vec_id", _deviation(whitening).alias("deviation"), "x")
    projected = projected.mapInArrow(run, "vec_id long, deviation long, y array<double>")
    each = projected.select("vec_id", "deviation", F.posexplode("y").alias("i", "whitened"))
    shares = F.array(*[F.lit(float(e)) for e in whitening.explained])
    return each.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(whitening.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("i") + 1).alias("explained"),
        F.lit(whitening.identity_error).alias("identity_error"),
    )


def _deviation(whitening: Whitening) -> Column:
    """The sum of ``(n x - S)^2``, exact: decimals of 38 digits, then a checked cast."""
    n, wide = F.lit(whitening.n).cast("decimal(19,0)"), "decimal(19,0)"
    sums = F.array(*[F.lit(s).cast(wide) for s in whitening.sums])
    differences = F.zip_with(
        "x", sums, lambda x, s: (x.cast(wide) * n - s).cast(wide)
    )
    squares = F.transform(differences, lambda e: (e * e).cast("decimal(38,0)"))
    total = F.aggregate(
        squares, F.lit(0).cast("decimal(38,0)"), lambda t, e: (t + e).cast("decimal(38,0)")
    )
    return total.cast("long")


def whiten(
    table: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    seed: int = _SEED,
) -> DataFrame:
    """One row per usable row of ``table`` and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``."""
    rows = integer_vectors(table, vec_id, vector, scale)
    whitening = fit(rows, components, seed)
    if whitening is None or not len(whitening.values):
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], schema)
    return transform(rows, whitening)
