"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, and each distinct vector counts once in the fit.  With the
centred rows as a matrix A (divided by the root of their number), products A v and A'u
alternate and give A V = U B, V and U with orthonormal columns and B upper bidiagonal.  The
singular vectors of B lead to the components, its singular values to the deviations.

A left vector has one entry per row, so it is never stored: it is A w for a short vector w
that the driver knows, and a pass makes the rows' entries of all left vectors again.  One
pass gives A v, its products with all earlier left vectors and A'(A v) at once; both sides
are reorthogonalised in full, with a second pass where much was taken away.  Passes send a
task's sums of at most 2 d numbers, added up by Spark; the driver holds d x d matrices.

The iteration ends when the wanted singular triplets stand still and the variance not yet
explored is less than the least wanted eigenvalue, so that none can have been missed (an
eigenvalue that occurs several times shows only one of its vectors from one start); or
with d steps, when V is a whole basis.  A direction that ends early (no rest to go on with)
is followed by a new one, orthogonal to all before.

Defined cases: rows whose vector is null, holds nulls or non-finite entries, entries beyond
``LARGEST``, or is shorter than the longest other are left out; null and repeated ids are
rows like any other; components of no deviation cannot be whitened and are left out, so a
table of no rows, of one vector, or of empty vectors has no result; of a component and its
negative, the one whose largest entry is positive is taken; a deviation too large for a long
is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000        # fixed values
LARGEST = float(1 << 40)             # of an entry's size: whole numbers beyond it are not exact
STILL = 4 * np.finfo(float).eps      # of the largest singular value: a triplet's rest that counts as none
NO_RANK = 1e-9                       # of the largest singular value: below it, rounding is all there is
ROWS = 4096                          # rows to a matrix in a task


@dataclass
class Fit:
    n: int
    sums: np.ndarray                 # long, per dimension
    components: np.ndarray           # d x k, unit columns
    eigenvalues: np.ndarray          # k, falling
    trace: float
    identity_error: float


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """The rows whose vector has no null, non-finite or too large entry, with it as array<double> ``c``."""
    c = F.col(f"`{vector_col}`").cast("array<double>")
    fine = c.isNotNull() & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= LARGEST))
    return vectors.withColumn("c", F.when(fine, c)).where("c is not null")


def whole(c: Column) -> Column:
    return F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + OFFSET)


def matrices(batches, column: int, d: int):
    """Batches of vectors as matrices of longs, few rows at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.column(column).slice(k, ROWS)
            yield k, batch, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def summed(fit: DataFrame, d: int, of, kind: str = "double") -> np.ndarray:
    """The sum over the fit's matrices of the vector that ``of`` makes of one."""
    arrow = pa.float64() if kind == "double" else pa.int64()

    def run(batches):
        total = None
        for _, _, x in matrices(batches, 0, d):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total, arrow)], ["at", "value"])

    rows = fit.mapInArrow(run, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    order = np.argsort(np.asarray(rows["at"]))
    return np.asarray(rows["value"])[order]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less its mean: exact up to the last division."""
    return (n * x - sums) / n


def bidiagonalised(product, d: int, wanted: int, trace: float, seed: int = 0):
    """(V, alphas, betas, rest).  ``product(w, W)`` returns, for u = A w, the norm of u
    squared, (A W)'u and A'u; ``trace`` is the sum of the squares of A."""
    rng, scale = np.random.default_rng(seed), np.sqrt(max(trace, 0.0))
    V, W, Z = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))     # right vectors, left ones as A w, and A'(A w)
    alphas, betas = [], []

    def fresh():
        v = rng.standard_normal(d)
        for _ in range(2):
            v -= V @ (V.T @ v)
        return v / np.linalg.norm(v)

    v = fresh()
    for step in range(d):
        V = np.column_stack([V, v])
        w = v - (betas[-1] * W[:, -1] if betas else 0)
        for _ in range(3):
            square, along, z = product(w, W)
            w, z = w - W @ along, z - Z @ along
            rest = square - along @ along
            if rest >= 0.5 * square:                                   # little was taken away
                break
        alpha = np.sqrt(max(rest, 0.0))
        if alpha <= STILL * scale:                                     # A v lies among the left vectors that are there
            alpha, w, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, z = w / alpha, z / alpha
        alphas.append(alpha)
        W, Z = np.column_stack([W, w]), np.column_stack([Z, z])
        r = z - alpha * v
        for _ in range(2):
            r -= V @ (V.T @ r)
        beta = np.linalg.norm(r)
        if beta <= STILL * scale:
            beta = 0.0
        if step + 1 == d or settled(alphas, betas, beta, wanted, trace):
            break
        v = r / beta if beta else fresh()
        betas.append(beta)
    return V, np.array(alphas), np.array(betas)


def settled(alphas, betas, beta: float, wanted: int, trace: float) -> bool:
    """Do the first ``wanted`` singular triplets stand, and can none have been missed?"""
    if len(alphas) < wanted:
        return False
    P, s, _ = np.linalg.svd(bidiagonal(alphas, betas))
    unexplored = trace - (np.square(alphas).sum() + np.square(betas).sum())
    return bool((beta * np.abs(P[-1, :wanted]) <= STILL * s[0]).all() and unexplored <= s[wanted - 1] ** 2 * 0.99)


def bidiagonal(alphas, betas) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1)


def fitted(fit: DataFrame, d: int, wanted: int = COMPONENTS) -> Fit | None:
    """The components of the ``fit`` list (one column of array<long>, all of length ``d``)."""
    n = fit.count()
    if n == 0 or d == 0:
        return None
    sums = summed(fit, d, lambda x: x.sum(0, dtype=np.int64), "long")
    trace = float(summed(fit, d, lambda x: np.array([np.square(centred(x, n, sums)).sum()]))[0]) / n
    if trace == 0:
        return None

    def product(w, W):
        vectors = np.column_stack([w, W])

        def of(x):
            a = centred(x, n, sums)
            u = a @ vectors
            return np.concatenate([u[:, 0] @ u, u[:, 0] @ a])

        out = summed(fit, d, of) / n
        return out[0], out[1:vectors.shape[1]], out[vectors.shape[1]:]

    V, alphas, betas = bidiagonalised(product, d, min(wanted, d), trace)
    _, s, Qt = np.linalg.svd(bidiagonal(alphas, betas))
    k = min(wanted, int((s > NO_RANK * s[0]).sum()))
    found = V @ Qt[:k].T
    found = found / np.linalg.norm(found, axis=0)
    found = found * np.sign(found[np.abs(found).argmax(0), np.arange(k)])

    def moments(x):
        y = centred(x, n, sums) @ found / s[:k]
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    # The rows are centred, so the means are rounding errors; their product is taken off for form.
    out = summed(fit, d, moments) / n
    covariance = out[k:].reshape(k, k) - np.outer(out[:k], out[:k])
    return Fit(n, sums, found, np.square(s[:k]), trace, float(np.abs(covariance - np.eye(k)).max()))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Per row, the sum of (n x - S) squared, exact; null where a long cannot hold it."""
    y = n * x - sums
    if (np.square(y.astype(float)).sum(1) < 2.0 ** 62).all():
        return np.square(y).sum(1).tolist()
    exact = (sum(e * e for e in row) for row in y.tolist())
    return [e if e < 1 << 63 else None for e in exact]


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error."""
    rows = usable(vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector")), "vector")
    rows = written(rows.select("vec_id", whole(F.col("c")).alias("x")), "white-rows")
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.where(F.size("x") == d)
    fit = written(rows.select("x").distinct(), "white-fit")
    model = fitted(fit, d, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.eigenvalues)
    projection, share = model.components / np.sqrt(model.eigenvalues), model.eigenvalues / model.trace

    def run(batches):
        for at, batch, x in matrices(batches, 1, d):
            m = len(x)
            ids = batch.column(0).slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
            far = pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.record_batch([ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), far,
                                   pa.array((centred(x, model.n, model.sums) @ projection).ravel()), pa.array(np.tile(share, m)),
                                   pa.array(np.full(m * k, model.identity_error))], [f.split()[0] for f in schema.split(", ")])

    return rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(run, schema)
