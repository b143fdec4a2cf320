"""Operator 12: whitening of embeddings by a block Jacobi-Davidson method.

The covariance is never formed.  A product with a block of vectors is a Spark job:
every task centres its rows (exactly, in integers), multiplies them with the block
and back, and the partial sums meet by dimension.  On the driver lie only bases:
dimension x (a few times the number of components) doubles, whatever the rows.

* Rayleigh-Ritz in the subspace gives Ritz vectors and residuals;
* leading Ritz vectors whose residual reached double precision are locked;
* the others' correction equations, projected against locked and Ritz vectors, are
  solved by MINRES, all at once, so an inner step is one job for the whole block;
* the corrections widen the subspace, which restarts from its leading part when
  it has grown too large.

It ends when as many vectors as wanted are locked and no Ritz value of the rest
lies above them; a product anew then checks every residual.

Vectors that are null, hold null or non-finite entries, or have not the commonest
length (of equally common ones the longest) are dropped.  Repeated rows count as
often as they occur; ids are carried as they are, null too.  Components without
variance (an eigenvalue that the residuals' tolerance does not tell from 0) can't
be whitened and are left out, so equal vectors, one vector or none give no rows.
Figures beyond 64 bits raise ArithmeticError."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import stage

#: Components, and vectors that the block has besides.
COMPONENTS, GUARDS = 32, 8
#: MINRES steps for a correction at most, and the part of a residual at which they end.
INNER, RELATIVE = 10, 0.01
#: The subspace restarts beyond this many blocks.
BLOCKS = 4
#: Outer steps without a vector locked after which the method gives up with an error.
PATIENCE = 100
#: Eigenvalues below this many times the tolerance count as 0.
LEAST = 1e4
SEED = 20240229

Product = Callable[[np.ndarray], np.ndarray]


def integers(emb: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that stay, staged, and their length."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    kept = emb.filter(v.isNotNull()).filter(~F.coalesce(bad, F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * 64) + F.lit(1_000_000).cast("long"))
    rows = stage(kept.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")))
    first = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = first["d"] if first else 0
    return rows.filter(F.size("x") == d), d


def matrix(part: pa.RecordBatch, d: int, column: int = 0) -> np.ndarray:
    return part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def summed(rows: DataFrame, block: Callable[[np.ndarray], np.ndarray], d: int, height: int, width: int) -> np.ndarray:
    """Sum over all tasks of ``block(x)``, a height x width matrix of doubles, for the rows' x."""
    names = ["i", *[f"v{j}" for j in range(width)]]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for part in parts:
            for k in range(0, part.num_rows, 4096):
                total += block(matrix(part.slice(k, 4096), d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), *map(pa.array, np.ascontiguousarray(total.T))], names)

    schema = "i int, " + ", ".join(f"{n} double" for n in names[1:])
    out = np.zeros((height, width))
    for i, *values in rows.select("x").mapInArrow(run, schema).groupBy("i").agg(*[F.sum(n) for n in names[1:]]).collect():
        out[i] = values
    return out


def totals(rows: DataFrame, d: int) -> tuple[int, int, np.ndarray]:
    """Number of tasks and rows, and exact sums of each dimension."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64), 0
        for part in parts:
            total, n = total + matrix(part, d).sum(axis=0), n + part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, d)), pa.array(np.concatenate([[1, n], total]))], ["i", "s"])

    found = dict(rows.select("x").mapInArrow(run, "i long, s long").groupBy("i").agg(F.sum("s")).collect())
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(i, 0) for i in range(d)], np.int64)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, each entry correctly rounded but for one division."""
    return (n * x - sums) / n


def minres(apply: Product, b: np.ndarray, steps: int = INNER, relative: float = RELATIVE) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, all in step."""
    x, w, w_old, v_old = (np.zeros_like(b) for _ in range(4))
    gamma = np.linalg.norm(b, axis=0)
    start = np.where(gamma > 0, gamma, 1.0)
    v, eta = b / start, gamma.copy()
    s_old, s = np.zeros_like(gamma), np.zeros_like(gamma)
    c_old, c, norm = np.ones_like(gamma), np.ones_like(gamma), np.zeros_like(gamma)
    for _ in range(steps):
        if (np.abs(eta) <= relative * start).all():
            break
        a = apply(v)
        delta = (a * v).sum(axis=0)
        a = a - delta * v - gamma * v_old
        after = np.linalg.norm(a, axis=0)
        a0 = c * delta - c_old * s * gamma
        a1 = np.hypot(a0, after)
        a2, a3 = s * delta + c_old * c * gamma, s_old * gamma
        norm = np.maximum(norm, np.hypot(delta, after))
        live = a1 > 1e-14 * norm
        a1 = np.where(live, a1, 1.0)
        c_old, c, s_old, s = c, np.where(live, a0 / a1, 1.0), s, np.where(live, after / a1, 0.0)
        w_old, w = w, np.where(live, (v - a3 * w_old - a2 * w) / a1, 0.0)
        x = x + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, 0.0)
        v_old, v, gamma = v, np.where(live & (after > 0), a / np.where(after > 0, after, 1.0), 0.0), after
    return x


def outside(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``t`` adds to the orthonormal ``bases``."""
    against = np.hstack(bases)
    t = t / np.maximum(np.linalg.norm(t, axis=0), 1e-300)
    for _ in range(2):
        t = t - against @ (against.T @ t)
    left, size, _ = np.linalg.svd(t, full_matrices=False)
    t = left[:, size > 1e-10]
    t = t - against @ (against.T @ t)
    return np.linalg.qr(t)[0][:, : max(0, len(t) - against.shape[1])]


def eigenpairs(product: Product, d: int, wanted: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a symmetric
    operator, by Jacobi-Davidson; residuals at most ``tolerance`` of the largest."""
    wanted = min(wanted, d)
    width = min(d, wanted + GUARDS)
    rng = np.random.default_rng(SEED)
    basis = np.linalg.qr(rng.normal(size=(d, width)))[0]
    image = product(basis)
    locked, values = np.empty((d, 0)), np.empty(0)
    scale, idle = 0.0, 0
    while True:
        theta, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        basis, image = basis @ y, image @ y
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        scale = max(scale, theta[0] if len(theta) else 0.0, values.max(initial=0.0))
        if scale <= 0:
            return np.zeros(wanted), np.linalg.qr(rng.normal(size=(d, wanted)))[0]
        enough = size <= tolerance * scale
        lead = len(enough) if enough.all() else int(np.argmin(enough))
        least_locked = np.sort(values)[::-1][wanted - 1] if len(values) >= wanted else -math.inf
        lead = min(lead, max(wanted - len(values), int((theta > least_locked + tolerance * scale).sum())))
        locked, values = np.hstack([locked, basis[:, :lead]]), np.concatenate([values, theta[:lead]])
        basis, image, theta, residual, size = basis[:, lead:], image[:, lead:], theta[lead:], residual[:, lead:], size[lead:]
        if len(values) >= wanted and (not len(theta) or theta[0] <= np.sort(values)[::-1][wanted - 1] + tolerance * scale):
            break
        idle = 0 if lead else idle + 1
        if idle >= PATIENCE:
            raise ArithmeticError(f"residuals stay above {tolerance:.1e} of the largest eigenvalue")
        if basis.shape[1] > BLOCKS * width:
            basis, image = basis[:, : 2 * width], image[:, : 2 * width]
        if locked.shape[1] + basis.shape[1] >= d:  # nothing to widen: the same space with products anew
            basis = np.linalg.qr(basis - locked @ (locked.T @ basis))[0]
            image = product(basis)
            continue
        ritz, shift = basis[:, :width], theta[:width]
        inner = np.hstack([locked, ritz])
        project = lambda t: t - inner @ (inner.T @ t)  # noqa: E731, B023

        def corrected(t: np.ndarray) -> np.ndarray:
            t = project(t)  # noqa: B023
            return project(product(t) - t * shift)  # noqa: B023

        new = outside(minres(corrected, -project(residual[:, :width])), locked, basis)
        if not new.shape[1]:
            new = outside(rng.normal(size=(d, width)), locked, basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    order = np.argsort(-values, kind="stable")[:wanted]
    values, locked = values[order], locked[:, order]
    size = np.linalg.norm(product(locked) - locked * values, axis=0)
    if (size > 8 * tolerance * scale).any():
        raise ArithmeticError("a locked vector lost its precision")
    return values, locked


def whitened(emb: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector that stays and component: (vec_id, component, n, deviation,
    whitened, explained, identity_error, eigenvalue).  The largest entry of each
    eigenvector is positive."""
    spark = emb.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"
    rows, d = integers(emb, vec_id, vector)
    tasks, n, sums = totals(rows, d) if d else (0, 0, np.empty(0, np.int64))
    if not n:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast((n, sums))
    centre = lambda x: centred(x, *shared.value)
    width = min(d, min(components, d) + GUARDS)

    def product(u: np.ndarray) -> np.ndarray:
        columns = u.shape[1]
        u, out = np.hstack([u, np.zeros((d, -columns % width))]), []
        for k in range(0, u.shape[1], width):  # blocks of one width: one compiled plan
            part = spark.sparkContext.broadcast(np.ascontiguousarray(u[:, k : k + width]))
            out.append(summed(rows, lambda x, part=part: (c := centre(x)).T @ (c @ part.value), d, d, width) / n)
            part.unpersist()
        return np.hstack(out)[:, :columns]

    trace = summed(rows, lambda x: np.square(centre(x)).sum(axis=0)[:, None], d, d, 1).sum() / n
    tolerance = np.finfo(float).eps * (d + tasks)
    values, vectors = eigenpairs(product, d, components, tolerance)
    real = values > LEAST * tolerance * values.max()
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    scaled = spark.sparkContext.broadcast(vectors * np.sign(top) / np.sqrt(values))
    k = len(values)
    mean = summed(rows, lambda x: (centre(x) @ scaled.value).sum(axis=0)[:, None], d, k, 1)[:, 0] / n
    cov = summed(rows, lambda x: (z := centre(x) @ scaled.value - mean).T @ z, d, k, k) / n
    error, share = float(np.abs(cov - np.eye(k)).max()), values / trace

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = shared.value
        for part in parts:
            for at in range(0, part.num_rows, 4096):
                piece = part.slice(at, 4096)
                x, m = matrix(piece, d, 1), min(4096, part.num_rows - at)
                gap = n * x - sums
                if (np.square(gap.astype(float)).sum(axis=1) >= 9.2e18).any():
                    raise ArithmeticError("a deviation needs more than 64 bits")
                ids = piece.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                deviation = np.repeat(np.square(gap).sum(axis=1), k)
                every = [np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), deviation, (gap / n @ scaled.value).ravel()]
                every += [np.tile(share, m), np.full(m * k, error), np.tile(values, m)]
                names = [f.split(" ")[0] for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, every)], names)

    return rows.select("vec_id", "x").mapInArrow(run, schema)
