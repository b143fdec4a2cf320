"""Active weights under a factor risk model (P6 with exposures and covariances).

Risk is low rank plus diagonal: Sigma = X F X' + D, with a cross-section's factor
exposures X, the day's factor covariance F and the specific variances D.  By Woodbury's
identity all that Sigma's inverse needs of the assets are sums over them:

    M = Z' D^-1 Z,   Z = [X | 1 | beta | alpha]

so a cross-section of any size is a partial aggregate of (K + 3)^2 figures.  They give
the weights' coefficients per cross-section,

    w = D^-1 (alpha - A nu - X g),   A nu from  A' Sigma^-1 (alpha - A nu) = 0,

with A the signal's constraint set (1'w = 0, and beta'w = 0 where asked), scaled to
w' Sigma w = target^2.  The assets then take their weights row by row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a cross-section that are added up at once in a task, at most.
CELLS = 4_000_000


def _schema(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def weighted_moments(rows: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """(by, cell, v): upper cells i * width + j of Z' D^-1 Z for rows (by, z, iv)."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step := max(1, CELLS // len(i))):
                b = whole.slice(at, step)
                z = b.column(len(by)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                iv = b.column(len(by) + 1).to_numpy(zero_copy_only=False)
                keys = pa.Table.from_batches([b]).select(list(by)).to_pandas()
                code, first = pd.factorize(pd.MultiIndex.from_frame(keys))[0], None
                order = np.argsort(code, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0])
                m = np.stack([(z[o] * iv[o, None]).T @ z[o] for o in np.split(order, edges[1:])])
                first = pa.array(np.repeat(order[edges], len(i)))
                keyed = [b.column(k).take(first) for k in range(len(by))]
                cells = [pa.array(np.tile((i * width + j).astype(np.int32), len(edges))), pa.array(m[:, i, j].ravel())]
                yield pa.RecordBatch.from_arrays([*keyed, *cells], [*by, "cell", "v"])

    each = rows.select(*by, "z", "iv").mapInArrow(run, f"{_schema(rows, by)}, cell int, v double")
    return each.groupBy(*by, "cell").agg(F.sum("v").alias("v"))


def coefficients(m: np.ndarray, f: np.ndarray, n: int, zero_beta: bool, target: float) -> np.ndarray:
    """What the columns of Z are weighed with, from one cross-section's moments ``m`` and
    factor covariance ``f``; zeros where no asset is free or no risk is left."""
    k = len(f)
    held = [k, k + 1] if zero_beta else [k]
    if n <= len(held):
        return np.zeros(k + 3)
    u = [*held, k + 2]
    g = np.linalg.solve(np.eye(k) + f @ m[:k, :k], f @ m[:k, u]) if k else np.zeros((0, len(u)))
    q = m[np.ix_(u, u)] - m[np.ix_(u, range(k))] @ g  # u' Sigma^-1 v
    nu = np.linalg.lstsq(q[:-1, :-1], q[:-1, -1], rcond=1e-12)[0]
    risk2 = q[-1, -1] - nu @ q[:-1, -1]
    if not risk2 > 1e-14 * abs(q[-1, -1]):
        return np.zeros(k + 3)
    out = np.zeros(k + 3)
    out[:k] = -(g[:, -1] - g[:, :-1] @ nu)
    out[held] = -nu
    out[k + 2] = 1.0
    return out * target / np.sqrt(risk2)


def factor_active_weights(panel: DataFrame, exposures: DataFrame, covariances: DataFrame, factors: Sequence[str],
                          by: Sequence[str] = ("date",), zero_beta: bool | Column = True, target_risk: float = 0.05,
                          alpha: str = "alpha", beta: str = "predicted_beta", risk: str = "specific_risk",
                          out: str = "weight") -> DataFrame:
    """``panel`` (by, date, barrid, alpha, beta, risk) with column ``out``.

    ``exposures``: (date, barrid, one column per factor), missing ones are 0.
    ``covariances``: (date, factor, one column per factor); only the factors listed
    count, a missing entry is 0, a day without any has specific risk only.
    ``zero_beta``: the constraint set, for all or by a boolean Column that is the same
    throughout a cross-section (a signal's).  Rows without alpha, beta or a positive
    risk get no weight (NULL)."""
    by, factors = list(by), list(factors)
    k, zero = len(factors), F.lit(0.0)
    cols = panel.columns
    x = exposures.select("date", "barrid", F.array(*[F.coalesce(F.col(c).cast("double"), zero) for c in factors]).cast("array<double>").alias("_x"))
    none = F.array(*[zero] * k).cast("array<double>")
    own = F.array(F.lit(1.0), F.col(beta), F.col(alpha)).cast("array<double>")
    zb = zero_beta if isinstance(zero_beta, Column) else F.lit(bool(zero_beta))
    rows = panel.join(x, ["date", "barrid"], "left").withColumns(
        {"z": F.concat(F.coalesce("_x", none), own), "iv": F.try_divide(F.lit(1.0), F.col(risk) * F.col(risk)), "_zb": F.coalesce(zb, F.lit(False))})
    good = (F.col(risk) > 0) & F.col(alpha).isNotNull() & F.col(beta).isNotNull()
    group = [*dict.fromkeys([*by, "date"]), "_zb"]

    usable = rows.filter(good).select(*group, "z", "iv")
    # one figure a cell and cross-section from here on
    moments = weighted_moments(usable, group, k + 3).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("cell", "v")))["v"].alias("m"))
    sizes = usable.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    row = F.struct(F.col("factor"), F.array(*[F.coalesce(F.col(c).cast("double"), zero) for c in factors]).cast("array<double>").alias("f"))
    cov = covariances.filter(F.col("factor").isin(factors)).groupBy("date").agg(F.collect_list(row).alias("cov"))
    width, place = k + 3, {f: i for i, f in enumerate(factors)}
    i, j = np.triu_indices(width)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coef = []
            for m, n, rows_, both in zip(*(b.column(len(group) + c).to_pylist() for c in range(3)), b.column(len(group) - 1).to_pylist(), strict=True):
                full, f = np.zeros((width, width)), np.zeros((k, k))
                full[i, j] = full[j, i] = m
                for r in rows_ or []:
                    f[place[r["factor"]]] = r["f"]
                coef.append(coefficients(full, f, n, both, target_risk))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(group)], pa.array(list(coef), pa.list_(pa.float64()))], [*group, "coef"])

    ready = moments.join(sizes, group).join(cov, "date", "left").select(*group, "m", "n", "cov")
    solved = ready.mapInArrow(solve, f"{_schema(ready, group)}, coef array<double>")
    both = rows.join(solved, group, "left")
    weight = F.col("iv") * F.aggregate(F.zip_with("z", "coef", lambda a, c: a * c), F.lit(0.0), lambda s, v: s + v)
    return both.select(*[F.col(c) for c in cols if c != out], F.when(good, weight).alias(out))
