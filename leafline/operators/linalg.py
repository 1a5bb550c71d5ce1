"""Distributed moments and small dense solves.

Data rows are only ever aggregated: one pass builds the sums a p-column
model needs (p x p at most: metadata), which come to the driver; the p x p
solve/eigen problem is NumPy on the driver, and the fitted coefficients go
back into Spark as literal expressions.  Sums are taken over centred
values (means from a first pass) to keep digits on large-valued columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Mean of each column over its non-null rows (one aggregate)."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: (row[c] if row[c] is not None else 0.0) for c in cols}


def gram(df: DataFrame, xcols: Sequence[str], ycol: str | None = None, weight: Column | None = None,
         group: str | None = None) -> dict:
    """Centred cross-product sums over the rows where every column is present.

    Returns per group: n, means, XtX (p x p), Xty (p), yty.  One pass; the
    output size is p^2 per group (metadata)."""
    cols = list(xcols) + ([ycol] if ycol else [])
    complete = df
    for c in cols:
        complete = complete.where(F.col(c).isNotNull())
    shift = column_means(complete, cols)
    w = weight if weight is not None else F.lit(1.0)
    cen = {c: (F.col(c) - F.lit(shift[c])) for c in cols}
    aggs = [F.sum(w).alias("n")]
    for c in cols:
        aggs.append(F.sum(w * cen[c]).alias(f"s_{c}"))
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(w * cen[a] * cen[b]).alias(f"p_{a}__{b}"))
    rows = (complete.groupBy(group).agg(*aggs) if group else complete.agg(*aggs)).collect()
    out = {}
    for r in rows:
        n = float(r["n"] or 0.0)
        s = np.array([r[f"s_{c}"] or 0.0 for c in cols])
        P = np.zeros((len(cols), len(cols)))
        for i, a in enumerate(cols):
            for j, b in enumerate(cols[i:], start=i):
                P[i, j] = P[j, i] = r[f"p_{a}__{b}"] or 0.0
        mean_c = s / n if n else s
        C = P - n * np.outer(mean_c, mean_c)          # centred about the true means
        means = np.array([shift[c] for c in cols]) + mean_c
        k = len(xcols)
        key = r[group] if group else None
        out[key] = {
            "n": n,
            "means": means,
            "xtx": C[:k, :k],
            "xty": C[:k, k] if ycol else None,
            "yty": C[k, k] if ycol else None,
        }
    return out


def solve_ridge(g: dict, alpha: float = 0.0) -> tuple[np.ndarray, float]:
    """beta = (XcᵀXc + αI)⁻¹ Xcᵀyc (least squares / pseudo-inverse when
    singular); intercept = ȳ − x̄β."""
    k = g["xtx"].shape[0]
    A = g["xtx"] + alpha * np.eye(k)
    beta = np.linalg.lstsq(A, g["xty"], rcond=None)[0]
    intercept = g["means"][k] - g["means"][:k] @ beta
    return beta, float(intercept)


def r2_from_gram(g: dict, beta: np.ndarray) -> float:
    """Training R² = 1 − SSE/SST from the centred sums."""
    sst = g["yty"]
    sse = sst - 2 * beta @ g["xty"] + beta @ g["xtx"] @ beta
    return float(1 - sse / sst) if sst else float("nan")


def linear_expr(cols: Sequence[str], beta: Sequence[float], intercept: float) -> Column:
    """Prediction as a JVM expression with literal coefficients."""
    e = F.lit(float(intercept))
    for c, b in zip(cols, beta):
        e = e + F.col(c) * F.lit(float(b))
    return e


def covariance(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, float]:
    """Sample covariance (n − 1) over complete rows: (cov, means, n)."""
    g = gram(df, cols)[None]
    n = g["n"]
    return g["xtx"] / (n - 1), g["means"], n


def pca(df: DataFrame, cols: Sequence[str]):
    """Eigen-decomposition of the covariance; components sorted by
    variance, sign fixed so the largest-magnitude loading is positive."""
    cov, means, n = covariance(df, cols)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    for j in range(vecs.shape[1]):
        i = np.argmax(np.abs(vecs[:, j]))
        if vecs[i, j] < 0:
            vecs[:, j] = -vecs[:, j]
    ratio = vals / vals.sum() if vals.sum() else vals
    return {"eigenvalues": vals, "components": vecs.T, "ratio": ratio, "cumulative": np.cumsum(ratio), "means": means}
