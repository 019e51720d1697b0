"""Principal components and factor analysis.

Spark reduces the data to a correlation matrix in one pass; only that p x p
matrix is decomposed with numpy, and scores are Column expressions over the data.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.tails import chi2_upper
from cohortloom.operators.moments import correlation_matrix


def _correlation(df: DataFrame, columns: list[str]) -> np.ndarray:
    cells = {(r.var1, r.var2): r.r for r in correlation_matrix(df, columns).collect()}
    return np.array([[1.0 if a == b else cells[a, b] for b in columns] for a in columns], dtype=float)


def _decompose(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and loadings whose largest entry is positive."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0.0, None), vectors[:, order]
    for j in range(vectors.shape[1]):
        lead = np.argmax(np.round(np.abs(vectors[:, j]), 9))
        vectors[:, j] *= 1.0 if vectors[lead, j] >= 0 else -1.0
    return values, vectors


class PrincipalComponents:
    """Components of standardised columns (the correlation matrix)."""

    def __init__(self, df: DataFrame, columns: list[str]):
        self.columns = columns
        complete = df.dropna(subset=columns)
        self.values, self.loadings = _decompose(_correlation(complete, columns))
        row = complete.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        self.means = [row[f"m{i}"] for i in range(len(columns))]
        self.deviations = [row[f"s{i}"] for i in range(len(columns))]

    def summary(self, spark) -> DataFrame:
        """Deviation and variance share of every component, with its loadings."""
        total = float(self.values.sum())
        rows, running = [], 0.0
        for j, value in enumerate(self.values):
            share = float(value) / total
            running += share
            loadings = [float(x) for x in self.loadings[:, j]]
            rows.append((j + 1, math.sqrt(float(value)), float(value), share, running, *loadings))
        names = ["component", "sdev", "eigenvalue", "proportion", "cumulative", *[f"loading_{c}" for c in self.columns]]
        return spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'component' else 'double'}" for n in names))

    def scree(self, spark) -> DataFrame:
        """Eigenvalues and their logarithm."""
        value = F.col("eigenvalue")
        return self.summary(spark).select(
            "component", "eigenvalue", F.when(value > 0, F.log(value)).alias("log_eigenvalue")
        )

    def scores(self, df: DataFrame, count: int = 3, prefix: str = "pc") -> DataFrame:
        """The first components of every row, computed in the row."""
        z = [
            (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(self.columns, self.means, self.deviations, strict=True)
        ]
        scores = {
            f"{prefix}{j + 1}": reduce(lambda a, b: a + b, [x * F.lit(float(w)) for x, w in zip(z, self.loadings[:, j], strict=True)])
            for j in range(min(count, len(self.columns)))
        }
        return df.withColumns(scores)


def pca_scores(fit: PrincipalComponents, numeric: DataFrame, other: DataFrame, key: str, count: int = 3) -> DataFrame:
    """Scores joined to another table of the same rows by an explicit row key."""
    names = [f"pc{j + 1}" for j in range(min(count, len(fit.columns)))]
    return other.join(fit.scores(numeric, count).select(key, *names), key)


def _loadings(scaled: np.ndarray, uniqueness: np.ndarray, factors: int) -> np.ndarray:
    values, vectors = np.linalg.eigh(scaled)
    top = np.argsort(values)[::-1][:factors]
    return np.sqrt(uniqueness)[:, None] * vectors[:, top] * np.sqrt(np.clip(values[top] - 1.0, 0.0, None))[None, :]


def _misfit(matrix: np.ndarray, factors: int, logs: np.ndarray) -> tuple[float, np.ndarray]:
    """The likelihood's discrepancy with the best loadings for these log uniquenesses, and its gradient."""
    uniqueness = np.exp(logs)
    root = np.sqrt(uniqueness)
    scaled = matrix / np.outer(root, root)
    values = np.linalg.eigvalsh(scaled)[::-1]
    left = np.concatenate([np.minimum(values[:factors], 1.0), values[factors:]])
    loadings = _loadings(scaled, uniqueness, factors)
    gradient = ((loadings**2).sum(axis=1) + uniqueness - np.diag(matrix)) / uniqueness
    return float(np.sum(left - np.log(np.maximum(left, 1e-300)) - 1.0)), gradient


def _free_gradient(logs: np.ndarray, gradient: np.ndarray, low: float) -> np.ndarray:
    """The gradient without the parts that push a uniqueness out of its bounds."""
    stuck = ((logs <= low) & (gradient > 0)) | ((logs >= 0.0) & (gradient < 0))
    return np.where(stuck, 0.0, gradient)


def _maximum_likelihood(matrix: np.ndarray, factors: int, tolerance: float = 1e-8, rounds: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Uniquenesses between 0.005 and 1 that minimise the misfit, and the loadings.

    Damped Newton steps on the log uniquenesses off their bounds, until the
    gradient is zero within the tolerance.  Raises if that is not reached.
    """
    p, low = matrix.shape[0], math.log(0.005)
    logs = np.clip(np.log((1.0 - 0.5 * factors / p) / np.diag(np.linalg.pinv(matrix))), low, 0.0)
    value, gradient = _misfit(matrix, factors, logs)
    for _ in range(rounds):
        free = _free_gradient(logs, gradient, low)
        at = np.flatnonzero(free)
        if np.max(np.abs(free)) < tolerance:
            break
        steps = np.eye(p)[at] * 1e-5
        hessian = np.array([(_misfit(matrix, factors, logs + d)[1] - _misfit(matrix, factors, logs - d)[1])[at] / 2e-5 for d in steps])
        sizes, axes = np.linalg.eigh((hessian + hessian.T) / 2)
        newton = -axes @ ((axes.T @ free[at]) / np.maximum(np.abs(sizes), 1e-6))
        for way in (newton, -free[at]):
            scale = 1.0 / max(1.0, float(np.max(np.abs(way))) / 2.0)
            while scale > 1e-12:
                tried = logs.copy()
                tried[at] = np.clip(logs[at] + scale * way, low, 0.0)
                new_value, new_gradient = _misfit(matrix, factors, tried)
                lower = new_value < value + 1e-4 * float(gradient @ (tried - logs))
                # near the minimum the value no longer tells steps apart, the gradient does
                flat = abs(new_value - value) < 1e-12 and np.max(np.abs(_free_gradient(tried, new_gradient, low))) < np.max(np.abs(free))
                if lower or flat:
                    break
                scale /= 2.0
            if scale > 1e-12:
                break
        else:
            raise ValueError(f"the factor fit stopped at a gradient of {np.max(np.abs(free)):.2g}")
        logs, value, gradient = tried, new_value, new_gradient
    else:
        raise ValueError(f"the factor fit did not converge in {rounds} rounds")
    uniqueness = np.exp(logs)
    root = np.sqrt(uniqueness)
    return uniqueness, _loadings(matrix / np.outer(root, root), uniqueness, factors)


def _varimax(loadings: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Varimax rotation with row normalisation."""
    size = np.sqrt((loadings**2).sum(axis=1))
    size[size == 0] = 1.0
    x = loadings / size[:, None]
    turn, last = np.eye(x.shape[1]), 0.0
    for _ in range(rounds):
        z = x @ turn
        u, s, v = np.linalg.svd(x.T @ (z**3 - z * (z**2).mean(axis=0)[None, :]))
        turn = u @ v
        if s.sum() <= last * (1 + 1e-5):
            break
        last = s.sum()
    else:
        raise ValueError(f"the rotation did not converge in {rounds} rounds")
    return (x @ turn) * size[:, None]


def factor_analysis(df: DataFrame, columns: list[str], factors: int = 2) -> DataFrame:
    """Maximum-likelihood factors with varimax: loadings and uniqueness per column.

    Every row also carries the fit test: chi-square statistic, its degrees of
    freedom and p-value (missing when no degrees of freedom are left).
    """
    p = len(columns)
    if (p - factors) ** 2 < p + factors:
        raise ValueError(f"{factors} factors are too many for {p} columns")
    complete = df.dropna(subset=columns)
    matrix, n = _correlation(complete, columns), complete.count()
    uniqueness, loadings = _maximum_likelihood(matrix, factors)
    rotated = _varimax(loadings)
    rotated = rotated[:, np.argsort(-(rotated**2).sum(axis=0))]
    for j in range(factors):
        rotated[:, j] *= 1.0 if rotated[:, j].sum() >= 0 else -1.0
    model = loadings @ loadings.T + np.diag(uniqueness)
    objective = math.log(np.linalg.det(model) / np.linalg.det(matrix)) + np.trace(matrix @ np.linalg.inv(model)) - p
    dof = ((p - factors) ** 2 - p - factors) // 2
    statistic = float(n - 1 - (2 * p + 5) / 6 - 2 * factors / 3) * float(objective)
    p_value = float(chi2_upper(statistic, dof)) if dof > 0 else None
    rows = [
        (c, float(uniqueness[i]), *[float(x) for x in rotated[i]], float(statistic), dof, p_value)
        for i, c in enumerate(columns)
    ]
    names = ", ".join(f"factor{j + 1} double" for j in range(factors))
    return df.sparkSession.createDataFrame(
        rows, f"variable string, uniqueness double, {names}, chi_square double, df int, p_value double"
    )
