"""Elastic net from sums of products, all folds in one pass.

The rows are read once: one aggregate by fold gives the sums and the sums of
products of the k features and the label, (k + 1)(k + 2) / 2 numbers a fold. A
fold's training sums are the total less its own, so five fits, the fit on all
rows and every error come from these few numbers. Coordinate descent with
covariance updates runs on the k x k matrix on the driver:

    minimise  |y - b - Xw|^2 / (2 n) + alpha l1 |w|_1 + alpha (1 - l1) |w|^2 / 2

The label is shifted by its mean first, so that squares do not cancel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHA, L1_RATIO = 1.0, 0.5  # fixed values of the reproduced model
TOLERANCE, MOST_SWEEPS = 1e-12, 10_000


@dataclass
class Products:
    """Row count, sums and sums of products of the features and, last, the label (less ``shift``)."""

    n: int
    sums: np.ndarray
    cross: np.ndarray
    shift: float

    def __add__(self, other: Products) -> Products:
        return Products(self.n + other.n, self.sums + other.sums, self.cross + other.cross, self.shift)

    def __sub__(self, other: Products) -> Products:
        return Products(self.n - other.n, self.sums - other.sums, self.cross - other.cross, self.shift)

    def covariance(self) -> np.ndarray:
        return (self.cross - np.outer(self.sums, self.sums) / self.n) / self.n


def products_by_fold(df: DataFrame, columns: Sequence[Column], label: Column, fold: str = "fold") -> dict[int, Products]:
    """One aggregate over ``df``; rows without a label are left out, features must not be NULL."""
    rows = df.where(label.isNotNull())
    shift = float(rows.agg(F.avg(label)).first()[0] or 0.0)
    k = len(columns)
    values = [c.cast("double").alias(f"v{i}") for i, c in enumerate(columns)] + [(label - F.lit(shift)).alias(f"v{k}")]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    found = rows.select(F.col(fold).alias("fold"), *values).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"v{i}").alias(f"s{i}") for i in range(k + 1)],
        *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()  # a row a fold
    out = {}
    for r in found:
        cross = np.zeros((k + 1, k + 1))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = r[f"p{i}_{j}"]
        out[r.fold] = Products(r.n, np.array([r[f"s{i}"] for i in range(k + 1)]), cross, shift)
    return out


def coordinate_descent(gram: np.ndarray, target: np.ndarray, alpha: float = ALPHA, l1_ratio: float = L1_RATIO,
                       tolerance: float = TOLERANCE, most_sweeps: int = MOST_SWEEPS) -> np.ndarray:
    """Weights from the features' covariance and their covariance with the label."""
    w = np.zeros(len(target))
    lasso, ridge = alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(most_sweeps):
        moved = 0.0
        for j in range(len(w)):
            scale = gram[j, j] + ridge
            rho = target[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - lasso, 0.0) / scale if scale > 0 else 0.0
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= tolerance * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


class ElasticNet:
    """A fitted line: ``coefficients`` over the named columns and ``intercept``."""

    def __init__(self, products: Products, features: Sequence[str], alpha: float = ALPHA, l1_ratio: float = L1_RATIO):
        cov = products.covariance()
        self.features = list(features)
        self.weights = coordinate_descent(cov[:-1, :-1], cov[:-1, -1], alpha, l1_ratio)
        means = products.sums / products.n
        self.offset = float(means[-1] - means[:-1] @ self.weights)  # of the shifted label
        self.coefficients, self.intercept = DenseVector(self.weights), self.offset + products.shift

    def transform(self, df: DataFrame) -> DataFrame:
        terms = [F.col(f"`{c}`") * F.lit(float(w)) for c, w in zip(self.features, self.weights)]
        return df.withColumn("prediction", sum(terms, F.lit(self.intercept)))

    def errors(self, held: Products) -> tuple[float, float]:
        """(RMSE, R²) on the rows behind ``held``, from their sums alone."""
        w = np.append(-self.weights, 1.0)  # residual = label - w x - offset
        sse = w @ held.cross @ w - 2 * self.offset * (w @ held.sums) + held.n * self.offset ** 2
        spread = held.covariance()[-1, -1] * held.n
        return float(np.sqrt(max(sse, 0.0) / held.n)), float(1 - sse / spread) if spread > 0 else float("nan")


def cross_validate_elastic_net(df: DataFrame, features: Sequence[str], fold: str = "fold", label: str = "label",
                               alpha: float = ALPHA, l1_ratio: float = L1_RATIO) -> tuple[list[tuple[float, float]], float, ElasticNet]:
    """((RMSE, R²) of each fold, training R² of the fit on all rows, that fit)."""
    folds = products_by_fold(df, [F.col(f"`{c}`") for c in features], F.col(label), fold)
    total = sum(list(folds.values())[1:], next(iter(folds.values())))
    held = [ElasticNet(total - own, features, alpha, l1_ratio).errors(own) for _, own in sorted(folds.items()) if own.n < total.n]
    whole = ElasticNet(total, features, alpha, l1_ratio)
    return held, whole.errors(total)[1], whole
