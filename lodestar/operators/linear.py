"""Linear models from sufficient statistics.

One aggregation pass produces n, sum(x), sum(y), X'X, X'y and y'y (optionally
per fold); the p x p system is solved on the driver (p is the feature count,
not data). Ridge over a lambda grid x K folds reuses the same single pass:
training statistics of a fold are total minus that fold, and the held-out
error follows from the fold's raw sums, so no second pass is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pairs(p: int):
    return [(i, j) for i in range(p) for j in range(i, p)]


def sufficient_stats(df: DataFrame, features: Sequence[str], label: str,
                     by: Sequence[str] = (), exact_decimal: bool = False) -> DataFrame:
    """n, sum x_i, sum y, sum x_i x_j (i<=j), sum x_i y, sum y^2 -- grouped by ``by``."""
    def v(c):
        return F.col(c).cast("decimal(18,4)") if exact_decimal else F.col(c).cast("double")

    feats = list(features)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(v(label)).cast("double").alias("sy"),
            F.sum(v(label) * v(label)).cast("double").alias("syy")]
    aggs += [F.sum(v(f)).cast("double").alias(f"sx{i}") for i, f in enumerate(feats)]
    aggs += [F.sum(v(feats[i]) * v(feats[j])).cast("double").alias(f"sxx{i}_{j}") for i, j in _pairs(len(feats))]
    aggs += [F.sum(v(f) * v(label)).cast("double").alias(f"sxy{i}") for i, f in enumerate(feats)]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


@dataclass
class Stats:
    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float

    @staticmethod
    def from_row(row, p: int) -> "Stats":
        sxx = np.zeros((p, p))
        for i, j in _pairs(p):
            sxx[i, j] = sxx[j, i] = row[f"sxx{i}_{j}"]
        return Stats(float(row["n"]), np.array([row[f"sx{i}"] for i in range(p)], dtype=float),
                     float(row["sy"]), sxx, np.array([row[f"sxy{i}"] for i in range(p)], dtype=float),
                     float(row["syy"]))

    def __sub__(self, o: "Stats") -> "Stats":
        return Stats(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx, self.sxy - o.sxy,
                     self.syy - o.syy)


def solve(st: Stats, l2: float = 0.0, fit_intercept: bool = True) -> tuple[np.ndarray, float]:
    """(coef, intercept) minimising ||y - a - Xb||^2 + l2 ||b||^2 (intercept not penalised)."""
    p = len(st.sx)
    if fit_intercept:
        mx, my = st.sx / st.n, st.sy / st.n
        a = st.sxx - st.n * np.outer(mx, mx)
        b = st.sxy - st.n * mx * my
    else:
        a, b = st.sxx.copy(), st.sxy.copy()
    coef = np.linalg.solve(a + l2 * np.eye(p), b)
    intercept = float(my - mx @ coef) if fit_intercept else 0.0
    return coef, intercept


def sse_from_stats(st: Stats, coef: np.ndarray, intercept: float) -> float:
    """Sum of squared errors of a fixed linear model over rows summarised by ``st``."""
    a, b = intercept, coef
    sum_pred_sq = st.n * a * a + 2 * a * (b @ st.sx) + b @ st.sxx @ b
    sum_y_pred = a * st.sy + b @ st.sxy
    return float(st.syy - 2 * sum_y_pred + sum_pred_sq)


@dataclass
class LinearFit:
    features: list[str]
    coef: np.ndarray
    intercept: float
    means: np.ndarray
    label_mean: float

    def prediction(self) -> Column:
        expr = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coef):
            expr = expr + F.lit(float(c)) * F.col(f).cast("double")
        return expr

    def contributions(self, prefix: str = "c_") -> dict[str, Column]:
        """Exact per-row feature contributions coef_j * (x_j - mean_j); they sum to
        prediction - mean prediction."""
        return {f"{prefix}{f}": F.lit(float(c)) * (F.col(f).cast("double") - F.lit(float(m)))
                for f, c, m in zip(self.features, self.coef, self.means)}

    def coefficient_frame(self, spark: SparkSession) -> DataFrame:
        rows = [("intercept", float(self.intercept))] + [(f, float(c)) for f, c in zip(self.features, self.coef)]
        return spark.createDataFrame(rows, "term string, value double")


def fit_linear(df: DataFrame, features: Sequence[str], label: str, l2: float = 0.0,
               fit_intercept: bool = True, exact_decimal: bool = False) -> LinearFit:
    feats = list(features)
    row = sufficient_stats(df, feats, label, exact_decimal=exact_decimal).collect()[0]
    st = Stats.from_row(row, len(feats))
    coef, intercept = solve(st, l2, fit_intercept)
    return LinearFit(feats, coef, intercept, st.sx / st.n, st.sy / st.n)


def ridge_cv(df: DataFrame, features: Sequence[str], label: str, fold: str,
             lambdas: Sequence[float], exact_decimal: bool = False) -> DataFrame:
    """Held-out MSE for every (lambda, fold) from ONE grouped aggregation pass."""
    feats = list(features)
    p = len(feats)
    rows = sufficient_stats(df, feats, label, by=[fold], exact_decimal=exact_decimal).collect()
    per = {r[fold]: Stats.from_row(r, p) for r in rows}
    total = None
    for st in per.values():
        total = st if total is None else Stats(total.n + st.n, total.sx + st.sx, total.sy + st.sy,
                                               total.sxx + st.sxx, total.sxy + st.sxy, total.syy + st.syy)
    out = []
    for lam in lambdas:
        for k, held in sorted(per.items()):
            coef, a = solve(total - held, float(lam))
            out.append((float(lam), int(k), sse_from_stats(held, coef, a) / held.n, int(held.n)))
    schema = T.StructType([T.StructField("lambda", T.DoubleType()), T.StructField("fold", T.IntegerType()),
                           T.StructField("mse", T.DoubleType()), T.StructField("n_heldout", T.LongType())])
    return df.sparkSession.createDataFrame(out, schema)


def spark_ml_linear(train: DataFrame, features: Sequence[str], label: str, reg: float = 0.0,
                    elastic_net: float = 0.0, solver: str = "auto", max_iter: int = 100):
    """OLS / ridge / lasso / elastic-net through Spark ML (distributed L-BFGS/OWL-QN or normal)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=elastic_net,
                          solver=solver, maxIter=max_iter, standardization=False)
    return Pipeline(stages=[va, lr]).fit(train)


# --------------------------------------------------------------------------- coordinate descent
@dataclass
class Centred:
    """Means and per-row covariances of features and label: all that a penalised fit with an intercept needs."""

    features: list[str]
    n: int
    means: np.ndarray
    label_mean: float
    gram: np.ndarray
    cov: np.ndarray


def centred_stats(df: DataFrame, features: Sequence[str], label: str) -> Centred:
    """One aggregation of centred co-moments, which don't cancel when means are large. Rows with a null are left out."""
    feats = list(features)
    x = [F.col(f).cast("double") for f in feats]
    y = F.col(label).cast("double")
    rows = df.select(*(c.alias(f"x{i}") for i, c in enumerate(x)), y.alias("y")).dropna()
    names = [f"x{i}" for i in range(len(feats))]
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("my"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(names)),
                   *(F.covar_pop(names[i], names[j]).alias(f"g{i}_{j}") for i, j in _pairs(len(names))),
                   *(F.covar_pop(c, F.col("y")).alias(f"c{i}") for i, c in enumerate(names))).first()
    if not row["n"]:
        raise ValueError("no complete rows")
    gram = np.zeros((len(names), len(names)))
    for i, j in _pairs(len(names)):
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"]
    return Centred(feats, int(row["n"]), np.array([row[f"m{i}"] for i in range(len(names))]), float(row["my"]), gram,
                   np.array([row[f"c{i}"] for i in range(len(names))]))


def descend(st: Centred, alpha: float, l1_ratio: float, start: np.ndarray, tol: float = 1e-10, max_iter: int = 10_000) -> np.ndarray:
    """Coefficients that minimise |y - Xw|^2 / 2n + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|^2 / 2).

    Coordinates are solved in turn from the covariances alone; ``rest`` keeps the covariance of each feature with
    what is left of the label. A feature without variance gets 0.
    """
    w, l1, l2 = start.astype(float).copy(), alpha * l1_ratio, alpha * (1 - l1_ratio)
    rest = st.cov - st.gram @ w
    for _ in range(max_iter):
        moved = 0.0
        for j in range(len(w)):
            curve = st.gram[j, j] + l2
            if curve <= 0:
                continue
            pull = rest[j] + st.gram[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / curve
            if new != w[j]:
                rest -= st.gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * np.sqrt(curve))
                w[j] = new
        if moved <= tol:
            break
    return w


def coordinate_path(df: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float],
                    l1_ratio: float = 1.0) -> list[tuple[float, LinearFit]]:
    """A fit per penalty, the strongest first, each started from the one before; the rows are read once."""
    st = centred_stats(df, features, label)
    w, out = np.zeros(len(st.features)), []
    for alpha in sorted(alphas, reverse=True):
        w = descend(st, float(alpha), l1_ratio, w)
        out.append((float(alpha), LinearFit(st.features, w.copy(), float(st.label_mean - st.means @ w), st.means, st.label_mean)))
    return out
