"""Evaluation metrics as single aggregations (predictions never leave the executors)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.plans import scan


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """share of rows where prediction equals label, and the error rate."""
    eq = (_c(label).cast("double") == _c(prediction).cast("double")).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(eq).alias("accuracy"),
                  (F.lit(1.0) - F.avg(eq)).alias("error_rate"))


def auc_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC by the rank-sum formula with average ranks on ties.

    Rows are first collapsed to distinct scores with positive/negative counts
    (partial aggregation), then ranks come from the skew-safe global scan over
    the sorted distinct scores. NULL if all labels are the same.
    """
    hist = df.groupBy(score).agg(F.sum(_c(label).cast("long")).alias("__pos"),
                                 F.count(F.lit(1)).alias("__cnt"))
    cum = scan.running_aggregate(hist, [], [score], {"__cum": ("sum", "__cnt")})
    avg_rank = F.col("__cum") - F.col("__cnt") + (F.col("__cnt") + F.lit(1)) / F.lit(2.0)
    tot = cum.agg(F.sum(F.col("__pos") * avg_rank).alias("__rsum"), F.sum("__pos").alias("n_pos"),
                  F.sum(F.col("__cnt") - F.col("__pos")).alias("n_neg"))
    auc = F.try_divide(F.col("__rsum") - F.col("n_pos") * (F.col("n_pos") + F.lit(1)) / F.lit(2.0),
                       F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    return tot.select("n_pos", "n_neg", auc.alias("auc"))


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(_c(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = _c(label).cast("double")
    ll = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(ll).alias("log_loss"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MSE, RMSE, MAE and R^2 (SST = n * population variance: one pass, stable; NULL for a constant label)."""
    err = _c(label).cast("double") - _c(prediction).cast("double")
    g = df.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
               F.sum(err * err).alias("__sse"), F.var_pop(_c(label).cast("double")).alias("__var"))
    return g.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                    (F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("n") * F.col("__var"))).alias("r2"))


def cluster_purity(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Sum over clusters of the largest label count, divided by the row count."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("__c"))
    best = counts.groupBy(cluster).agg(F.max("__c").alias("__m"), F.sum("__c").alias("__n"))
    return best.agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("__n").alias("n"),
                    (F.sum("__m") / F.sum("__n")).alias("purity"))


def fold_summary(scores: DataFrame, by: list[str], score: str, higher_is_better: bool = True) -> DataFrame:
    """mean / best / worst / sum of per-fold scores (final score = fold mean); of an error the smallest is best."""
    best, worst = (F.max, F.min) if higher_is_better else (F.min, F.max)
    return scores.groupBy(*by).agg(F.avg(score).alias("mean_score"), best(score).alias("best_score"),
                                   worst(score).alias("worst_score"), F.sum(score).alias("total"),
                                   F.count(F.lit(1)).alias("n_folds"))


def silhouette(df: DataFrame, vector: str, cluster: str, max_clusters: int = 10_000) -> DataFrame:
    """Rows with their silhouette (squared Euclidean distance): (``cluster``, n, silhouette) per cluster, and a null cluster for all.

    A row's mean squared distance to a cluster follows from the cluster's number of rows, mean and sum of squares, so
    no pairs are formed. A row alone in its cluster has 0. Clusters' figures are one row each and go to every task;
    more than ``max_clusters`` raise ``ValueError``.
    """
    rows = df.where(F.col(vector).isNotNull() & F.col(cluster).isNotNull()).select(
        F.col(cluster).cast("long").alias("c"), F.col(vector).cast("array<double>").alias("v"))
    figures = rows.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("square"),
        Summarizer.mean(array_to_vector("v")).alias("mean")).limit(max_clusters + 1).collect()
    if len(figures) > max_clusters:
        raise ValueError(f"more than {max_clusters} clusters")
    figures.sort(key=lambda f: f["c"])
    ids, n = np.array([f["c"] for f in figures], np.int64), np.array([f["n"] for f in figures], np.float64)
    mean, spread = np.array([f["mean"].toArray() for f in figures]), np.array([f["square"] for f in figures])

    def run(batches):
        for pdf in batches:
            v = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, mean.shape[1] if len(ids) else 0))
            own = np.searchsorted(ids, pdf["c"].to_numpy())
            if not len(pdf):
                continue
            far = (v * v).sum(1)[:, None] + (spread / n)[None] - 2 * v @ mean.T
            at = np.arange(len(v))
            inner = far[at, own] * n[own] / np.maximum(n[own] - 1, 1)
            far[at, own] = np.inf
            outer = far.min(axis=1)
            s = np.where((n[own] > 1) & np.isfinite(outer), (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300), 0.0)
            yield pd.DataFrame({"c": pdf["c"], "s": s})
    each = rows.mapInPandas(run, "c long, s double")
    return each.rollup("c").agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette")).withColumnRenamed("c", cluster)
