"""Model fitting, scoring and search on Spark ML (data-parallel fits; predictions stay distributed).

Parameters follow the reference workloads' names where Spark ML has a
counterpart; the mapping is documented per builder. Boosted-tree options
without a Spark counterpart (L1/L2 leaf penalties) are not emulated.
"""

from __future__ import annotations

import contextlib
import functools
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import logits

FEATURES = "features"

#: Numbers that concurrent fits keep together (2 GB as doubles), and rows of a part that rows are dealt to.
CELLS_AT_ONCE, PART_ROWS = 1 << 28, 500_000


def assembler(features: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def _subset_strategy(max_features) -> str:
    if isinstance(max_features, str):
        return max_features
    if max_features is None or float(max_features) >= 1.0:
        return "all"
    return str(float(max_features))


def random_forest(features: Sequence[str], label: str, task: str = "classification", n_estimators: int = 10,
                  max_depth: int = 5, max_features=1.0, n_bins: int = 64, bootstrap: bool = True,
                  seed: int = 0, subsample: float = 1.0) -> Pipeline:
    """n_estimators->numTrees, max_depth->maxDepth (Spark allows 30), n_bins->maxBins,
    max_features->featureSubsetStrategy, bootstrap and seed passed through."""
    if max_depth > 30:
        raise ValueError(f"max_depth {max_depth}: trees can be 30 levels deep at most")
    cls = RandomForestClassifier if task == "classification" else RandomForestRegressor
    est = cls(featuresCol=FEATURES, labelCol=label, numTrees=n_estimators, maxDepth=max_depth,
              maxBins=n_bins, featureSubsetStrategy=_subset_strategy(max_features), bootstrap=bootstrap,
              seed=seed, subsamplingRate=subsample)
    return Pipeline(stages=[assembler(features), est])


def boosted_trees(features: Sequence[str], label: str, task: str = "classification", n_rounds: int = 10,
                  max_depth: int = 6, learning_rate: float = 0.3, subsample: float = 1.0,
                  colsample: float | None = None, min_child_weight: float = 1.0, gamma: float = 0.0,
                  seed: int = 0, n_bins: int = 32) -> Pipeline:
    """Gradient-boosted trees: rounds->maxIter, learning_rate->stepSize, subsample->subsamplingRate,
    colsample->featureSubsetStrategy, min_child_weight->minInstancesPerNode, gamma->minInfoGain."""
    cls = GBTClassifier if task == "classification" else GBTRegressor
    est = cls(featuresCol=FEATURES, labelCol=label, maxIter=n_rounds, maxDepth=max_depth, stepSize=learning_rate,
              subsamplingRate=subsample, featureSubsetStrategy=_subset_strategy(colsample),
              minInstancesPerNode=max(1, int(min_child_weight)), minInfoGain=gamma, seed=seed, maxBins=n_bins)
    return Pipeline(stages=[assembler(features), est])


def kmeans(features: Sequence[str] | None, k: int = 8, max_iter: int = 300, tol: float = 1e-4, seed: int = 1,
           init: str = "k-means||", vector_col: str | None = None) -> Pipeline:
    stages = [] if vector_col else [assembler(features)]
    est = KMeans(featuresCol=vector_col or FEATURES, k=k, maxIter=max_iter, tol=tol, seed=seed,
                 initMode="random" if init == "random" else "k-means||", predictionCol="cluster")
    return Pipeline(stages=stages + [est])


def logistic_regression(features: Sequence[str], label: str, penalty: str = "l2", C: float = 1.0,
                        l1_ratio: float = 0.5, fit_intercept: bool = True, *, n_rows: int,
                        max_iter: int = 100) -> Pipeline:
    """Inverse strength C maps to regParam = 1 / (C * n) with ``n_rows`` the rows fitted on; penalty none -> 0,
    l1 -> 1, l2 -> 0, elasticnet -> l1_ratio. C is bounded below to avoid an infinite penalty."""
    c = max(float(C), 1e-12)
    reg = 0.0 if penalty in (None, "none") else 1.0 / (c * float(max(n_rows, 1)))
    enet = {"l1": 1.0, "l2": 0.0, "elasticnet": float(l1_ratio)}.get(penalty or "none", 0.0)
    est = LogisticRegression(featuresCol=FEATURES, labelCol=label, regParam=reg, elasticNetParam=enet,
                             fitIntercept=fit_intercept, maxIter=max_iter, standardization=True)
    return Pipeline(stages=[assembler(features), est])


def centered_pca(features: Sequence[str] | None, k: int = 5, vector_col: str | None = None) -> Pipeline:
    """PCA on mean-centred rows (Spark's PCA projects uncentred rows, so centre first)."""
    stages = [] if vector_col else [assembler(features)]
    src = vector_col or FEATURES
    return Pipeline(stages=stages + [StandardScaler(inputCol=src, outputCol="__centered", withMean=True, withStd=False),
                                     PCA(k=k, inputCol="__centered", outputCol="pca")])


def gram_matrix(df: DataFrame, array_col: str, dim: int) -> np.ndarray:
    """X'X for an array column: per-partition numpy partial sums, summed by Spark; p x p result."""
    def partial(it):
        acc = np.zeros((dim, dim))
        for pdf in it:
            if len(pdf):
                x = np.stack(pdf[array_col].to_numpy()).astype(np.float64)
                acc += x.T @ x
        yield pd.DataFrame({"i": np.repeat(np.arange(dim), dim), "j": np.tile(np.arange(dim), dim),
                            "v": acc.ravel()})
    schema = "i int, j int, v double"
    sums = df.select(array_col).mapInPandas(partial, schema).groupBy("i", "j").agg(F.sum("v").alias("v"))
    g = np.zeros((dim, dim))
    for r in sums.collect():  # dim*dim numbers, independent of row count
        g[r["i"], r["j"]] = r["v"]
    return g


def truncated_svd(df: DataFrame, array_col: str, dim: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Top-k right singular vectors V and singular values of X (uncentred) via eig(X'X)."""
    g = gram_matrix(df, array_col, dim)
    w, v = np.linalg.eigh(g)
    order = np.argsort(w)[::-1][:k]
    vals = np.sqrt(np.clip(w[order], 0, None))
    vecs = v[:, order]
    # deterministic sign: largest-magnitude loading positive
    for c in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, c])), c] < 0:
            vecs[:, c] = -vecs[:, c]
    return vecs, vals


def project(array_col: str, components: np.ndarray, prefix: str = "comp") -> dict[str, Column]:
    """Row projections X v_c as native array expressions (no UDF)."""
    out = {}
    x = F.col(array_col)
    for c in range(components.shape[1]):
        w = F.array(*[F.lit(float(a)) for a in components[:, c]])
        out[f"{prefix}{c}"] = F.aggregate(F.zip_with(x, w, lambda a, b: a.cast("double") * b), F.lit(0.0),
                                          lambda acc, v: acc + v)
    return out


def random_fourier_features(array_col: str, dim: int, n_components: int = 64, gamma: float = 0.001,
                            seed: int = 0, out: str = "rff") -> Column:
    """RBF-kernel approximation z(x) = sqrt(2/D) cos(Wx + b), W ~ N(0, 2*gamma), b ~ U(0, 2pi)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, dim))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    x = F.col(array_col)
    comps = []
    for c in range(n_components):
        wc = F.array(*[F.lit(float(a)) for a in w[c]])
        dot = F.aggregate(F.zip_with(x, wc, lambda a, q: a.cast("double") * q), F.lit(0.0), lambda acc, v: acc + v)
        comps.append(F.lit(scale) * F.cos(dot + F.lit(float(b[c]))))
    return array_to_vector(F.array(*comps)).alias(out)


def linear_svc(label: str, C: float = 100.0, *, n_rows: int, features_col: str = "rff",
               max_iter: int = 100) -> LinearSVC:
    return LinearSVC(featuresCol=features_col, labelCol=label, regParam=1.0 / (max(C, 1e-12) * n_rows),
                     maxIter=max_iter)


class CalibratedSVC:
    """A linear SVM whose margins a sigmoid turns into probabilities."""

    def __init__(self, model, slope: float, constant: float):
        self.model, self.slope, self.constant = model, slope, constant

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        margin = vector_to_array("rawPrediction")[1]
        return self.model.transform(df).select(*keep, margin.alias("margin"), F.col("prediction").cast("double").alias("prediction"),
                                               (1 / (1 + F.exp(-(F.lit(self.slope) * margin + F.lit(self.constant))))).alias("prob"))


def fit_sigmoid(margin: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and constant of P(1 | margin) from binned margins, by Newton steps on the likelihood.

    Targets are (positives + 1) / (positives + 2) and 1 / (negatives + 2), so separable margins stay finite.
    """
    pos, neg = positive.sum(), (n - positive).sum()
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)
    target = positive * high + (n - positive) * low
    a, b = 0.0, math.log((pos + 1) / (neg + 1))
    loss = lambda a, b: float((n * np.logaddexp(0, a * margin + b) - target * (a * margin + b)).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        r, w = n * p - target, n * p * (1 - p)
        grad = np.array([(r * margin).sum(), r.sum()])
        curve = np.array([[(w * margin * margin).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]]) + 1e-12 * np.eye(2)
        step, t = np.linalg.solve(curve, grad), 1.0
        while loss(a - t * step[0], b - t * step[1]) > loss(a, b) + 1e-12 and t > 1e-8:
            t /= 2
        a, b = a - t * step[0], b - t * step[1]
        if np.abs(t * step).max() < 1e-10:
            break
    return float(a), float(b)


def calibrated_svc(df: DataFrame, label: str, fold: str, C: float = 100.0, features_col: str = "rff", bins: int = 2_000) -> CalibratedSVC:
    """``linear_svc`` on all rows; its sigmoid is fitted to margins of models that did not see the row (folds 0..k-1).

    Margins are added up in bins, so ``bins`` sums at most reach the driver.
    """
    folds = sorted(r[fold] for r in df.select(fold).distinct().collect())
    parts = []
    for k in folds:
        train, held = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
        model = linear_svc(label, C, n_rows=train.count(), features_col=features_col).fit(train)
        parts.append(model.transform(held).select(vector_to_array("rawPrediction")[1].alias("m"), F.col(label).cast("double").alias("y")))
    margins = functools.reduce(DataFrame.unionByName, parts).persist()
    try:
        edge = margins.agg(F.min("m").alias("low"), F.max("m").alias("high")).first()
        width = max((edge["high"] - edge["low"]) / bins, 1e-300)
        cell = F.least(F.floor((F.col("m") - F.lit(edge["low"])) / F.lit(width)), F.lit(bins - 1))
        sums = margins.groupBy(cell.alias("b")).agg(F.avg("m").alias("m"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).collect()
    finally:
        margins.unpersist()
    slope, constant = fit_sigmoid(*(np.array([r[c] for r in sums], float) for c in ("m", "n", "pos")))
    return CalibratedSVC(linear_svc(label, C, n_rows=df.count(), features_col=features_col).fit(df), slope, constant)


def scaled_linear(features: Sequence[str], label: str, reg: float = 0.0) -> Pipeline:
    """Standardise (mean 0, sample std 1) then ordinary/ridge least squares."""
    from pyspark.ml.regression import LinearRegression
    return Pipeline(stages=[assembler(features, "__raw"),
                            StandardScaler(inputCol="__raw", outputCol=FEATURES, withMean=True, withStd=True),
                            LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=reg, solver="normal")])


def right_size(df: DataFrame, target_bytes: int = 256 << 20, grow: bool = False,
               min_partitions: int | None = None) -> DataFrame:
    """Partition a training set for iterative fits: coalesce to max(default parallelism,
    size / target_bytes) partitions when it is split finer (every pass pays per-task
    overhead), and with ``grow`` spread it over the default parallelism when it has fewer
    partitions than that (a small source file with few row groups would otherwise leave
    cores idle on every pass). ``grow`` adds one shuffle, so it is meant for frames that
    are about to be persisted; on a cluster, inputs already have more partitions than
    cores and are never grown. ``min_partitions`` lowers the floor from the core count for
    fits that run several at once: each then needs only its share of the cores, and fewer
    partitions spare every optimiser pass the extra tree-aggregation stage."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - statistics unavailable: leave as is
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    floor = cores if min_partitions is None else max(1, min(cores, int(min_partitions)))
    want = max(floor, -(-size // target_bytes))
    have = df.rdd.getNumPartitions()
    if have > want:
        return df.coalesce(want)
    if grow and have < cores:
        return df.repartition(cores)
    return df


def fits_at_once(rows: int, widths: Sequence[int]) -> int:
    """How many fits on ``rows`` rows may run together: each keeps its features as dense blocks until it ends."""
    return max(1, min(len(widths), CELLS_AT_ONCE // max(1, rows * max(widths, default=1))))


def dealt(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``df`` in ``partitions`` parts by the hash of ``key`` and in its order.

    Spark ML draws bootstrap and row samples per partition, by its number and its rows' order; so dealt, a forest or
    boosted model is the same on any machine and for any file layout. ``partitions`` is part of the model's parameters;
    by default there are 16, and more when a part would have over ``PART_ROWS`` rows: tasks don't grow with the table.
    """
    if partitions is None:
        partitions = max(16, -(-df.count() // PART_ROWS))
    rest = [c for c, t in df.dtypes if c != key and t in ("string", "int", "bigint", "double", "float")]
    return df.repartition(partitions, key).sortWithinPartitions(key, *rest)


def fit_cached(estimator: Pipeline | Callable[[int], Pipeline], train: DataFrame, key: str | None = None) -> PipelineModel:
    """Fit with the training rows persisted for the fit's passes, then release them. Rows are ``dealt`` by ``key``,
    which models that sample rows need; without one they are spread over the cores. ``estimator`` may be made from the
    number of rows, which is counted on the persisted rows."""
    cached = (dealt(train, key) if key else train).persist()
    held = [cached]
    try:
        n_rows = cached.count()
        cores = train.sparkSession.sparkContext.defaultParallelism
        if not key and cached.rdd.getNumPartitions() < cores:
            held.append(cached := cached.repartition(cores).persist())
        return (estimator(n_rows) if callable(estimator) else estimator).fit(cached)
    finally:
        for df in held:
            df.unpersist()


def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def thresholded(prob: Column, t: float = 0.5) -> Column:
    return (prob > F.lit(t)).cast("double")


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], classification: bool = True) -> DataFrame:
    """Batch scoring: the fitted model is shipped to executors by ``transform``."""
    out = model.transform(df)
    cols = [*keep, F.col("prediction").cast("double").alias("prediction")]
    if classification and "probability" in out.columns:
        cols.append(positive_probability().alias("prob"))
    return out.select(*cols)


def auc(pred: DataFrame, label: str, prob: str = "prob") -> float:
    """Exact ROC AUC (rank form, ties averaged) of a scored frame."""
    from lodestar.operators.metrics import auc_rank
    return float(auc_rank(pred, label, prob).collect()[0]["auc"])


def grid_search(estimator: Pipeline, grid: Mapping, train: DataFrame, label: str, fold_col: str,
                parallelism: int = 2) -> DataFrame:
    """K-fold grid search with a user fold column (``foldCol``): table of params and mean AUC.

    Each fold filters ``train`` several times, so callers persist it. Binary logistic regressions of all folds and
    parameters are fitted together (``logits``).
    """
    stage = estimator.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(stage.getParam(name), list(values))
    maps = builder.build()
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev, foldCol=fold_col,
                        parallelism=parallelism)
    train = train.withColumn(label, F.col(label).cast("double"))
    means = _logit_fold_means(estimator, maps, train, label, fold_col, cv.getNumFolds(), ev, parallelism)
    rows = []
    for pm, m in zip(maps, cv.fit(train).avgMetrics if means is None else means):
        rows.append(({p.name: float(v) for p, v in pm.items()}, float(m)))
    names = list(grid)
    schema = T.StructType([T.StructField("trial_id", T.IntegerType())]
                          + [T.StructField(n, T.DoubleType()) for n in names]
                          + [T.StructField("mean_auc", T.DoubleType())])
    data = [(i, *[p[n] for n in names], m) for i, (p, m) in enumerate(rows)]
    return train.sparkSession.createDataFrame(data, schema)


#: Parameters of a logistic regression that ``logits`` follows, besides its columns; others keep their defaults.
_LOGIT_PARAMS = {"regParam", "elasticNetParam", "fitIntercept", "maxIter"}


def _logit_fold_means(estimator: Pipeline, maps: Sequence[dict], train: DataFrame, label: str, fold_col: str, n_folds: int,
                      evaluator: BinaryClassificationEvaluator, parallelism: int) -> list[float] | None:
    """Mean metric over the folds of each parameter map, or None for other estimators and rows that need fits of their own."""
    stages = estimator.getStages()
    if len(stages) != 2 or not isinstance(stages[0], VectorAssembler) or not isinstance(stages[1], LogisticRegression):
        return None
    default = LogisticRegression()
    settings = [{p.name: v for p, v in (stages[1].extractParamMap() | pm).items()} for pm in maps]
    plain = {p.name: v for p, v in default.extractParamMap().items()}
    own = {"featuresCol": stages[0].getOutputCol(), "labelCol": label}
    if any(s.get(name) != own.get(name, plain.get(name)) for s in settings for name in {*s, *plain} - _LOGIT_PARAMS):
        return None
    inputs = stages[0].getInputCols()
    folds = [r[0] for r in train.select(fold_col).distinct().limit(n_folds + 1).collect()]
    if sorted(folds, key=str) != [*range(n_folds)]:
        return None
    kept = logits.blocks(train, inputs, label, fold_col, train.count())
    try:
        specs = [logits.Spec(tuple((i,) for i in range(len(inputs))), s["regParam"], s["elasticNetParam"], s["fitIntercept"], s["maxIter"], k)
                 for s in settings for k in range(n_folds)]
        fits = logits.fit(kept, len(inputs), specs)
    except logits.Unfit:
        return None
    finally:
        kept.unpersist()
    scored = {id(f): train.where(F.col(fold_col) == spec.without).select(label, f.margin(inputs).alias("rawPrediction"))
              for spec, f in zip(specs, fits)}  # equal models are one, evaluated once
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        found = dict(zip(scored, pool.map(evaluator.evaluate, scored.values())))
    metrics = np.array([found[id(f)] for f in fits]).reshape(len(maps), n_folds)
    return [float(m) for m in metrics.mean(axis=1)]


def evaluate_candidates(candidates: Sequence[dict], build: Callable[[dict], Pipeline], train: DataFrame,
                        test: DataFrame, label: str, parallelism: int = 2,
                        together: Callable[[Sequence[dict]], list[float]] | None = None) -> DataFrame:
    """Fit/evaluate each candidate (each fit is a distributed job; ``parallelism`` jobs at once).

    ``together`` may fit and evaluate all candidates in shared passes and return their AUCs; if it raises
    ``logits.Unfit``, each candidate is fitted alone.
    Returns a trial table: trial_id, params..., auc, state (non-finite -> 'failed'), error (why a fit failed).
    """
    def run(i_c):
        i, cand = i_c
        try:
            model = build(cand).fit(train)
            val, why = auc(score(model, test, [label]), label), None
        except Exception as failure:  # noqa: BLE001 - a failing trial is recorded, not raised
            val, why = float("nan"), str(failure).split("\n")[0]
        return i, cand, val, why

    results = None
    if together is not None:
        with contextlib.suppress(logits.Unfit):
            results = [(i, c, v, None) for i, (c, v) in enumerate(zip(candidates, together(candidates)))]
    if results is None:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(run, enumerate(candidates)))
    names = list(candidates[0]) if candidates else []
    rows = [(i, *[float(c[n]) for n in names], v, "complete" if math.isfinite(v) else "failed", why)
            for i, c, v, why in results]
    schema = T.StructType([T.StructField("trial_id", T.IntegerType())]
                          + [T.StructField(n, T.DoubleType()) for n in names]
                          + [T.StructField("auc", T.DoubleType()), T.StructField("state", T.StringType()),
                             T.StructField("error", T.StringType())])
    return train.sparkSession.createDataFrame(rows, schema)


class BestModelSaver:
    """Keep the best model on disk: save only on strict improvement (starts below any score)."""

    def __init__(self, path: str, higher_is_better: bool = True):
        self.path = path
        self.sign = 1.0 if higher_is_better else -1.0
        self.best = -math.inf

    def offer(self, model: PipelineModel, value: float) -> bool:
        if math.isfinite(value) and self.sign * value > self.best:
            self.best = self.sign * value
            model.write().overwrite().save(self.path)
            return True
        return False


def load_model(path: str) -> PipelineModel:
    """Reload a saved pipeline; the stage classes are read from the saved metadata."""
    return PipelineModel.load(path)


def refit_best(trials: DataFrame, build: Callable[[dict], Pipeline], data: DataFrame, metric: str = "auc",
               trial_col: str = "trial_id") -> PipelineModel:
    """Refit the best trial's parameters (by name) on all rows."""
    best = trials.orderBy(F.desc(metric), F.asc(trial_col)).limit(1).collect()[0].asDict()
    params = {k: v for k, v in best.items() if k not in (trial_col, metric, "state", "error")}
    return build(params).fit(data)


def load_hyperparameters(path: str | None, defaults: Mapping[str, object]) -> dict:
    """Hyper-parameters from a JSON file (a small driver-side config), over ``defaults``.

    A missing or unreadable file yields the defaults (never ``None``); values
    are cast to the type of the default they replace.
    """
    import json
    import os
    params = dict(defaults)
    if not path or not os.path.exists(path):
        return params
    try:
        with open(path) as fh:
            loaded = json.load(fh)
    except (OSError, ValueError):
        return params
    for k, v in loaded.items():
        if k in defaults and defaults[k] is not None and not isinstance(defaults[k], str):
            v = type(defaults[k])(v)
        params[k] = v
    return params


def holdout_cv(df: DataFrame, key: str, label: str, build: Callable[[], Pipeline], seeds: Sequence[int],
               train_fraction: float = 0.8, saver: "BestModelSaver | None" = None) -> DataFrame:
    """Repeated hold-out evaluation: per seed a fresh split, fit, accuracy on the held-out rows.

    The input is persisted once for all folds; the best model is saved on strict
    improvement when a ``saver`` is given. Returns fold, accuracy, n_test.
    """
    from lodestar.operators.metrics import accuracy
    from lodestar.operators.sampling import train_test_split
    data = dealt(df, key).persist()
    rows = []
    try:
        for s in seeds:
            train, test = train_test_split(data, key, train_fraction, seed=int(s))
            model = build().fit(train)
            res = accuracy(score(model, test, [label]), label, "prediction").collect()[0]
            rows.append((int(s), float(res["accuracy"]), int(res["n"])))
            if saver is not None:
                saver.offer(model, float(res["accuracy"]))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double, n_test long")
