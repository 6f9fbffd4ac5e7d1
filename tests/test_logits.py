"""Logistic regressions fitted together over packed rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestar.operators import logits, models, sampling
from lodestar.plans import fixtures, queries, workflows


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 3_000
    x = pd.DataFrame({"a": rng.normal(50, 9, n), "b": rng.integers(0, 7, n).astype(float), "c": rng.integers(1990, 1999, n), "d": 4.0})
    x["y"] = (0.1 * (x.a - 50) + 0.5 * x.b - 2 + rng.normal(size=n) > 0).astype(float)
    return spark.createDataFrame(x.assign(id=np.arange(n), fold=(np.arange(n) % 3).astype("int32"))).repartition(5).persist()


@pytest.mark.parametrize("reg,mix,intercept", [(0.0, 0.0, True), (0.02, 0.0, True), (0.02, 1.0, True), (0.01, 0.4, True), (0.02, 0.0, False), (0.02, 1.0, False)])
def test_a_fit_is_spark_s(rows, reg, mix, intercept):
    feats = [(0,), (1,), (3,), (0, 1), (1, 2)]
    names = ["a", "b", "c", "d"]
    wide = rows.select("y", *(sum(F.col(names[i]) for i in f).alias(f"f{k}") for k, f in enumerate(feats)))
    est = models.logistic_regression([f"f{k}" for k in range(5)], "y", n_rows=1, max_iter=40)
    want = est.copy({est.getStages()[-1].regParam: reg, est.getStages()[-1].elasticNetParam: mix, est.getStages()[-1].fitIntercept: intercept}).fit(wide).stages[-1]
    kept = logits.blocks(rows, names, "y")
    [got] = logits.fit(kept, 4, [logits.Spec(tuple(feats), reg, mix, intercept, 40)])
    kept.unpersist()
    inputs = np.zeros(4)
    for w, f in zip(want.coefficients.toArray(), feats):
        inputs[list(f)] += w
    assert got.weights == pytest.approx(inputs, rel=2e-3, abs=1e-5) and got.intercept == pytest.approx(want.intercept, rel=2e-3, abs=1e-5)


def test_models_share_passes_and_leave_their_fold_out(rows, monkeypatch):
    spec = logits.Spec(((0,), (1,)), 0.01, without=2)
    kept, passes, real = logits.blocks(rows, ["a", "b"], "y", "fold"), [], logits._sums
    monkeypatch.setattr(logits, "_sums", lambda *a: passes.append(1) or real(*a))
    alone = logits.fit(kept, 2, [spec])
    one = len(passes)
    many = logits.fit(kept, 2, [spec._replace(reg=r) for r in (0.01, 0.1, 1.0)] + [spec])
    assert len(passes) < 3 * one and many[3].weights == pytest.approx(alone[0].weights)
    part = logits.blocks(rows.where("fold <> 2"), ["a", "b"], "y")
    assert many[1].weights == pytest.approx(logits.fit(part, 2, [logits.Spec(((0,), (1,)), 0.1)])[0].weights)
    for k in (kept, part):
        k.unpersist()


def test_areas_are_exact_with_ties_over_several_buckets(rows, monkeypatch):
    monkeypatch.setattr(logits, "BUCKET_ROWS", 400)
    monkeypatch.setattr(logits, "BLOCK_ROWS", 500)
    fits = [logits.Fit(np.array([0.1, 0.0]), -5.0), logits.Fit(np.array([0.0, 1.0]), 0.0), logits.Fit(np.zeros(2), 1.0)]
    kept = logits.blocks(rows, ["a", "b"], "y")
    got = logits.areas(kept, fits)
    assert got == pytest.approx([models.auc(rows.select("y", f.probability(["a", "b"]).alias("prob")), "y") for f in fits], abs=1e-12)
    assert got[2] == 0.5
    kept.unpersist()


def test_rows_that_are_not_whole_are_left_to_single_fits(rows):
    for odd in (rows.withColumn("a", F.when(F.col("id") == 7, None).otherwise(F.col("a"))), rows.withColumn("y", F.lit(1.0)), rows.where("id < 0")):
        kept = logits.blocks(odd, ["a", "b"], "y")
        with pytest.raises(logits.Unfit):
            logits.fit(kept, 2, [logits.Spec(((0,), (1,)))])
        kept.unpersist()


def test_searches_fit_no_model_alone(spark, monkeypatch):
    cols = {c: (F.col("id") * (2 * i + 3)) % (i + 5) for i, c in enumerate(fixtures.FLIGHT_FEATURES)}
    flights = spark.range(400).select(F.col("id").alias("flight_id"), (F.col("id") % 7 % 2).cast("double").alias(workflows.LABEL), *(v.alias(c) for c, v in cols.items()))
    monkeypatch.setattr(queries, "delay_table", lambda *_: flights)

    def alone(*_, **__):
        raise AssertionError("a fit of its own")
    monkeypatch.setattr(models, "score", alone)
    monkeypatch.setattr(models, "auc", alone)
    assert {r["state"] for r in workflows.feature_search(spark, "", n_trials=3).collect()} == {"complete"}
    assert [r["state"] for r in workflows.full_feature_search(spark, "", n_trials=2, max_iter=5).collect()].count("refit") == 1


def test_grid_search_equals_single_fits(spark, rows, monkeypatch):
    est, grid = models.logistic_regression(["a", "b"], "y", n_rows=3_000), {"regParam": [0.0, 0.05], "elasticNetParam": [0.0, 1.0]}
    together = models.grid_search(est, grid, rows, "y", "fold").collect()
    monkeypatch.setattr(models, "_logit_fold_means", lambda *_: None)
    for a, b in zip(together, models.grid_search(est, grid, rows, "y", "fold").collect()):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-6)
