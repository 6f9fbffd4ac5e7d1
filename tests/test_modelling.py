"""Encoder stages, calibrated margins, coalitions, silhouettes, asynchronous halving and planned reads."""

import itertools
import math

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from lodestar import sources
from lodestar.operators import encoder_stages, explain, linear, metrics, models, trials
from lodestar.plans import modelling
from lodestar.plans.catalog import table_path


# ------------------------------------------------------------------ encoders
TRAIN = [(i, "abcab"[i % 5], None if i % 7 == 0 else i % 3, float(i % 2), i % 4) for i in range(60)]


def test_encoders_leave_a_training_rows_fold_out(spark, tmp_path):
    train = spark.createDataFrame(TRAIN, "id long, c string, d int, y double, fold int")
    stages = [encoder_stages.DictionaryEncoder(inputCols=["c", "d"], outputCols=["c_code", "d_code"]),
              encoder_stages.TargetMeanEncoder(inputCols=["c", "d"], outputCols=["c_mean", "d_mean"], labelCol="y", smooth=2.0, foldCol="fold")]
    fitted = Pipeline(stages=stages).fit(train)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert loaded.stages[1].getOrDefault("smooth") == 2.0
    mean = np.mean([t[3] for t in TRAIN])

    def want(value, column, fold):
        rows = [t for t in TRAIN if t[column] == value and value is not None and t[4] != fold]
        return (sum(t[3] for t in rows) + 2 * mean) / (len(rows) + 2) if rows else mean

    got = {x["id"]: x for x in loaded.transform(train).collect()}
    assert len(got) == 60
    for i, c, d, _, fold in TRAIN:
        assert got[i]["c_code"] == "abc".index(c) and got[i]["d_code"] == (-1 if d is None else d)
        assert abs(got[i]["c_mean"] - want(c, 1, fold)) < 1e-12 and abs(got[i]["d_mean"] - want(d, 2, fold)) < 1e-12
    new = spark.createDataFrame([(1, "a", None), (2, "zzz", 1), (3, None, 9)], "id long, c string, d int")
    out = {x["id"]: x for x in fitted.transform(new).collect()}
    assert [(out[i]["c_code"], out[i]["d_code"]) for i in (1, 2, 3)] == [(0, -1), (3, 1), (-1, 3)]
    assert abs(out[1]["c_mean"] - want("a", 1, None)) < 1e-12 and out[2]["c_mean"] == out[3]["c_mean"] == mean


def test_encoders_of_an_empty_table(spark):
    none = spark.createDataFrame([], "c string, y double")
    model = encoder_stages.TargetMeanEncoder(inputCols=["c"], outputCols=["m"], labelCol="y").fit(none)
    assert [x["m"] for x in model.transform(spark.createDataFrame([("a",)], "c string")).collect()] == [None]
    model = encoder_stages.DictionaryEncoder(inputCols=["c"], outputCols=["m"]).fit(none)
    assert [x["m"] for x in model.transform(spark.createDataFrame([("a",), (None,)], "c string")).orderBy("c").collect()] == [-1, 0]


# ------------------------------------------------------------------ fits
def test_coordinate_descent_meets_the_optimality_conditions(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)) * [1, 5, 0.1, 1, 0] + 1e6
    x[:, 3] = x[:, 0]  # collinear, and a constant column
    y = 3 * (x[:, 0] - 1e6) - (x[:, 1] - 1e6) + rng.normal(size=300)
    names = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{n} double" for n in names) + ", y double")
    centred, label = x - x.mean(0), y - y.mean()
    for ratio in (1.0, 0.5):
        for alpha, fit in linear.coordinate_path(df, names, "y", [2.0, 0.2, 0.01], ratio):
            slope = centred.T @ (label - centred @ fit.coef) / 300 - alpha * (1 - ratio) * fit.coef
            on = fit.coef != 0
            assert np.allclose(slope[on], alpha * ratio * np.sign(fit.coef[on]), atol=1e-5)
            assert (np.abs(slope[~on]) <= alpha * ratio + 1e-5).all()
    with pytest.raises(ValueError):
        linear.coordinate_path(df.limit(0), names, "y", [1.0])


def test_sampled_trees_do_not_depend_on_the_files(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(size=3)), float(rng.integers(0, 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    est = models.random_forest(["a", "b", "c"], "y", n_estimators=4, max_depth=4, max_features=0.6, bootstrap=True, seed=3)
    fits = [models.score(models.fit_cached(est, df.repartition(n), key="id"), df, ["id"]).orderBy("id").collect() for n in (1, 5)]
    assert fits[0] == fits[1]


def test_sigmoid_probabilities_are_calibrated(spark):
    rng = np.random.default_rng(2)
    margin = rng.normal(size=4000) * 2
    y = rng.random(4000) < 1 / (1 + np.exp(-(1.5 * margin - 0.5)))
    slope, constant = models.fit_sigmoid(margin, np.ones(4000), y.astype(float))
    assert abs(slope - 1.5) < 0.15 and abs(constant + 0.5) < 0.15
    assert all(map(math.isfinite, models.fit_sigmoid(np.array([-1.0, 1.0]), np.array([5.0, 5.0]), np.array([0.0, 5.0]))))
    x = rng.normal(size=(600, 2))
    t = (x[:, 0] + rng.normal(size=600) * 0.8 > 0).astype(float)
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame([(i, list(map(float, v)), float(s), i % 3) for i, (v, s) in enumerate(zip(x, t))],
                               "id int, v array<double>, y double, fold int").withColumn("rff", array_to_vector("v"))
    scored = models.calibrated_svc(df.where("id < 400"), "y", "fold", C=1.0).transform(df.where("id >= 400"), ["id", "y"]).toPandas()
    bins = scored.groupby((scored.prob * 4).astype(int).clip(0, 3))
    error = sum(len(b) * abs(b.prob.mean() - b.y.mean()) for _, b in bins) / len(scored)
    assert error < 0.1 and scored.prob.between(0, 1).all()


# ------------------------------------------------------------------ explanations
def test_coalition_projection_gives_shapley_values():
    rng = np.random.default_rng(1)
    for p in (1, 2, 3, 5):
        v = rng.normal(size=1 << p)
        want = np.zeros(p)
        for i in range(p):
            for s in itertools.chain.from_iterable(itertools.combinations([j for j in range(p) if j != i], n) for n in range(p)):
                m = sum(1 << j for j in s)
                want[i] += math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p) * (v[m | 1 << i] - v[m])
        assert np.allclose(v @ explain.coalition_projection(p), want)


def test_coalition_values_of_a_product(spark):
    rows = spark.createDataFrame([(1, 2.0, 3.0), (2, 0.0, 5.0)], "id int, a double, b double")
    ground = spark.createDataFrame([(0.0, 1.0, 1.0), (2.0, 1.0, 3.0)], "a double, b double, w double")
    got = {(x["id"], x["feature"]): x["phi"] for x in explain.coalition_shapley(
        lambda df: df.withColumn("prediction", F.col("a") * F.col("b")), rows, ground, "id", ["a", "b"], "w").collect()}
    mean_a, mean_b, base = 1.5, 1.0, 1.5
    for i, a, b in ((1, 2.0, 3.0), (2, 0.0, 5.0)):
        only_a, only_b, both = a * mean_b, mean_a * b, a * b
        assert abs(got[i, "a"] - (only_a - base + both - only_b) / 2) < 1e-12
        assert abs(got[i, "a"] + got[i, "b"] - (both - base)) < 1e-12
    with pytest.raises(ValueError):
        explain.coalition_shapley(lambda df: df, rows, ground.limit(0), "id", ["a", "b"])


# ------------------------------------------------------------------ clusters, searches, reads
def test_silhouette_of_lone_rows_and_nothing(spark):
    df = spark.createDataFrame([([0.0, 0.0], 1), ([0.0, 2.0], 1), ([5.0, 0.0], 2), (None, 1)], "v array<double>, c int")
    got = {x["c"]: (x["n"], x["silhouette"]) for x in metrics.silhouette(df, "v", "c").collect()}
    first, second = (25 - 4) / 25, (29 - 4) / 29
    assert got[2] == (1, 0.0) and abs(got[1][1] - (first + second) / 2) < 1e-12 and got[None][0] == 3
    assert metrics.silhouette(df.limit(0), "v", "c").where("n > 0").count() == 0


def test_async_halving_takes_reports_as_they_arrive(spark):
    reports = [(t, s, t, 100 * s + t, 0) for t in range(1, 7) for s in (1, 3)]  # later trials are better, and report later
    df = spark.createDataFrame(reports + [(9, 1, None, 999, 0)], "trial int, step int, score int, at int, bracket int")
    got = {(x["trial"], x["rung"]): (x["cutoff"], x["stopped"]) for x in trials.async_halving(
        df.withColumn("score", F.col("score").cast("double")), "trial", "step", "score", "at", "bracket", brackets=1, max_t=9).collect()}
    assert not any(stopped for _, stopped in got.values()) and got[1, 1][0] is None and len(got) == 12
    assert abs(got[4, 1][0] - (1 + 2 / 3 * 2)) < 1e-12
    worst_first = df.withColumn("score", -F.col("score").cast("double"))
    got = {(x["trial"], x["rung"]): x["stopped"] for x in trials.async_halving(
        worst_first, "trial", "step", "score", "at", "bracket", brackets=1, max_t=9).collect()}
    assert not got[1, 1] and all(got[t, 1] for t in range(2, 7)) and [k for k in got if k[1] == 3] == [(1, 3)]
    lowest = trials.async_halving(df.withColumn("score", F.col("score").cast("double")), "trial", "step", "score", "at", "bracket",
                                  brackets=1, max_t=9, mode="min").collect()
    assert {x["trial"] for x in lowest if x["stopped"]} == set(range(2, 7))


def test_parallel_table_of_equal_values(spark):
    df = spark.createDataFrame([(1, 3, 0.5), (2, 3, 1.5)], "trial int, p int, score double")
    assert sorted(map(tuple, trials.parallel_table(df, "trial", ["p"], "score").collect())) == [(1, 0.5, 0.0), (2, 0.5, 1.0)]


def test_planned_reads(spark):
    path = table_path(SF_SMALL, "lineitem")
    plan = sources.plan_scan(spark, path, target_bytes=16 << 10)
    assert plan.files == 1 and plan.partitions == math.ceil((plan.bytes + plan.open_cost) / plan.split_bytes) > 4
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sources.planned_reads(spark, plan):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(plan.split_bytes)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_whole_queries(spark):
    scored = modelling.svm_probability(spark, SF_SMALL).toPandas()
    assert scored.prob.between(0, 1).all() and len(scored)
    row = modelling.kmeans_quality(spark, SF_SMALL).first()
    assert 0 < row["purity"] <= 1 and -1 <= row["silhouette"] <= 1
    fare = modelling.taxi_regression(spark, SF_SMALL).first()
    assert fare["n"] > 500 and -0.3 < fare["r2"] <= 1  # fares of these trips don't depend on them


def test_full_feature_search_refits_its_best_trial(spark):
    from lodestar.plans import workflows
    rows = workflows.full_feature_search(spark, SF_SMALL, n_trials=2, max_iter=5).collect()
    trials_, refit = [x for x in rows if x["state"] != "refit"], [x for x in rows if x["state"] == "refit"]
    assert len(trials_) == 2 and len(refit) == 1
    best = max((x for x in trials_ if x["state"] == "complete"), key=lambda x: x["auc"])
    assert all(refit[0][c] == best[c] for c in ("trial_id", "k", "penalty", "C", "l1_ratio", "fit_intercept", "features"))
    assert all(len(x["features"].split(",")) == x["k"] for x in rows) and any("_mean" in x["features"] for x in rows)


def test_sums_are_scored_from_their_parts(spark):
    from lodestar.operators import selection
    from lodestar.plans import workflows
    df = spark.createDataFrame([(float(i % 3), float(i % 5), 0.0, i % 2) for i in range(40)], "a double, b double, z double, y int")
    df = df.withColumns({"a+b": F.col("a") + F.col("b"), "a+z": F.col("a") + F.col("z"), "b+z": F.col("b") + F.col("z")})
    want = {x["feature"]: x["chi2"] or 0.0 for x in selection.chi2_scores(df, ["a", "b", "z", "a+b", "a+z", "b+z"], "y").collect()}
    got = dict(workflows.pair_scores(df, ["a", "b", "z"], "y"))
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in want)
