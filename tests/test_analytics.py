import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import aggregates, metrics, trials


def _log(spark, n_trials=12, max_steps=15, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(n_trials):
        for s in range(1, int(rng.integers(3, max_steps)) + 1):
            rows.append((t, s, float(np.round(rng.normal(t % 4, 1.0), 3))))
    return pd.DataFrame(rows, columns=["trial", "step", "metric"])


def test_box_stats_exact(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = aggregates.box_stats(ev, ["event_type"], "value").toPandas().set_index("event_type")
    pdf = ev.toPandas()
    for k, g in pdf.groupby("event_type"):
        assert abs(got.loc[k, "q1"] - g.value.quantile(0.25)) < 1e-9
        assert abs(got.loc[k, "median"] - g.value.median()) < 1e-9
        assert got.loc[k, "n"] == len(g)


def test_best_so_far_monotone(spark):
    pdf = _log(spark)
    curves = aggregates.best_so_far(spark.createDataFrame(pdf), "trial", ["step"], "metric", step="n").toPandas()
    for _, g in curves.sort_values("step").groupby("trial"):
        assert (np.diff(g.best.to_numpy()) >= 0).all()
        assert (g.best.to_numpy() == g.metric.cummax().to_numpy()).all()


def test_median_stopping_brute_force(spark):
    pdf = _log(spark, n_trials=10)
    got = trials.median_stopping(spark.createDataFrame(pdf), "trial", "step", "metric").toPandas().set_index("trial")
    pdf = pdf.sort_values(["trial", "step"])
    pdf["rm"] = pdf.groupby("trial").metric.transform(lambda s: s.expanding().mean()).round(9)
    for t, g in pdf.groupby("trial"):
        stop = None
        for _, row in g.iterrows():
            others = pdf[(pdf.step == row.step) & (pdf.trial != t)].rm
            if row.step > 1 and len(others) >= 3 and row.rm < others.median():
                stop = row.step
                break
        exp = got.loc[t, "stop_step"]
        assert (stop is None and pd.isna(exp)) or stop == exp


def test_successive_halving_counts(spark):
    pdf = _log(spark, n_trials=27, max_steps=30, seed=2)
    out = trials.successive_halving(spark.createDataFrame(pdf), "trial", "step", "metric", max_t=27).toPandas()
    for rung, g in out.groupby("rung"):
        assert g.promoted.sum() == len(g) // 3
        promoted_min = g[g.promoted].metric.min() if g.promoted.any() else np.inf
        assert (g[~g.promoted].metric <= promoted_min + 1e-12).all()
    r1 = set(out[(out.rung == 1) & out.promoted].trial)
    assert set(out[out.rung == 3].trial) <= r1


def test_param_importance_bounds(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.integers(0, 3, 300), "b": rng.integers(0, 3, 300)})
    pdf["score"] = pdf.a * 2.0 + rng.normal(0, 0.1, 300)
    out = trials.param_importance(spark.createDataFrame(pdf), ["a", "b"], "score").toPandas().set_index("param")
    assert out.loc["a", "eta_sq"] > 0.9 and out.loc["b", "eta_sq"] < 0.1 and out.loc["a", "rank"] == 1


def test_auc_and_regression_metrics(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 500)
    s = np.round(y * 0.5 + rng.random(500), 1)  # ties on purpose
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    got = metrics.auc_rank(df, "y", "s").collect()[0].auc
    ranks = pd.Series(s).rank()
    n1, n0 = y.sum(), len(y) - y.sum()
    assert abs(got - (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)) < 1e-12
    reg = metrics.regression_metrics(spark.createDataFrame(pd.DataFrame({"y": s, "p": s * 0.9})), "y", "p").collect()[0]
    assert abs(reg.rmse - np.sqrt(np.mean((s - 0.9 * s) ** 2))) < 1e-12
    assert reg.r2 <= 1.0


def test_search_space_tables(spark):
    sp = trials.SearchSpace({"max_depth": ("int", 3, 8), "lr": ("loguniform", 1e-3, 1.0), "kind": ("choice", ["a", "b"])})
    c1, c2 = sp.random(5, seed=0), sp.random(5, seed=0)
    assert c1 == c2 and all(3 <= c["max_depth"] <= 8 and 1e-3 <= c["lr"] <= 1 for c in c1)
    grid = trials.SearchSpace({"a": ("choice", [1, 2]), "b": ("choice", [3, 4, 5])}).grid()
    assert len(grid) == 6
    assert sp.to_frame(spark, c1).count() == 5
    assert trials.halving_rungs(50, 1, 3) == [1, 3, 9, 27]


def test_row_counts_query(spark):
    from lodestar.plans.queries import QUERIES
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    got = QUERIES["row_counts"](spark, SF_SMALL).collect()
    assert len(got) == 1
    assert got[0]["rows_loaded"] == li.count()
    assert 0 < got[0]["rows_clean"] <= got[0]["rows_loaded"]
    assert aggregates.row_count(li.filter("l_quantity > 25"), "n").collect()[0]["n"] == li.filter("l_quantity > 25").count()


def test_fused_trial_log_matches_two_scans(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("user_id", "trial")
    fused = trials.trial_log_running_mean(ev, "trial", ["ts", "event_id"], "value", out="rm").select(
        "event_id", "step", "rm").toPandas().sort_values("event_id").reset_index(drop=True)
    log = trials.trial_log(ev, "trial", ["ts", "event_id"], "value")
    two = trials.running_mean(log, "trial", "step", "value", out="rm").select(
        "event_id", "step", "rm").toPandas().sort_values("event_id").reset_index(drop=True)
    assert fused["step"].tolist() == two["step"].tolist()
    assert fused["rm"].tolist() == two["rm"].tolist()
