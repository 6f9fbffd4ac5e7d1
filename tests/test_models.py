import json

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import linear, models, neighbors, sampling
from lodestar.plans import queries


def test_linear_fit_matches_numpy(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("y", F.col("l_extendedprice") / 1000)
    feats = ["l_quantity", "l_discount", "l_tax"]
    fit = linear.fit_linear(li, feats, "y")
    pdf = li.select(*feats, "y").toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[feats].to_numpy()])
    beta = np.linalg.lstsq(x, pdf.y.to_numpy(), rcond=None)[0]
    assert np.allclose(beta[1:], fit.coef) and abs(beta[0] - fit.intercept) < 1e-8
    # contributions + mean prediction = prediction
    c = li.select(*[v.alias(k) for k, v in fit.contributions().items()], fit.prediction().alias("p")).toPandas()
    assert np.allclose(c.drop(columns="p").sum(axis=1) + fit.label_mean, c.p)


def test_ridge_cv_matches_refit(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("y", F.col("l_extendedprice") / 1000)
    li = li.withColumn("fold", sampling.kfold_column("l_orderkey", 3, seed=0))
    out = linear.ridge_cv(li, ["l_quantity"], "y", "fold", [0.0, 50.0]).toPandas()
    pdf = li.select("l_quantity", "y", "fold").toPandas()
    for _, row in out.iterrows():
        tr, te = pdf[pdf.fold != row.fold], pdf[pdf.fold == row.fold]
        xm, ym = tr.l_quantity.mean(), tr.y.mean()
        b = ((tr.l_quantity - xm) * (tr.y - ym)).sum() / (((tr.l_quantity - xm) ** 2).sum() + row["lambda"])
        a = ym - b * xm
        assert abs(((te.y - a - b * te.l_quantity) ** 2).mean() - row.mse) < 1e-8


@pytest.mark.parametrize("shape, pivots", [("loose", 1), ("loose", 7), ("clusters", 12), ("copies", 5)])
def test_knn_matches_brute_force_with_any_pivots(spark, shape, pivots):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(120, 5)).round(3)
    if shape == "clusters":
        pts = (pts + 40 * rng.integers(0, 4, size=(120, 1))).round(3)
    elif shape == "copies":
        pts[:60] = pts[0]
    df = spark.createDataFrame([(i, pts[i].tolist()) for i in range(len(pts))], "id long, v array<double>")
    got = neighbors.knn(df, df, "id", "v", k=4, include_self=False, pivots=pivots, block_rows=16).toPandas()
    assert len(got) == 480
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for q, g in got.groupby("query_id"):
        exp = np.lexsort((np.arange(len(pts)), d[q]))[:4]
        assert g.sort_values("rank").neighbor_id.tolist() == exp.tolist()


def test_knn_visits_few_cells_of_clustered_rows():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 50
    pts = centres[rng.integers(0, 20, 2_000)] + rng.normal(size=(2_000, 8))
    chosen = [0]
    while len(chosen) < 20:
        chosen.append(int(np.min([((pts - pts[c]) ** 2).sum(1) for c in chosen], axis=0).argmax()))
    dist, _ = neighbors._distances(pts, pts[chosen])
    own = dist.argmin(1)
    far = dist[np.arange(len(pts)), own]
    cells = neighbors.Cells(pts[chosen], np.bincount(own, minlength=20), *(
        np.array([f(far[own == c]) for c in range(20)]) for f in (np.min, np.max)))
    exact = np.sqrt(((pts[:200, None] - pts[None]) ** 2).sum(-1))
    kth = np.sort(exact, axis=1)[:, 4]
    least = cells.least(dist[:200])
    for c in range(20):
        assert (least[:, c] <= exact[:, own == c].min(axis=1) + 1e-6).all()
    assert (least <= kth[:, None]).sum(axis=1).mean() < 3  # of 20 cells


def _brute(ids, pts, k, include_self):
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    if not include_self:
        d[ids[:, None] == ids[None, :]] = np.inf
    return {int(ids[q]): [int(ids[x]) for x in np.lexsort((ids, d[q]))[:k]] for q in range(len(ids))}


@pytest.mark.parametrize("shape, passing", [("loose", True), ("plane", False), ("copies", False), ("grid", None)])
@pytest.mark.parametrize("include_self", [True, False])
def test_knn_in_boxes_matches_brute_force(spark, monkeypatch, shape, passing, include_self):
    rng = np.random.default_rng(3)
    n, width = 400, 24 if shape == "loose" else 2
    pts = rng.normal(size=(n, width)).round(3)
    if shape == "copies":
        pts[:150] = pts[0]
    elif shape == "grid":
        pts = rng.integers(0, 4, size=(n, width)).astype(float)
    ids = rng.permutation(n) * 3
    used = []
    plain = neighbors._passing
    monkeypatch.setattr(neighbors, "_passing", lambda *a: used.append(1) or plain(*a))
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, pts)], "id long, v array<double>").repartition(5)
    got = neighbors.knn(df, df, "id", "v", k=4, include_self=include_self, block_rows=16).collect()
    assert len(got) == 4 * n
    assert passing is None or bool(used) == passing
    want = _brute(ids, pts, 4, include_self)
    assert {(r.query_id, r["rank"], r.neighbor_id) for r in got} == {(q, i + 1, x) for q, near in want.items() for i, x in enumerate(near)}


def test_boxes_bound_their_rows_and_rule_out_most_of_evenly_spread_ones():
    rng = np.random.default_rng(5)
    pts = rng.random((20_000, 6))
    boxes = neighbors.Boxes.cut_at(pts[:2_000], 256)
    own, _ = boxes.place(pts)
    assert boxes.count == 256 and np.bincount(own, minlength=256).min() > 0
    boxes = boxes.sized(np.bincount(own, minlength=256), *(
        np.array([f(pts[own == c], axis=0) for c in range(256)]) for f in (np.min, np.max)))
    exact = ((pts[:100, None] - pts[None]) ** 2).sum(-1)
    least = boxes.least(pts[:100])
    assert all((least[:, c] <= exact[:, own == c].min(axis=1) + 1e-12).all() for c in range(256))
    kth = np.sqrt(np.sort(exact, axis=1)[:, 4])
    assert boxes.flags(pts[:100], 5, kth).sum(axis=1).mean() < 26  # of 256 cells


def test_visits_to_all_cells_come_in_small_batches():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    rows, width, count = 4_096, 32, 256
    cells = neighbors.Cells(rng.normal(size=(count, width)), np.full(count, 9), np.zeros(count), np.full(count, 1e9))
    batch = pa.RecordBatch.from_pydict({"qid": pa.array(range(rows), pa.int64()), "bound": pa.nulls(rows, pa.float64()),
                                        "qvec": pa.array(rng.normal(size=(rows, width)).tolist(), pa.list_(pa.float64()))})
    sizes = [b.num_rows for b in neighbors._visits(iter([batch]), cells, 5, True)]
    assert sum(sizes) == rows * (count - 1)
    assert max(sizes) * width <= 1 << 20


def test_knn_leaves_out_rows_without_distances(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.0, 3.0])],
                               "id long, v array<double>")
    got = neighbors.knn(df, df, "id", "v", k=3).collect()
    assert sorted((r.query_id, r["rank"], r.neighbor_id, r.distance) for r in got) == [(1, 1, 1, 0.0), (1, 2, 5, 2.0),
                                                                                    (5, 1, 5, 0.0), (5, 2, 1, 2.0)]


def test_knn_of_nothing(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [0.0, 1.0]), (2, None)], "id long, v array<double>")
    assert neighbors.knn(one, none, "id", "v").count() == 0
    assert neighbors.knn(none, one, "id", "v").count() == 0
    assert [tuple(r) for r in neighbors.knn(one, one, "id", "v", k=3).collect()] == [(1, 1, 0.0, 1)]


def test_rf_predictions_cover_test_rows(spark):
    pred = queries.rf_fit(spark, SF_SMALL)
    _, test = queries._delay_split(spark, SF_SMALL)
    assert pred.count() == test.count()
    assert pred.filter((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0


def test_gbt_beats_constant_baseline(spark):
    pred = queries.gbt_fit(spark, SF_SMALL).toPandas()
    rmse = np.sqrt(((pred.ArrDelay - pred.prediction) ** 2).mean())
    assert rmse < pred.ArrDelay.std()


def test_svd_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vecs, vals = models.truncated_svd(emb, "embedding", 64, k=3)
    x = np.stack(emb.toPandas().embedding.to_numpy()).astype(np.float64)
    assert np.allclose(vals, np.linalg.svd(x, compute_uv=False)[:3], rtol=1e-6)


def test_pca_components_are_centred(spark):
    out = queries.pca_fit(spark, SF_SMALL).toPandas()
    assert np.allclose(out[[f"pc{i}" for i in range(5)]].mean().to_numpy(), 0, atol=1e-6)


def test_request_scoring_flags_malformed(spark):
    from lodestar.streaming import score_requests
    model = queries._embedding_classifier(spark, SF_SMALL)
    width = model.numFeatures  # whole vectors
    reqs = spark.createDataFrame([(1, json.dumps([[0.1] * width, [0.2] * width])), (2, "not json"),
                                  (3, json.dumps([[0.1] * 3])), (4, "[]"), (5, None)], "rid long, body string")
    out = score_requests(model, reqs, "rid", "body", n_features=width, threshold=0.5).toPandas()
    assert set(out[out.status == "ok"].rid) == {1} and len(out[out.rid == 1]) == 2
    assert sorted(out[out.status == "unsupported"].rid) == [2, 3, 4, 5] and out[out.status == "unsupported"].prediction.isna().all()
    apart = score_requests(model, reqs.where("rid <> 3"), "rid", "body", threshold=0.5).toPandas()
    assert sorted(apart[apart.status == "unsupported"].rid) == [2, 4, 5] and len(apart[apart.rid == 1]) == 2
    assert set(out[out.status == "ok"].prediction) <= {0.0, 1.0}


def test_stream_scoring_scores_every_row(spark):
    out = queries.stream_score(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
    assert out.count() == n and out.select("vec_id").distinct().count() == n


def test_sampled_shapley_efficiency(spark):
    from lodestar.operators import explain
    df = spark.createDataFrame(pd.DataFrame({"id": range(40), "a": np.arange(40.0), "b": np.arange(40.0) % 7}))
    fit = linear.fit_linear(df.withColumn("y", F.col("a") * 2 + F.col("b")), ["a", "b"], "y")

    class M:
        def transform(self, d):
            return d.withColumn("prediction", fit.prediction())
    phi = explain.sampled_shapley(M(), df.filter("id < 5"), df, "id", ["a", "b"], n_samples=8).toPandas()
    assert len(phi) == 10
    assert phi.phi.notna().all()


def test_best_model_saver_and_reload(spark):
    from lodestar.session import shared_path
    df = spark.createDataFrame(pd.DataFrame({"a": np.arange(50.0), "y": np.arange(50.0) * 2 + 1}))
    model = models.scaled_linear(["a"], "y").fit(df)
    path = shared_path(spark, "t_best_model", unique=True)
    saver = models.BestModelSaver(path)
    assert saver.offer(model, 0.5) and not saver.offer(model, 0.5) and saver.offer(model, 0.7)
    assert not saver.offer(model, float("nan"))
    again = models.load_model(path)
    p = again.transform(df).select("prediction").toPandas().prediction.to_numpy()
    assert np.allclose(p, np.arange(50.0) * 2 + 1)


def test_sampled_interactions_of_additive_model_vanish(spark):
    from lodestar.operators import explain
    pdf = pd.DataFrame({"id": range(30), "a": np.arange(30.0), "b": np.arange(30.0) % 5, "c": np.arange(30.0) % 3})
    df = spark.createDataFrame(pdf)

    class Additive:
        def transform(self, d):
            return d.withColumn("prediction", F.col("a") * 2 + F.col("b") - F.col("c"))

    class Product:
        def transform(self, d):
            return d.withColumn("prediction", F.col("a") * F.col("b"))
    add = explain.sampled_interactions(Additive(), df.filter("id < 4"), df, "id", ["a", "b", "c"], n_samples=4).toPandas()
    assert len(add) == 4 * 6 and np.allclose(add.value, 0.0)
    prod = explain.sampled_interactions(Product(), df.filter("id < 4"), df, "id", ["a", "b", "c"], n_samples=4).toPandas()
    ab = prod[(prod.feature_i == "a") & (prod.feature_j == "b")].set_index("id").value
    ba = prod[(prod.feature_i == "b") & (prod.feature_j == "a")].set_index("id").value
    assert np.allclose(ab, ba) and (prod[prod.feature_i == "c"].value.abs() < 1e-9).all()


def test_request_scoring_in_a_stream(spark):
    from lodestar.session import shared_path
    from lodestar.streaming import score_requests
    model = queries._embedding_classifier(spark, SF_SMALL)
    base = shared_path(spark, "t_req_stream", unique=True)
    reqs = spark.createDataFrame([(1, json.dumps([[0.1] * model.numFeatures])), (2, "oops"), (3, json.dumps([[0.3] * model.numFeatures, [0.0] * model.numFeatures]))],
                                 "rid long, body string")
    reqs.coalesce(1).write.json(f"{base}/in")
    stream = spark.readStream.schema("rid long, body string").option("maxFilesPerTrigger", 1).json(f"{base}/in")
    out = score_requests(model, stream, "rid", "body", n_features=model.numFeatures, threshold=0.5)
    q = (out.writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination(300)
    res = spark.read.parquet(f"{base}/out").toPandas()
    assert sorted(res[res.status == "ok"].rid.tolist()) == [1, 3, 3]
    assert res[res.status == "unsupported"].rid.tolist() == [2]


def test_hyperparameters_default_when_missing(tmp_path):
    defaults = {"n_estimators": 10, "max_depth": 5, "lr": 0.3}
    assert models.load_hyperparameters(str(tmp_path / "absent.json"), defaults) == defaults
    p = tmp_path / "hp.json"
    p.write_text(json.dumps({"max_depth": "8", "extra": 1}))
    got = models.load_hyperparameters(str(p), defaults)
    assert got["max_depth"] == 8 and got["n_estimators"] == 10 and got["extra"] == 1


def test_holdout_cv_fold_table(spark):
    out = queries.holdout_cv(spark, SF_SMALL).toPandas()
    assert sorted(out.fold) == [0, 1, 2] and ((out.accuracy > 0) & (out.accuracy <= 1)).all()
    assert abs(out.mean_score.iloc[0] - out.accuracy.mean()) < 1e-12


def test_shapley_query_explains_every_heldout_row(spark):
    from conftest import SF_SMALL
    from lodestar.operators import sampling
    from lodestar.plans import fixtures
    from lodestar.plans.queries import QUERIES, delay_days_table
    _, test = sampling.train_test_split(delay_days_table(spark, SF_SMALL), "flight_id", 0.8, seed=0)
    phi = QUERIES["tree_shap_sampled"](spark, SF_SMALL)
    n_test = test.count()
    assert phi.select("flight_id").distinct().count() == n_test
    assert phi.count() == n_test * len(fixtures.FLIGHT_FEATURES)
