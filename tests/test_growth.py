"""Work and memory that must not grow faster than the tables: parts, kept columns, joins on few categories, scored hybrids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import encoder_stages, encoders, explain, models, newton_trees
from lodestar.plans import fixtures, queries, workflows


def test_only_inputs_of_engineered_rows_are_kept(spark, monkeypatch):
    cols = {c: F.col("id") % (i + 2) for i, c in enumerate(fixtures.FLIGHT_FEATURES)}
    rows = spark.range(200).select(F.col("id").alias("flight_id"), (F.col("id") % 2).alias(workflows.LABEL), *(v.alias(c) for c, v in cols.items()))
    monkeypatch.setattr(queries, "delay_table", lambda *_: rows)
    train, test, feats, kept = workflows.engineered_flights(spark, "")
    assert len(feats) == 66 and train.count() + test.count() == 200
    assert [set(k.columns) for k in kept] == [{"flight_id", workflows.LABEL, *fixtures.FLIGHT_FEATURES, "Origin_te"}] * 2
    assert not train.is_cached and len(train.first()[workflows.VEC]) == 66
    for k in kept:
        k.unpersist()


def test_large_fits_run_one_after_the_other():
    assert models.fits_at_once(480_000, [66] * 10) > 1
    assert models.fits_at_once(28_800_000, [66] * 10) == 1
    assert models.fits_at_once(10, [3, 4]) == 2


def test_grid_search_reads_kept_rows(spark, monkeypatch):
    rows = spark.range(60).select(F.col("id").alias("flight_id"), (F.col("id") % 2).cast("double").alias("ArrDelayBinary"))
    monkeypatch.setattr(queries, "_delay_split", lambda *_: (rows, rows))
    monkeypatch.setattr(models, "grid_search", lambda est, grid, train, *a, **k: train.storageLevel.useMemory)
    assert queries.grid_search(spark, "") is True


def test_parts_grow_with_the_rows(spark, monkeypatch):
    rows = spark.range(400)
    assert models.dealt(rows, "id").rdd.getNumPartitions() == 16
    monkeypatch.setattr(models, "PART_ROWS", 10)
    assert models.dealt(rows, "id").rdd.getNumPartitions() == 40


def test_an_estimator_may_be_made_from_the_kept_rows(spark):
    rows = spark.range(30).select(F.col("id"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    seen = []
    models.fit_cached(lambda n: seen.append(n) or models.logistic_regression(["x"], "y", n_rows=n), rows.coalesce(1))
    assert seen == [30]


@pytest.mark.parametrize("pairs", [False, True])
def test_shared_coalitions_are_scored_once(spark, pairs):
    feats = ["a", "b", "c", "d"]
    weight = dict(zip(feats, (1.0, -2.0, 3.0, 0.5)))
    seen = []

    class Model:
        def transform(self, df):
            seen.append(df.count())
            return df.withColumn("prediction", sum(F.col(f) * w for f, w in weight.items()) + F.col("a") * F.col("b"))
    rows = spark.range(6).select("id", *((F.col("id") * (i + 1) + 1.0).alias(f) for i, f in enumerate(feats))).coalesce(1)
    ground = spark.range(1).select(*(F.lit(0.0).alias(f) for f in feats))
    if pairs:
        got = {tuple(r)[:3]: r["value"] for r in explain.sampled_interactions(Model(), rows, ground, "id", feats, n_samples=2).collect()}
        assert seen == [6 * 2 * 11]  # 10 sets of a prefix and one more, and the empty one; 6 pairs of 4 before
        for i in range(6):
            assert got[i, "a", "b"] == pytest.approx((i + 1) * (2 * i + 1) / 2) and got[i, "c", "d"] == pytest.approx(0)
    else:
        got = {tuple(r)[:2]: r["phi"] for r in explain.sampled_shapley(Model(), rows, ground, "id", feats, n_samples=2).collect()}
        assert seen == [6 * 2 * 5]  # prefixes; 8 with and without before
        for i in range(6):
            assert got[i, "c"] == pytest.approx(3 * (3 * i + 1)) and got[i, "d"] == pytest.approx((4 * i + 1) / 2)


def test_joins_on_few_categories_send_the_sums(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).select("id", (F.col("id") % 3).alias("c"), (F.col("id") % 2).alias("y"), (F.col("id") % 5).alias("fold"))
        stages = encoder_stages.TargetMeanEncoder(inputCols=["c"], outputCols=["m"], labelCol="y", foldCol="fold").fit(rows).transform(rows)
        codes = encoder_stages.DictionaryEncoder(inputCols=["c"], outputCols=["k"]).fit(rows).transform(rows)
        for df in (encoders.target_encode_oof(rows, "c", "y", "fold"), encoders.target_encode_apply(rows, rows, "c", "y"), stages, codes):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
            assert joins and all("rightHint=(strategy=broadcast)" in line for line in joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_boosted_trees_train_on_even_parts(spark, monkeypatch):
    parts, grow = [], newton_trees._grow
    monkeypatch.setattr(newton_trees, "_grow", lambda state, *a: parts.append(state.rdd.getNumPartitions()) or grow(state, *a))
    rows = spark.range(300).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("double").alias("y")).coalesce(1)
    params = newton_trees.NewtonParams(rounds=2, max_depth=2)
    wide = newton_trees.fit_newton(rows, ["x"], "y", params)
    assert parts == [spark.sparkContext.defaultParallelism] * 2
    monkeypatch.setattr(newton_trees, "PART_ROWS", 10)
    assert newton_trees.fit_newton(rows, ["x"], "y", params).trees[1].value == wide.trees[1].value
    assert parts[-1] == 30


def test_whole_sums_are_exact():
    rng = np.random.default_rng(0)
    code, values = rng.integers(0, 5, 1_000), rng.integers(-2**50, 2**50, 1_000)
    want = np.zeros(5, np.int64)
    np.add.at(want, code, values)
    assert (newton_trees._whole_sums(code, values, 6) == [*want, 0]).all()


def test_trees_are_explained_without_hybrids(spark, monkeypatch):
    feats = ["a", "b", "c"]
    rows = spark.range(300).select((F.col("id") % 290).alias("id"), *((F.col("id") * (7 * i + 3) % (11 + i)).cast("double").alias(f) for i, f in enumerate(feats))).coalesce(2)
    model = models.boosted_trees(feats, "y", task="regression", n_rounds=3, max_depth=3).fit(rows.withColumn("y", F.col("a") * F.col("b") - F.col("c")))
    odd = rows.withColumn("b", F.when(F.col("a") == 3, None).otherwise(F.col("b"))).unionByName(rows.limit(3).withColumn("id", F.lit(None).cast("bigint")))
    ground, fast, seen = rows.limit(20), explain._tree_tables, []
    monkeypatch.setattr(type(model), "transform", lambda *a: seen.append(1) or pytest.fail("hybrids"))
    got = [{tuple(r)[:-1]: r[-1] for r in f(model, odd, ground, "id", feats, n_samples=4).collect()} for f in (explain.sampled_shapley, explain.sampled_interactions)]
    monkeypatch.undo()
    assert fast(model, feats, "other") is None and not seen
    monkeypatch.setattr(explain, "_tree_tables", lambda *_: None)
    for mine, f in zip(got, (explain.sampled_shapley, explain.sampled_interactions)):
        want = {tuple(r)[:-1]: r[-1] for r in f(model, odd, ground, "id", feats, n_samples=4).collect()}
        assert len(want) in (291 * 3, 291 * 6) and mine == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
