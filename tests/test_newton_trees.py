"""Second-order boosted trees against a plain version, and exact explanations against subset enumeration."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import newton_trees as nt


def table(n, p, seed, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)), 1)
    x[:, 0] = np.round(x[:, 0])
    x[rng.random((n, p)) < missing] = np.nan
    z = np.nan_to_num(x[:, 0]) - np.nan_to_num(x[:, 1 % p]) * np.nan_to_num(x[:, 2 % p]) + rng.normal(size=n) * 0.5
    return x, z


def frame(spark, x, y, parts):
    rows = [(i, *(None if math.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} double" for f in names) + ", y double").repartition(parts), names


def plain_tree(x, g, h, p, depth):
    """(feature, threshold, missing left, left, right) or a leaf's weight, by trying every cut."""
    shrunk = lambda s: math.copysign(max(abs(s) - p.reg_alpha, 0), s)
    score = lambda a, b: shrunk(a) ** 2 / (b + p.reg_lambda)
    leaf = -p.learning_rate * shrunk(g.sum()) / (h.sum() + p.reg_lambda)
    best = None
    for f in range(x.shape[1]) if depth else ():
        v = x[:, f]
        for t in np.unique(v[~np.isnan(v)]):
            for miss_left in (True, False):
                left = np.where(np.isnan(v), miss_left, v <= t)
                if not 0 < left.sum() < len(left) or min(h[left].sum(), h[~left].sum()) < p.min_child_weight - 1e-9:
                    continue
                gain = (score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum())
                        - score(g.sum(), h.sum())) / 2 - p.gamma
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, t, miss_left, left)
    if best is None:
        return leaf
    _, f, t, miss_left, left = best
    return f, t, miss_left, *(plain_tree(x[s], g[s], h[s], p, depth - 1) for s in (left, ~left))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        f, t, miss_left, a, b = tree
        tree = a if (miss_left if math.isnan(row[f]) else row[f] <= t) else b
    return tree


def plain_fit(x, y, p):
    margin = np.full(len(y), y.mean() if p.objective == "regression" else math.log(y.mean() / (1 - y.mean())))
    for _ in range(p.rounds):
        q = margin if p.objective == "regression" else 1 / (1 + np.exp(-margin))
        h = np.ones(len(y)) if p.objective == "regression" else q * (1 - q)
        tree = plain_tree(x, q - y, h, p, p.max_depth)
        margin = margin + np.array([plain_value(tree, r) for r in x])
    return margin


@pytest.mark.parametrize("objective", ["binary", "regression"])
def test_fit_equals_a_plain_version(spark, objective):
    x, z = table(250, 4, 1)
    y = (z > 0).astype(float) if objective == "binary" else z * 100
    p = nt.NewtonParams(objective=objective, rounds=3, max_depth=3, reg_lambda=1.5, reg_alpha=0.3, gamma=0.05, min_child_weight=2.0)
    df, names = frame(spark, x, y, 5)
    model = nt.fit_newton(df, names, "y", p)
    got = {r["id"]: r["margin"] for r in model.transform(df, ["id"]).collect()}
    assert np.allclose([got[i] for i in range(len(y))], plain_fit(x, y, p), atol=1e-6 * max(1, abs(y).max()))


def test_trees_do_not_depend_on_partitions_and_samples_come_from_ids(spark):
    x, z = table(400, 5, 2)
    p = nt.NewtonParams(rounds=3, max_depth=4, subsample=0.7, colsample_bytree=0.6, colsample_bylevel=0.7, checkpoint_every=2)
    fits = []
    for parts in (1, 7):
        df, names = frame(spark, x, (z > 0).astype(float), parts)
        fits.append(nt.fit_newton(df, names, "y", p, id_col="id").trees)
    assert fits[0] == fits[1] or repr(fits[0]) == repr(fits[1])
    assert all(200 < t.rows[0] < 350 for t in fits[0])


def plain_games(model, row):
    """Contributions and interactions of a row by enumerating all sets of features."""
    p = len(model.features)

    def value(t, at, known):
        f = t.feature[at]
        if f < 0:
            return t.value[at]
        kids = (t.left[at], t.right[at])
        if f in known:
            left = t.missing_left[at] if math.isnan(row[f]) else row[f] <= t.threshold[at]
            return value(t, kids[0] if left else kids[1], known)
        return sum(t.cover[k] / t.cover[at] * value(t, k, known) for k in kids)

    v = {s: sum(value(t, 0, s) for t in model.trees) for n in range(p + 1) for s in map(frozenset, itertools.combinations(range(p), n))}
    phi, both = np.zeros(p), np.zeros((p, p))
    for i in range(p):
        for s in (s for s in v if i not in s):
            w = math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p)
            phi[i] += w * (v[s | {i}] - v[s])
        for j in range(p):
            for s in (s for s in v if i != j and i not in s and j not in s):
                w = math.factorial(len(s)) * math.factorial(p - len(s) - 2) / (2 * math.factorial(p - 1))
                both[i, j] += w * (v[s | {i, j}] - v[s | {i}] - v[s | {j}] + v[s])
    both[np.diag_indices(p)] = phi - both.sum(axis=1)
    return phi, both, model.base + v[frozenset()]


def test_explanations_equal_subset_enumeration(spark):
    x, z = table(300, 8, 3)
    df, names = frame(spark, x, (z > 0).astype(float), 3)
    model = nt.fit_newton(df, names, "y", nt.NewtonParams(rounds=4, max_depth=5, reg_lambda=0.5))
    few = df.where(F.col("id") < 6)
    phi = {r["id"]: r for r in model.contributions(few, ["id"]).collect()}
    margin = {r["id"]: r["margin"] for r in model.transform(few, ["id"]).collect()}
    both = {}
    for r in model.interactions(few, "id").collect():
        both[r["id"], r["feature_i"], r["feature_j"]] = r["value"]
    for i in range(6):
        want, pairs, base = plain_games(model, x[i])
        got = [phi[i][f"c_{f}"] for f in names]
        assert np.allclose(got, want, atol=1e-9) and abs(phi[i]["bias"] - base) < 1e-9
        assert abs(sum(got) + base - margin[i]) < 1e-9
        matrix = np.array([[both.get((i, a, b), 0.0) for b in names] for a in names])
        assert np.allclose(matrix, pairs, atol=1e-9) and np.allclose(matrix, matrix.T)
        assert np.allclose(matrix.sum(axis=1), got) and abs(matrix.sum() + both[i, "bias", "bias"] - margin[i]) < 1e-9


def test_stored_models_score_alike(spark, tmp_path):
    x, z = table(200, 3, 4)
    df, names = frame(spark, x, z, 2)
    model = nt.fit_newton(df, names, "y", nt.NewtonParams(objective="regression", rounds=2, max_depth=3))
    model.save(spark, str(tmp_path / "m"))
    again = nt.NewtonModel.load(spark, str(tmp_path / "m"))
    assert again.params == model.params
    assert sorted(again.transform(df, ["id"]).collect()) == sorted(model.transform(df, ["id"]).collect())


def test_edge_cases(spark):
    none = spark.createDataFrame([], "id long, f double, y double")
    with pytest.raises(ValueError):
        nt.fit_newton(none, ["f"], "y")
    same = spark.createDataFrame([(1, None, 1.0), (2, None, 0.0), (3, None, None)], "id long, f double, y double")
    model = nt.fit_newton(same, ["f"], "y", nt.NewtonParams(rounds=2))
    assert [t.feature for t in model.trees] == [[-1], [-1]]
    assert {r["prediction"] for r in model.transform(same, ["id"]).collect()} == {0.5}
    with pytest.raises(ValueError):
        model.transform(same.withColumn("margin", F.lit(1)), ["id", "margin"])
    missing = spark.createDataFrame([(i, None if i % 2 else 1.0, float(i % 2)) for i in range(40)], "id long, f double, y double")
    model = nt.fit_newton(missing, ["f"], "y", nt.NewtonParams(rounds=1, max_depth=1))
    got = {r["id"]: r["prediction"] for r in model.transform(missing, ["id"]).collect()}
    assert got[1] > 0.5 > got[0]  # only missing values go right
    assert model.trees[0].threshold[0] >= 1.0


def test_many_cells_are_added_up_sparsely(spark, monkeypatch):
    x, z = table(200, 4, 6)
    df, names = frame(spark, x, z, 3)
    p = nt.NewtonParams(objective="regression", rounds=1, max_depth=3)
    dense = nt.fit_newton(df, names, "y", p).trees
    monkeypatch.setattr(nt, "DENSE_CELLS", 0)
    assert repr(nt.fit_newton(df, names, "y", p).trees) == repr(dense)
