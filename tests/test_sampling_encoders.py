import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import encoders, sampling, selection


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_splits_partition_keys(spark):
    od = _orders(spark)
    n = od.count()
    train, test = sampling.train_test_split(od, "o_orderkey", 0.8, seed=3)
    a, b = train.count(), test.count()
    assert a + b == n and 0.7 < a / n < 0.9
    assert train.join(test, "o_orderkey").count() == 0
    folds = od.withColumn("f", sampling.kfold_column("o_orderkey", 5, seed=1)).groupBy("f").count().collect()
    assert sorted(r.f for r in folds) == [0, 1, 2, 3, 4] and sum(r["count"] for r in folds) == n
    # different seeds are not the same split
    s1 = set(r[0] for r in sampling.hash_sample(od, "o_orderkey", 0.5, 1).select("o_orderkey").collect())
    s2 = set(r[0] for r in sampling.hash_sample(od, "o_orderkey", 0.5, 2).select("o_orderkey").collect())
    assert 0.15 < len(s1 & s2) / n < 0.35


def test_fixed_count_and_ordered_split(spark):
    od = _orders(spark)
    n = od.count()
    assert sampling.fixed_count_sample(od, "o_orderkey", 100, seed=0).count() == 100
    assert sampling.fixed_count_sample(od, "o_orderkey", n + 10, seed=0).count() == n
    sp = sampling.ordered_split(od, ["o_orderkey"], 0.2).groupBy("split").agg(
        F.count(F.lit(1)).alias("c"), F.max("o_orderkey").alias("mx"), F.min("o_orderkey").alias("mn")).collect()
    d = {r.split: r for r in sp}
    assert d["test"].c == int(np.ceil(0.2 * n)) and d["train"].mx < d["test"].mn


def test_train_infer_clamp(spark):
    od = _orders(spark)
    train, infer = sampling.train_infer_split(od, "o_orderkey", 1.7)
    assert train is infer
    tr, inf = sampling.infer_subsample(od, "o_orderkey", 0.3)
    assert inf.join(tr, "o_orderkey", "left_anti").count() == 0


def test_label_encoder_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "v string")
    test = spark.createDataFrame([("a",), ("z",), (None,), ("c",)], "v string")
    sep = encoders.LabelEncoder(["v"]).fit(train).transform(test).orderBy("v").collect()
    assert {r.v: r.v_code for r in sep} == {None: -1, "a": 0, "c": 2, "z": 3}
    comp = encoders.LabelEncoder(["v"], unseen="compat").fit(train).transform(test).collect()
    assert {r.v: r.v_code for r in comp}["z"] == 0


def test_target_encoding_matches_pandas(spark):
    pdf = pd.DataFrame({"k": np.arange(200), "c": np.random.default_rng(0).integers(0, 4, 200),
                        "y": np.random.default_rng(1).integers(0, 2, 200)})
    pdf["fold"] = pdf.k % 5
    df = spark.createDataFrame(pdf)
    got = encoders.target_encode_oof(df, "c", "y", "fold", smooth=0.5, out="te").toPandas().sort_values("k")
    mu = pdf.y.mean()
    exp = []
    for _, row in pdf.iterrows():
        other = pdf[(pdf.c == row.c) & (pdf.fold != row.fold)]
        exp.append((other.y.sum() + 0.5 * mu) / (len(other) + 0.5))
    assert np.allclose(got.te.to_numpy(), np.array(exp))


def test_chi2_matches_manual(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"a": rng.integers(0, 5, 300).astype(float), "b": rng.random(300),
                        "y": rng.integers(0, 3, 300).astype(str)})
    got = selection.chi2_scores(spark.createDataFrame(pdf), ["a", "b"], "y").toPandas().set_index("feature")
    for f in ["a", "b"]:
        obs = pdf.groupby("y")[f].sum()
        exp = pdf.y.value_counts(normalize=True).reindex(obs.index) * pdf[f].sum()
        assert abs(((obs - exp) ** 2 / exp).sum() - got.loc[f, "chi2"]) < 1e-9
    assert selection.select_k_best(spark.createDataFrame(pdf), ["a", "b"], "y", 1) == [got.chi2.idxmax()]


def test_dictionaries_of_any_size_are_numbered_alike(spark, monkeypatch):
    from lodestar.operators import encoders
    df = spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "b", "a a"]], "c string")
    small = sorted(map(tuple, encoders.fit_dictionary(df, "c").collect()))
    monkeypatch.setattr(encoders, "SMALL_DICTIONARY", 2)
    assert sorted(map(tuple, encoders.fit_dictionary(df, "c").collect())) == small == [("a", 0), ("a a", 1), ("b", 2), ("c", 3)]
