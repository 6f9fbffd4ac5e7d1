"""Multi-stage workflows built from the operators (feature engineering + search)."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators import combos, encoder_stages, encoders, logits, models, sampling
from lodestar.operators import trials as trial_ops
from lodestar.plans import fixtures

LABEL = "ArrDelayBinary"
VEC = "all_features"


def labelled_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay table with its label as a double."""
    from lodestar.plans.queries import delay_table
    return delay_table(spark, sf_dir).withColumn(LABEL, F.col(LABEL).cast("double"))


def engineered_flights(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str], list[DataFrame]]:
    """Train/test flights with the out-of-fold target-encoded origin and pairwise sums of the
    numeric inputs, assembled into one vector column. Returns (train, test, feature names, kept frames).
    Train and test hold flight_id, label and the vector, made anew on each pass; only their inputs, a sixth
    of the vector, are kept (caller unpersists)."""
    base = labelled_flights(spark, sf_dir).persist()
    train, test = sampling.train_test_split(base, "flight_id", 0.8, seed=0)
    train = train.withColumn("__fold", sampling.interleaved_fold("flight_id", 5))
    train_te = encoders.target_encode_oof(train, "Origin_code", LABEL, "__fold", smooth=0.001,
                                          out="Origin_te").drop("__fold")
    test_te = encoders.target_encode_apply(train, test, "Origin_code", LABEL, smooth=0.001, out="Origin_te")
    cols = [*fixtures.FLIGHT_FEATURES, "Origin_te"]
    feats = None
    out, kept = [], []
    for part in (train_te, test_te):
        kept.append(part.select("flight_id", LABEL, *cols).persist())
        wide = combos.pairwise_features(kept[-1], cols, "+")
        feats = [c for c in wide.columns if c not in ("flight_id", LABEL)]
        va = VectorAssembler(inputCols=feats, outputCol=VEC, handleInvalid="keep")
        out.append(va.transform(wide).select("flight_id", LABEL, VEC))
    for k in kept:
        k.count()  # materialise both caches before the shared base is released
    base.unpersist()
    return out[0], out[1], feats, kept


def chi2_vector_scores(df: DataFrame, vec: str, names: list[str], label: str) -> list[tuple[str, float]]:
    """Chi-square score per vector slot: inputs, and sums ``<a>_<b>_plus`` of two of them (non-negative).

    One grouped pass over the inputs' slots; a sum's class totals are those of its parts together.
    """
    inputs = [n for n in names if not n.endswith("_plus")]
    arr = vector_to_array(F.col(vec))
    sums = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"),
                                 *[F.sum(arr[names.index(c)]).alias(f"s{i}") for i, c in enumerate(inputs)]).collect()
    total = {c: np.array([r[f"s{i}"] for r in sums], dtype=float) for i, c in enumerate(inputs)}
    total |= {f"{a}_{b}_plus": total[a] + total[b] for a, b in itertools.combinations(inputs, 2)}
    return _chi2_ranked(np.array([r["__n"] for r in sums], dtype=float), {c: total[c] for c in names})


def _chi2_ranked(n: np.ndarray, observed: dict[str, np.ndarray]) -> list[tuple[str, float]]:
    """(name, chi-square) of class totals, the largest first; 0 for a feature that is zero throughout."""
    scores = {}
    for name, seen in observed.items():
        expected = n / n.sum() * seen.sum()
        scores[name] = float(((seen - expected) ** 2 / expected).sum()) if seen.sum() else 0.0
    return sorted(scores.items(), key=lambda s: (-s[1], s[0]))


def feature_search(spark: SparkSession, sf_dir: str, n_trials: int = 10, parallelism: int | None = None,
                   seed: int = 0) -> DataFrame:
    """Chi-square-ranked features (scored once), then a seeded random search over (k, C, penalty)
    of logistic regression; each trial fits on the top-k slots of the feature vector.
    Features are inputs or sums of two, so all trials are fitted in shared passes over the packed inputs. Rows with
    missing values fall back to fits of their own, of which as many are submitted at once as have room.
    Returns the trial table (trial_id, k, C, l1, auc, state, features)."""
    train_rows, test_rows, feats, kept = engineered_flights(spark, sf_dir)
    ranked = chi2_vector_scores(train_rows, VEC, feats, LABEL)
    position = {f: i for i, f in enumerate(feats)}
    space = trial_ops.SearchSpace({"k": ("int", 5, len(feats)), "C": ("loguniform", 1e-3, 10.0),
                                   "l1": ("choice", [0.0, 1.0])})
    cands = space.random(n_trials, seed=seed)
    n_rows = kept[0].count()
    concurrent = min(parallelism or len(cands), models.fits_at_once(n_rows, [int(c["k"]) for c in cands]))
    share = -(-spark.sparkContext.defaultParallelism // concurrent)  # cores per concurrent fit
    train = models.right_size(train_rows, min_partitions=share)
    test = models.right_size(test_rows, min_partitions=share)

    def build(c):
        top = [position[f] for f, _ in ranked[: int(c["k"])]]
        reg = 1.0 / (max(float(c["C"]), 1e-12) * n_rows)
        return Pipeline(stages=[VectorSlicer(inputCol=VEC, outputCol="features", indices=sorted(top)),
                                LogisticRegression(featuresCol="features", labelCol=LABEL, regParam=reg,
                                                   elasticNetParam=1.0 if c["l1"] >= 0.5 else 0.0, maxIter=50)])
    inputs = [c for c in kept[0].columns if c not in ("flight_id", LABEL)]
    number = {c: (i,) for i, c in enumerate(inputs)}
    number |= {combos.pairwise_name(a, b): number[a] + number[b] for a, b in itertools.combinations(inputs, 2)}

    def together(many):
        specs = [logits.Spec(tuple(number[f] for f, _ in ranked[: int(c["k"])]), 1.0 / (max(float(c["C"]), 1e-12) * n_rows),
                             1.0 if c["l1"] >= 0.5 else 0.0, max_iter=50) for c in many]
        packed = [logits.blocks(part, inputs, LABEL, rows=n_rows) for part in kept]
        try:
            return logits.areas(packed[1], logits.fit(packed[0], len(inputs), specs))
        finally:
            for part in packed:
                part.unpersist()
    table = models.evaluate_candidates(cands, build, train, test, LABEL, parallelism=concurrent, together=together)
    top_names = spark.createDataFrame([(i, ",".join(f for f, _ in ranked[: int(c["k"])]))
                                       for i, c in enumerate(cands)],
                                      T.StructType([T.StructField("trial_id", T.IntegerType()),
                                                    T.StructField("features", T.StringType())]))
    out = table.join(top_names, "trial_id").checkpoint(eager=True)
    for k in kept:
        k.unpersist()
    return out


def feature_engineering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode + pairwise features + chi-square ranking of every generated feature (no search).
    Returns feature, chi2, rank."""
    train, _, feats, kept = engineered_flights(spark, sf_dir)
    ranked = chi2_vector_scores(train, VEC, feats, LABEL)
    out = spark.createDataFrame([(f, c, i + 1) for i, (f, c) in enumerate(ranked)],
                                "feature string, chi2 double, rank int")
    for k in kept:
        k.unpersist()
    return out


# --------------------------------------------------------------------------- full search
CATEGORICAL = ["Origin_code", "Month", "DayOfWeek"]
PENALTIES = ("none", "l1", "l2", "elasticnet")


def encoded_flights(base: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Train and test flights with three columns label- and target-encoded (training rows out of fold), and the inputs.

    ``base`` (``labelled_flights``) is read once per fit and frame, so callers keep it meanwhile.
    """
    train, test = sampling.train_test_split(base, "flight_id", 0.8, seed=0)
    train = train.withColumn("fold", sampling.interleaved_fold("flight_id", 5))
    codes, means = [f"{c}_label" for c in CATEGORICAL], [f"{c}_mean" for c in CATEGORICAL]
    pipeline = Pipeline(stages=[
        encoder_stages.DictionaryEncoder(inputCols=CATEGORICAL, outputCols=codes),
        encoder_stages.TargetMeanEncoder(inputCols=codes, outputCols=means, labelCol=LABEL, smooth=0.001, foldCol="fold")]).fit(train)
    inputs = [*fixtures.FLIGHT_FEATURES, *means]
    return (*(pipeline.transform(part).select("flight_id", LABEL, *inputs) for part in (train, test)), inputs)


def pair_scores(train: DataFrame, inputs: list[str], label: str) -> list[tuple[str, float]]:
    """Chi-square of every input and every sum of two, best first.

    A sum's class totals are the sums of its parts' totals, so one aggregation over the inputs scores them all.
    """
    sums = train.groupBy(label).agg(F.count(F.lit(1)).alias("__n"), *(F.sum(F.col(c).cast("double")).alias(c) for c in inputs)).collect()
    total = {c: np.array([r[c] for r in sums], float) for c in inputs}
    total |= {f"{a}+{b}": total[a] + total[b] for a, b in itertools.combinations(inputs, 2)}
    return _chi2_ranked(np.array([r["__n"] for r in sums], float), total)


def full_feature_search(spark: SparkSession, sf_dir: str, n_trials: int = 6, seed: int = 0, max_iter: int = 30) -> DataFrame:
    """Encodings, pairwise sums, chi-square selection and a search over k, penalty, C, mixing ratio and intercept; then a refit.

    One row per trial with its parameters, AUC on held-out rows, state and features; the best trial's parameters, fitted
    again on all rows, are the row with state ``refit`` (its AUC is over the rows that it was fitted on).
    """
    base = labelled_flights(spark, sf_dir).persist()
    train, test, inputs = encoded_flights(base)
    train, test = train.persist(), test.persist()
    packed = []
    try:
        n_rows, n_test = train.count(), test.count()
        base.unpersist()  # both frames hold what they need
        ranked = pair_scores(train, inputs, LABEL)
        space = trial_ops.SearchSpace({"k": ("int", 5, len(ranked)), "penalty": ("choice", list(range(len(PENALTIES)))),
                                       "C": ("loguniform", 1e-3, 10.0), "l1_ratio": ("uniform", 0.0, 1.0), "fit_intercept": ("choice", [0, 1])})
        candidates = space.random(n_trials, seed=seed)

        def build(c, rows=None):
            names = [name for name, _ in ranked[:int(c["k"])]]
            select = ", ".join([f"`{LABEL}`", "`flight_id`", *(" + ".join(f"CAST(`{part}` AS DOUBLE)" for part in name.split("+")) + f" AS f{i}"
                                                              for i, name in enumerate(names))])
            fit = models.logistic_regression([f"f{i}" for i in range(len(names))], LABEL, penalty=PENALTIES[int(c["penalty"])], C=c["C"],
                                             l1_ratio=c["l1_ratio"], fit_intercept=bool(c["fit_intercept"]), n_rows=rows or n_rows, max_iter=max_iter)
            return Pipeline(stages=[SQLTransformer(statement=f"SELECT {select} FROM __THIS__"), *fit.getStages()])

        packed = [logits.blocks(part, inputs, LABEL, rows=n_rows) for part in (train, test)]
        place = {c: i for i, c in enumerate(inputs)}

        def spec(c, rows):
            fit = models.logistic_regression([], LABEL, penalty=PENALTIES[int(c["penalty"])], C=c["C"], l1_ratio=c["l1_ratio"],
                                             fit_intercept=bool(c["fit_intercept"]), n_rows=rows, max_iter=max_iter).getStages()[-1]
            return logits.Spec(tuple(tuple(place[part] for part in name.split("+")) for name, _ in ranked[:int(c["k"])]),
                               fit.getRegParam(), fit.getElasticNetParam(), fit.getFitIntercept(), fit.getMaxIter())

        def together(many):
            return logits.areas(packed[1], logits.fit(packed[0], len(inputs), [spec(c, n_rows) for c in many]))

        trials = models.evaluate_candidates(candidates, build, train, test, LABEL, together=together,
                                            parallelism=models.fits_at_once(n_rows, [int(c["k"]) for c in candidates]))
        rows = sorted((r.asDict() for r in trials.collect()), key=lambda r: r["trial_id"])  # a row per trial
        good = [r for r in rows if r["state"] == "complete"]
        if good:
            best = max(good, key=lambda r: (r["auc"], -r["trial_id"]))
            everything = packed[0].union(packed[1])
            try:
                area = logits.areas(everything, logits.fit(everything, len(inputs), [spec(best, n_rows + n_test)]))[0]
            except logits.Unfit:
                both = train.unionByName(test)
                model = build(best, n_rows + n_test).fit(both)
                area = models.auc(models.score(model, both, [LABEL]), LABEL)
            rows.append({**best, "state": "refit", "auc": area})
        table = [(r["trial_id"], int(r["k"]), PENALTIES[int(r["penalty"])], r["C"], r["l1_ratio"], bool(r["fit_intercept"]), r["auc"], r["state"],
                  ",".join(name for name, _ in ranked[:int(r["k"])])) for r in rows]
        return spark.createDataFrame(table, "trial_id int, k int, penalty string, C double, l1_ratio double, fit_intercept boolean, "
                                            "auc double, state string, features string")
    finally:
        for part in (base, train, test, *packed):
            part.unpersist()
