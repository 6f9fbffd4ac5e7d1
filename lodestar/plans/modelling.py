"""Named queries of fits, encodings, explanations and search analytics, each beside its DuckDB text."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from lodestar import sources
from lodestar.functions.hashing import portable_bucket
from lodestar.operators import (clean, combos, encoder_stages, explain, features, linear, metrics, models, newton_trees, sampling)
from lodestar.operators import trials as trial_ops
from lodestar.plans import fixtures, workflows
from lodestar.plans.catalog import TABLES, load, table_path
from lodestar.plans.oracle import LINE_ID, ORACLE, RUNNING_MEAN, TRIAL_LOG, _b, _fr, _hav, _part, _round01, _xmean
from lodestar.plans.queries import _embedding_vectors, _line_xy, _tag, _trial_log_running, embedding_cluster, fr, r, register, xmean
from lodestar.session import shared_path

# --------------------------------------------------------------------------- search analytics


@register("async_halving")
def async_halving(spark, sf_dir):
    """Three brackets of asynchronous halving over the events as reports, decided in the order of arrival."""
    log = _trial_log_running(spark, sf_dir).withColumn("bracket", portable_bucket("trial", 31, 3))
    out = trial_ops.async_halving(log, "trial", "step", "running_mean", "ts", "bracket", max_t=50, reduction=3)
    return out.withColumns({"metric": r("metric", 6), "cutoff": r("cutoff", 6)})


def _async_rung(rung: int, before: list[int]) -> str:
    stopped = " ".join(f"AND NOT EXISTS (SELECT 1 FROM r{k} z WHERE z.trial = rep.trial AND z.value < z.cutoff)" for k in before)
    return f"""r{rung} AS (SELECT *, quantile_cont(value, 0.6666666666666667) OVER (PARTITION BY bracket ORDER BY ts, trial
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff FROM rep WHERE rung = {rung} {stopped})"""


ORACLE["async_halving"] = f"""
  WITH rep AS (SELECT CAST({_b('l.trial', 31, 3)} AS INTEGER) AS bracket, l.trial, l.step AS rung, rm AS value, ts
               FROM ({TRIAL_LOG}) l JOIN ({RUNNING_MEAN}) m ON l.trial = m.trial AND l.step = m.step
               WHERE l.step IN (1, 3, 9, 27) AND l.step >= power(3, {_b('l.trial', 31, 3)})),
    {', '.join(_async_rung(k, b) for k, b in ((1, []), (3, [1]), (9, [1, 3]), (27, [1, 3, 9])))}
  SELECT bracket, rung, trial, round(value, 6) AS metric, round(cutoff, 6) AS cutoff, coalesce(value < cutoff, false) AS stopped
  FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r9 UNION ALL SELECT * FROM r27) x"""

PARAMS = ("lr_bin", "depth", "reg")


def _scores(spark, sf_dir):
    """A trial table: a score and three parameters for each user of events."""
    ev = load(spark, sf_dir, "events", ["user_id", "value"])
    return ev.groupBy(F.col("user_id").alias("trial")).agg(fr(xmean("value")).alias("score")).select(
        "trial", "score", *(portable_bucket("trial", seed, n).alias(c) for c, seed, n in zip(PARAMS, (21, 22, 23), (5, 4, 3))))


_SCORES = f"""
  SELECT *, {_b('trial', 21, 5)} AS lr_bin, {_b('trial', 22, 4)} AS depth, {_b('trial', 23, 3)} AS reg
  FROM (SELECT user_id AS trial, {_fr(_xmean('value'))} AS score FROM events GROUP BY user_id) e"""
_LONG_SCORES = f"SELECT trial, score, param, level FROM ({_SCORES}) s UNPIVOT (level FOR param IN (lr_bin, depth, reg))"


@register("trial_slices")
def trial_slices(spark, sf_dir):
    return trial_ops.slice_table(_scores(spark, sf_dir), "trial", PARAMS, "score")


ORACLE["trial_slices"] = f"SELECT trial, param, CAST(level AS DOUBLE) AS level, score FROM ({_LONG_SCORES}) l"


@register("trial_parallel")
def trial_parallel(spark, sf_dir):
    out = trial_ops.parallel_table(_scores(spark, sf_dir), "trial", PARAMS, "score")
    return out.select("trial", *(r(c, 6).alias(c) for c in (*PARAMS, "score")))


ORACLE["trial_parallel"] = f"""
  SELECT trial, {', '.join(f"round(coalesce((s.{c} - min(s.{c}) OVER ())::DOUBLE / nullif(max(s.{c}) OVER () - min(s.{c}) OVER (), 0), 0.5), 6) AS {c}"
                           for c in (*PARAMS, 'score'))}
  FROM ({_SCORES}) s"""


@register("param_marginals")
def param_marginals(spark, sf_dir):
    """Mean and deviation of the score for each value of one parameter, over all others."""
    out = trial_ops.marginal_stats(_scores(spark, sf_dir), PARAMS, "score")
    return out.select("param", "level", r("mean", 6).alias("mean"), r("std", 6).alias("std"), "n")


ORACLE["param_marginals"] = f"""
  SELECT param, CAST(level AS VARCHAR) AS level, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, count(*) AS n
  FROM ({_LONG_SCORES}) l GROUP BY param, level"""


# --------------------------------------------------------------------------- ingest and typing
def _text_orders(spark, sf_dir):
    """Orders as a text source: dates and prices as strings, some of them missing or unreadable."""
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"])
    key = F.col("o_orderkey")
    return od.select("o_orderkey", "o_custkey", "o_orderpriority",
                     F.when(key % 11 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ordered"),
                     F.when(key % 7 == 0, None).otherwise(F.col("o_totalprice").cast("string")).alias("price"))


@register("typed_rows")
def typed_rows(spark, sf_dir):
    """Text to timestamps and numbers, rows with nulls dropped, a predicate in words and a mask."""
    df = clean.strings_to_timestamp(_text_orders(spark, sf_dir), ["ordered"])
    df = df.withColumn("price", F.col("price").try_cast("double"))
    df = clean.drop_nulls(df, ["ordered", "price"])
    df = clean.filter_query(df, "price > 20000 AND o_orderpriority <> '5-LOW'", extra="o_custkey > 10")
    mask = F.month("ordered") <= 6
    return clean.filter_query(df, mask).select("o_orderkey", "ordered", "price")


ORACLE["typed_rows"] = """
  SELECT o_orderkey, o_orderdate AS ordered, o_totalprice AS price FROM orders
  WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_totalprice > 20000 AND o_orderpriority <> '5-LOW'
    AND o_custkey > 10 AND month(o_orderdate) <= 6"""


@register("numeric_table")
def numeric_table(spark, sf_dir):
    """Without text columns, the model's numeric columns, all as float32."""
    df = _text_orders(spark, sf_dir).withColumn("early", F.col("o_custkey") < 100)
    df = clean.drop_string_columns(df)
    df = clean.cast_all_float(df, exclude=["o_orderkey"])
    return df.select("o_orderkey", *combos.numeric_feature_columns(df, exclude=["o_orderkey"]))


ORACLE["numeric_table"] = """
  SELECT o_orderkey, CAST(o_custkey AS FLOAT) AS o_custkey, CAST(CAST(o_custkey < 100 AS INTEGER) AS FLOAT) AS early FROM orders"""


@register("local_frame")
def local_frame(spark, sf_dir):
    """A small local table as partitions, joined with a large one."""
    nations = load(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).toPandas()  # 25 rows
    local = sources.from_pandas(spark, nations, num_partitions=4)
    customers = load(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    return (customers.join(local, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name")
                     .agg(F.count(F.lit(1)).alias("n"), fr(xmean("c_acctbal")).alias("mean_balance")))


ORACLE["local_frame"] = f"""
  SELECT n_name, count(*) AS n, {_fr(_xmean('c_acctbal'))} AS mean_balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


@register("scan_partitions")
def scan_partitions(spark, sf_dir):
    """Per table: files, bytes, the split size derived from them, and the rows that a read with it gives."""
    rows = []
    for name in TABLES:
        plan = sources.plan_scan(spark, table_path(sf_dir, name), target_bytes=1 << 20, min_partitions=4)
        with sources.planned_reads(spark, plan):
            n = load(spark, sf_dir, name).count()
        rows.append((name, *plan, n))
    return spark.createDataFrame(rows, "table string, files long, bytes long, split_bytes long, open_cost long, partitions long, n_rows long")


# --------------------------------------------------------------------------- taxi regression
def timed_trips(spark, sf_dir):
    """Trips with both times: ordered (pickup) and shipped (drop-off), at positions on the map."""
    trips = fixtures.taxi_trips(spark, sf_dir)
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return trips.join(od, F.col("Trip_Id") == F.col("o_orderkey")).select(
        F.col("Row_Id").alias("row_id"), F.col(" Fare_Amount ").alias("fare_amount"), F.col("Passenger_Count").alias("passenger_count"),
        F.col("Trip_Distance").alias("trip_distance"), (F.col("Leg") % 3).cast("int").alias("rate_code_id"),
        F.col("o_orderdate").alias("pickup_datetime"), F.col("tpep_pickup_datetime").alias("dropoff_datetime"),
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def taxi_model(spark, sf_dir):
    """The model table: all features, duration and the coordinate grid among them, without rows that hold a null."""
    coords = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    df = features.add_taxi_features(timed_trips(spark, sf_dir), dropoff="dropoff_datetime", coords=coords, haversine_on_rounded=True, round_step=0.01)
    df = df.withColumns({c: F.col(f"{c}_r") for c in coords})
    columns = features.select_model_columns(df).columns
    return clean.drop_nulls(df.select("row_id", *columns), columns)


@register("taxi_model_table")
def taxi_model_table(spark, sf_dir):
    df = taxi_model(spark, sf_dir)
    return df.select(*(r(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes))


_GRID = {c: _round01(c) for c in ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")}


def _taxi_model_sql() -> str:
    raw = f"""SELECT {LINE_ID} AS row_id, l_extendedprice AS fare_amount, nullif(l_linenumber, 3)::BIGINT AS passenger_count,
                l_quantity AS trip_distance, CAST(l_linenumber % 3 AS INTEGER) AS rate_code_id, o_orderdate AS pickup, l_shipdate AS dropoff,
                -75.0 + (l_suppkey % 200) / 100 AS pickup_longitude, 40.0 + (l_partkey % 200) / 100 AS pickup_latitude,
                -75.0 + (l_orderkey % 200) / 100 AS dropoff_longitude, 40.5 + (l_partkey % 200) / 100 AS dropoff_latitude
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    return f"""
  SELECT row_id, passenger_count, trip_distance, rate_code_id, fare_amount,
         {', '.join(f'round({v}, 6) AS {c}' for c, v in _GRID.items())},
         date_diff('second', pickup, dropoff) AS duration_s,
         CAST({_hav(*_GRID.values())} AS FLOAT) AS h_distance,
         CAST(isodow(pickup) - 1 AS INTEGER) AS day_of_week, CAST(isodow(pickup) >= 6 AS INTEGER) AS is_weekend
  FROM ({raw}) t WHERE passenger_count IS NOT NULL"""


ORACLE["taxi_model_table"] = _taxi_model_sql()


@register("taxi_regression")
def taxi_regression(spark, sf_dir):
    """Fare regression from raw trips to held-out error: features, null drop, split, boosted trees, scores."""
    train, test = sampling.train_test_split(taxi_model(spark, sf_dir), "row_id", 0.8, seed=0)
    inputs = [c for c in train.columns if c not in ("row_id", "fare_amount")]
    model = newton_trees.fit_newton(train, inputs, "fare_amount", newton_trees.NewtonParams(
        objective="regression", rounds=8, max_depth=5, learning_rate=0.4, max_bins=64))
    scored = model.transform(test, ["row_id", "fare_amount"])
    return metrics.regression_metrics(scored, "fare_amount", "prediction")


# --------------------------------------------------------------------------- encoder pipeline
CATEGORIES = ["o_orderpriority", "c_mktsegment", "nation"]


def _encoding_rows(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])
    cu = load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    rows = od.join(cu, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"), "c_mktsegment",
        F.col("c_nationkey").alias("nation"), (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    return sampling.train_test_split(rows, "o_orderkey", 0.8, seed=4)


@register("encoder_pipeline")
def encoder_pipeline(spark, sf_dir):
    """Three columns label-encoded and target-encoded by a pipeline that is saved, loaded and applied to new rows."""
    train, test = _encoding_rows(spark, sf_dir)
    codes, means = [f"{c}_code" for c in CATEGORIES], [f"{c}_mean" for c in CATEGORIES]
    stages = [encoder_stages.DictionaryEncoder(inputCols=CATEGORIES, outputCols=codes),
              encoder_stages.TargetMeanEncoder(inputCols=codes, outputCols=means, labelCol="y", smooth=5.0)]
    path = shared_path(spark, "encoder_pipeline", _tag(sf_dir), unique=True)
    Pipeline(stages=stages).fit(train).write().save(path)
    out = PipelineModel.load(path).transform(test)
    return out.select("o_orderkey", *codes, *(r(c, 6).alias(c) for c in means))


def _encoder_sql() -> str:
    rows = f"""rows AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, c_mktsegment, c_nationkey AS nation,
                    CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END AS y,
                    {_b('o_orderkey', 4, 4294967296)} < {_part(800)} AS is_train
             FROM orders JOIN customer ON o_custkey = c_custkey),
      mu AS (SELECT avg(y) AS mu FROM rows WHERE is_train)"""
    parts, joins, picks = [], "", []
    for c in CATEGORIES:
        parts.append(f"""d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
                        FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM rows WHERE is_train AND {c} IS NOT NULL)),
        c_{c} AS (SELECT o_orderkey, y, is_train, CASE WHEN {c} IS NULL THEN -1 ELSE coalesce(code, (SELECT count(*) FROM d_{c})) END::INTEGER AS code
                  FROM rows LEFT JOIN d_{c} ON v = CAST({c} AS VARCHAR)),
        m_{c} AS (SELECT code, sum(y) AS s, count(*) AS n FROM c_{c} WHERE is_train GROUP BY code),
        e_{c} AS (SELECT o_orderkey, code, coalesce((s + 5 * mu) / (n + 5), mu) AS mean
                  FROM c_{c} LEFT JOIN m_{c} USING (code), mu WHERE NOT is_train)""")
        joins += f" JOIN e_{c} ON e_{c}.o_orderkey = t.o_orderkey"
        picks.append(f"e_{c}.code AS {c}_code, round(e_{c}.mean, 6) AS {c}_mean")
    return f"WITH {rows}, {', '.join(parts)} SELECT t.o_orderkey, {', '.join(picks)} FROM (SELECT o_orderkey FROM rows WHERE NOT is_train) t{joins}"


ORACLE["encoder_pipeline"] = _encoder_sql()


# --------------------------------------------------------------------------- penalised linear fits, rotations
@register("penalised_two_features")
def penalised_two_features(spark, sf_dir):
    """Lasso and elastic-net paths by coordinate descent on two features."""
    df = _line_xy(spark, sf_dir)
    rows = []
    for name, ratio in (("lasso", 1.0), ("elastic_net", 0.5)):
        for alpha, fit in linear.coordinate_path(df, ["l_quantity", "l_discount"], "y", [100.0, 1.0, 0.001], ratio):
            rows += [(name, alpha, "intercept", float(fit.intercept)), (name, alpha, "l_quantity", float(fit.coef[0])),
                     (name, alpha, "l_discount", float(fit.coef[1]))]
    return spark.createDataFrame(rows, "model string, alpha double, term string, value double").withColumn("value", r("value", 5) + 0.0)


ORACLE["penalised_two_features"] = """
  WITH s AS (SELECT covar_pop(l_quantity, l_quantity) AS a, covar_pop(l_quantity, l_discount) AS c, covar_pop(l_discount, l_discount) AS b,
                    covar_pop(l_quantity, l_extendedprice / 1000) AS p, covar_pop(l_discount, l_extendedprice / 1000) AS q,
                    avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice / 1000) AS my FROM lineitem),
    k AS (SELECT s.*, model, alpha, alpha * ratio AS l, alpha * (1 - ratio) AS e
          FROM s, (VALUES ('lasso', 1.0::DOUBLE), ('elastic_net', 0.5)) m(model, ratio), (VALUES (100.0::DOUBLE), (1.0), (0.001)) g(alpha)),
    w AS (SELECT k.*, CASE WHEN s1 = 0 THEN 0 WHEN s2 = 0 THEN (p - l * s1) / (a + e)
                      ELSE ((b + e) * (p - l * s1) - c * (q - l * s2)) / ((a + e) * (b + e) - c * c) END AS w1,
                 CASE WHEN s2 = 0 THEN 0 WHEN s1 = 0 THEN (q - l * s2) / (b + e)
                      ELSE ((a + e) * (q - l * s2) - c * (p - l * s1)) / ((a + e) * (b + e) - c * c) END AS w2
          FROM k, (VALUES (-1), (0), (1)) x(s1), (VALUES (-1), (0), (1)) z(s2)),
    best AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY model, alpha
             ORDER BY (a * w1 * w1 + 2 * c * w1 * w2 + b * w2 * w2) / 2 - p * w1 - q * w2 + l * (abs(w1) + abs(w2)) + e / 2 * (w1 * w1 + w2 * w2)) = 1)
  SELECT model, alpha, 'intercept' AS term, round(my - m1 * w1 - m2 * w2, 5) + 0.0 AS value FROM best
  UNION ALL SELECT model, alpha, 'l_quantity', round(w1, 5) + 0.0 FROM best
  UNION ALL SELECT model, alpha, 'l_discount', round(w2, 5) + 0.0 FROM best"""


@register("rotation_plane")
def rotation_plane(spark, sf_dir):
    """Directions and lengths of PCA and SVD in two dimensions; a direction's second coordinate is not negative."""
    df = _line_xy(spark, sf_dir).select(F.col("l_quantity").alias("a"), F.col("y").alias("b")).withColumn("v", F.array("a", "b"))
    pca = models.centered_pca(["a", "b"], k=2).fit(df).stages[-1]
    axes, share = pca.pc.toArray(), pca.explainedVariance.toArray()
    vecs, lengths = models.truncated_svd(df, "v", 2, k=2)
    rows = []
    for name, m, size in (("pca", axes, share), ("svd", vecs, lengths)):
        for i in range(2):
            sign = -1.0 if m[1, i] < 0 else 1.0
            rows.append((name, i, float(sign * m[0, i]), float(sign * m[1, i]), float(size[i])))
    return spark.createDataFrame(rows, "model string, place int, x double, y double, size double").select(
        "model", "place", r("x", 6).alias("x"), r("y", 6).alias("y"), r("size", 4).alias("size"))


ORACLE["rotation_plane"] = """
  WITH s AS (SELECT 'pca' AS model, covar_pop(a, a) AS a, covar_pop(a, b) AS c, covar_pop(b, b) AS b FROM (SELECT l_quantity AS a, l_extendedprice / 1000 AS b FROM lineitem)
             UNION ALL SELECT 'svd', sum(a * a), sum(a * b), sum(b * b) FROM (SELECT l_quantity AS a, l_extendedprice / 1000 AS b FROM lineitem)),
    e AS (SELECT *, (a + b) / 2 + sg * sqrt((a - b) * (a - b) / 4 + c * c) AS v, CAST((1 - sg) / 2 AS INTEGER) AS place FROM s, (VALUES (1), (-1)) g(sg)),
    d AS (SELECT *, (v - b) / c AS ratio FROM e)
  SELECT model, place, round(ratio / sqrt(1 + ratio * ratio), 6) AS x, round(1 / sqrt(1 + ratio * ratio), 6) AS y,
         round(CASE model WHEN 'pca' THEN v / (a + b) ELSE sqrt(v) END, 4) AS size FROM d"""


# --------------------------------------------------------------------------- clusterings, margins, black boxes
@register("silhouette_given")
def silhouette_given(spark, sf_dir):
    """Exact silhouette of a given assignment (the largest coordinate), per cluster and for all rows."""
    emb = load(spark, sf_dir, "embeddings", ["embedding"]).withColumn("cluster", embedding_cluster())
    return metrics.silhouette(emb, "embedding", "cluster").withColumn("silhouette", r("silhouette", 6))


ORACLE["silhouette_given"] = """
  WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, list_position(embedding, list_max(embedding)) - 1 AS c FROM embeddings),
    d AS (SELECT a.vec_id, a.c, b.c AS other, sum(power(list_distance(a.v, b.v), 2)) AS total, count(*) AS n FROM e a, e b GROUP BY ALL),
    i AS (SELECT vec_id, c, max(CASE WHEN other = c AND n > 1 THEN total / (n - 1) END) AS inner_d,
                 min(CASE WHEN other <> c THEN total / n END) AS outer_d FROM d GROUP BY vec_id, c),
    s AS (SELECT c, CASE WHEN inner_d IS NULL OR outer_d IS NULL THEN 0 ELSE (outer_d - inner_d) / greatest(inner_d, outer_d) END AS s FROM i)
  SELECT c::BIGINT AS cluster, count(*) AS n, round(avg(s), 6) AS silhouette FROM s GROUP BY ROLLUP (c)"""


@register("kmeans_quality")
def kmeans_quality(spark, sf_dir):
    """Purity and silhouette of a fitted clustering."""
    emb = _embedding_vectors(spark, sf_dir)
    model = models.kmeans(None, k=10, max_iter=50, tol=1e-5, seed=1, vector_col="features").fit(emb)
    rows = model.transform(emb).select("embedding", "label", "cluster")
    pure = metrics.cluster_purity(rows, "cluster", "label")
    return pure.join(metrics.silhouette(rows, "embedding", "cluster").where(F.col("cluster").isNull()).select("n", "silhouette"), "n")


@register("svm_probability")
def svm_probability(spark, sf_dir):
    """Kernel SVM by random features, with probabilities from a sigmoid of out-of-fold margins, on held-out rows."""
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]).withColumn("y", (F.col("label") < 5).cast("double"))
    dim = emb.select(F.size("embedding").alias("n")).first()["n"]
    feats = emb.select("vec_id", "y", models.random_fourier_features("embedding", dim, 64, gamma=1.0, seed=0),
                       portable_bucket("vec_id", 9, 3).alias("fold"))
    train, test = sampling.train_test_split(feats, "vec_id", 0.8, seed=0)
    return models.calibrated_svc(train.persist(), "y", "fold", C=100.0).transform(test, ["vec_id", "y"])


BLACK_BOX = ["l_quantity", "l_discount", "l_tax"]


@register("blackbox_importance")
def blackbox_importance(spark, sf_dir):
    """Global explanation of a model known by its predictions alone: all coalitions, a weighted background, mean |phi|."""
    df = _line_xy(spark, sf_dir).withColumn("row", F.concat_ws("-", *BLACK_BOX))
    model = linear.spark_ml_linear(df, BLACK_BOX, "y", solver="normal")
    ground = df.groupBy("l_linenumber").agg(*(F.avg(f).alias(f) for f in BLACK_BOX), F.count(F.lit(1)).alias("w"))
    cells = df.groupBy("row", *BLACK_BOX).agg(F.count(F.lit(1)).alias("times"))  # equal rows have equal values
    phi = explain.coalition_shapley(lambda x: model.transform(x), cells, ground, "row", BLACK_BOX, weight_col="w").join(cells.select("row", "times"), "row")
    out = phi.groupBy("feature").agg((F.sum(F.abs("phi") * F.col("times")) / F.sum("times")).alias("importance"))
    return explain.top_k_importance(out, len(BLACK_BOX)).withColumn("importance", r("importance", 5))


def _blackbox_sql() -> str:
    one = ORACLE["importance_topk"]
    return one.replace("round(importance, 6)", "round(importance, 5)").replace("WHERE rank <= 2", "")


ORACLE["blackbox_importance"] = _blackbox_sql()


# --------------------------------------------------------------------------- the full feature search
@register("engineered_scores")
def engineered_scores(spark, sf_dir):
    """Chi-square of all inputs, three target encodings among them, and of all their pairwise sums."""
    base = workflows.labelled_flights(spark, sf_dir).persist()
    try:
        train, _, inputs = workflows.encoded_flights(base)
        scores = workflows.pair_scores(train, inputs, workflows.LABEL)
    finally:
        base.unpersist()
    return spark.createDataFrame(scores, "feature string, chi2 double").withColumn("chi2", r("chi2", 4))


def _engineered_sql() -> str:
    cats, label = workflows.CATEGORICAL, workflows.LABEL
    parts, joins, means = [], "", []
    for c in cats:
        parts.append(f"""f_{c} AS (SELECT {c} AS v, fold, sum(y) AS s, count(*) AS n FROM t GROUP BY 1, 2),
        a_{c} AS (SELECT v, sum(s) AS s, sum(n) AS n FROM f_{c} GROUP BY 1)""")
        joins += f" JOIN a_{c} ON a_{c}.v = t.{c} JOIN f_{c} ON f_{c}.v = t.{c} AND f_{c}.fold = t.fold"
        means.append(f"(a_{c}.s - f_{c}.s + 0.001 * mu) / (a_{c}.n - f_{c}.n + 0.001) AS {c}_mean")
    inputs = [*fixtures.FLIGHT_FEATURES, *(f"{c}_mean" for c in cats)]
    pairs = [(a,) for a in inputs] + [(a, b) for i, a in enumerate(inputs) for b in inputs[i + 1:]]
    long = " UNION ALL ".join(f"SELECT '{'+'.join(p)}' AS feature, y, n, {' + '.join(p)} AS seen FROM sums" for p in pairs)
    return f"""
  WITH t AS (SELECT *, CAST({label} AS DOUBLE) AS y, flight_id % 5 AS fold FROM ({ORACLE['delay_label']}) d
             WHERE {_b('flight_id', 0, 4294967296)} < {_part(800)}),
    m AS (SELECT avg(y) AS mu FROM t), {', '.join(parts)},
    e AS (SELECT t.*, {', '.join(means)} FROM t CROSS JOIN m {joins}),
    sums AS (SELECT y, count(*) AS n, {', '.join(f'sum(CAST({c} AS DOUBLE)) AS {c}' for c in inputs)} FROM e GROUP BY y),
    seen AS ({long}),
    x AS (SELECT feature, seen, n / sum(n) OVER w * sum(seen) OVER w AS expected FROM seen WINDOW w AS (PARTITION BY feature))
  SELECT feature, round(sum(power(seen - expected, 2) / expected), 4) AS chi2 FROM x GROUP BY feature"""


ORACLE["engineered_scores"] = _engineered_sql()


@register("full_feature_search")
def full_feature_search(spark, sf_dir):
    return workflows.full_feature_search(spark, sf_dir)
