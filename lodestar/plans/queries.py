"""Named queries over the supplied tables: one per operator family of the inventory.

Each query is ``fn(spark, sf_dir) -> DataFrame``; the matching DuckDB text
lives in :mod:`lodestar.plans.oracle`. Float outputs are rounded on both sides
so that summation order cannot change the compared digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import dates, portable_bucket
from lodestar.operators import clean, sampling
from lodestar.plans import fixtures
from lodestar.plans.catalog import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r(col, digits: int = 6):
    return F.round(col, digits)


def fr(col, digits: int = 6):
    """Half-up rounding as plain IEEE arithmetic (bit-identical to the SQL oracle's)."""
    m = F.lit(10.0 ** digits)
    return F.floor(col * m + F.lit(0.5)) / m


def xmean(col, scale: int = 2):
    """Mean from an exact decimal sum, so summation order cannot change it."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double") / F.count(c)


# --------------------------------------------------------------------------- cleaning / filters
def cleaned_taxi(spark: SparkSession, sf_dir: str, key_offset: int = 0) -> DataFrame:
    raw = fixtures.taxi_trips(spark, sf_dir)
    if key_offset:
        raw = raw.withColumn("Trip_Id", F.col("Trip_Id") + F.lit(key_offset))
    return clean.clean_frame(raw, keep=fixtures.TAXI_KEEP, rename=fixtures.TAXI_RENAME,
                             timestamp_cols=("pickup_datetime",), on_string="cast",
                             null_text="-1", fill=-1, filters=fixtures.TAXI_FILTERS, id_cols=("row_id", "trip_id"))


@register("clean_taxi")
def clean_taxi(spark, sf_dir):
    return cleaned_taxi(spark, sf_dir)


@register("clean_wide_keys")
def clean_wide_keys(spark, sf_dir):
    """The cleaning chain over trip ids beyond 32 bits."""
    return cleaned_taxi(spark, sf_dir, key_offset=3_000_000_000)


@register("row_counts")
def row_counts(spark, sf_dir):
    """Rows loaded and rows kept by the cleaning chain (the counts behind load/ETL throughput)."""
    from lodestar.operators.aggregates import row_count
    loaded = row_count(fixtures.taxi_trips(spark, sf_dir), "rows_loaded").withColumn("__one", F.lit(1))
    kept = row_count(cleaned_taxi(spark, sf_dir), "rows_clean").withColumn("__one", F.lit(1))
    return loaded.join(F.broadcast(kept), "__one").drop("__one")  # two one-row counts


@register("taxi_fare_weekday")
def taxi_fare_weekday(spark, sf_dir):
    """Flagship slice: clean -> date features -> seeded split -> grouped mean/std/count."""
    df = cleaned_taxi(spark, sf_dir)
    df = df.withColumns({
        "day_of_week": dates.weekday_mon0("pickup_datetime"),
        "is_weekend": dates.is_weekend("pickup_datetime"),
        "split": sampling.split_column("trip_id", 0.8, 42),
    })
    return (df.groupBy("split", "day_of_week", "is_weekend")
              .agg(F.count(F.lit(1)).alias("n_trips"),
                   fr(xmean("fare_amount"), 4).alias("mean_fare"),
                   r(F.stddev_samp("fare_amount"), 4).alias("std_fare"),
                   fr(xmean("trip_distance")).alias("mean_distance")))


# --------------------------------------------------------------------------- sampling / splitting

def _orders(spark, sf_dir, cols=("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")):
    return load(spark, sf_dir, "orders", list(cols))


def money_sum(col):
    """Exact money total: decimal sum, reported as double."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


@register("hash_sample")
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(_orders(spark, sf_dir, ("o_orderkey", "o_custkey", "o_totalprice")),
                                "o_orderkey", 0.8, seed=7)


@register("fixed_count_sample")
def fixed_count_sample(spark, sf_dir):
    return sampling.fixed_count_sample(_orders(spark, sf_dir, ("o_orderkey", "o_totalprice")),
                                       "o_orderkey", 1000, seed=0)


@register("split_counts")
def split_counts(spark, sf_dir):
    df = sampling.repeated_holdout(_orders(spark, sf_dir, ("o_orderkey", "o_totalprice")),
                                   "o_orderkey", seeds=[0, 1, 2, 3, 4], train_fraction=0.8)
    return df.groupBy("seed", "split").agg(F.count(F.lit(1)).alias("n"),
                                           money_sum("o_totalprice").alias("total_price"))


@register("kfold_counts")
def kfold_counts(spark, sf_dir):
    df = _orders(spark, sf_dir, ("o_orderkey", "o_totalprice"))
    return (df.withColumn("fold", sampling.kfold_column("o_orderkey", 5, seed=0))
              .groupBy("fold").agg(F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total_price")))


def _in_year(df: DataFrame, column: str, year: int):
    """A range on the column itself, which the scan can use to skip row groups (``year(column)`` can't be pushed)."""
    kind = df.schema[column].dataType
    return (F.col(column) >= F.lit(f"{year}-01-01").cast(kind)) & (F.col(column) < F.lit(f"{year + 1}-01-01").cast(kind))


@register("row_estimate")
def row_estimate(spark, sf_dir):
    orders = _orders(spark, sf_dir, ("o_orderkey", "o_orderdate"))
    return sampling.estimate_rows_by(orders.withColumn("source", F.year("o_orderdate").cast("string")), "source", "o_orderkey", 0.1, seed=3)


@register("ordered_split")
def ordered_split(spark, sf_dir):
    df = sampling.ordered_split(_orders(spark, sf_dir, ("o_orderkey", "o_totalprice")), ["o_orderkey"], 0.2)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
                                   F.max("o_orderkey").alias("last_key"))


@register("train_infer_split")
def train_infer_split(spark, sf_dir):
    df = _orders(spark, sf_dir, ("o_orderkey", "o_totalprice"))
    train, infer = sampling.train_infer_split(df, "o_orderkey", infer_fraction=0.25, seed=5)
    _, overlap = sampling.infer_subsample(df, "o_orderkey", 0.25, seed=5)
    parts = [train.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n")),
             infer.agg(F.lit("infer").alias("part"), F.count(F.lit(1)).alias("n")),
             overlap.agg(F.lit("infer_overlapping").alias("part"), F.count(F.lit(1)).alias("n"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --------------------------------------------------------------------------- date / geo features
from lodestar.functions import geo  # noqa: E402


@register("date_features")
def date_features(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["event_id", "ts"])
    return ev.select("event_id", *[c.alias(k) for k, c in dates.date_parts("ts").items()],
                     dates.day_of_week_sat0("ts").alias("dow_sat0"),
                     dates.weekday_mon0("ts").alias("weekday"),
                     dates.is_weekend("ts").alias("is_weekend"))


@register("weekend_flag")
def weekend_flag(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_shipdate"])
    return (li.select(dates.day_of_week_sat0("l_shipdate").alias("dow_sat0"),
                      dates.is_weekend("l_shipdate").alias("is_weekend"))
              .groupBy("dow_sat0", "is_weekend").agg(F.count(F.lit(1)).alias("n")))


@register("duration_seconds")
def duration_seconds(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    dates.duration_seconds("o_orderdate", "l_shipdate").alias("duration_s"))


def _geo_source(spark, sf_dir):
    raw = fixtures.taxi_trips(spark, sf_dir)
    return raw.select(F.col("Trip_Id").alias("trip_id"), F.col("Leg").alias("leg"),
                      "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


@register("geo_round")
def geo_round(spark, sf_dir):
    g = _geo_source(spark, sf_dir)
    return g.select("trip_id", "leg", *[r(geo.round_coordinate(c), 6).alias(f"{c}_r")
                                        for c in ("pickup_latitude", "pickup_longitude",
                                                  "dropoff_latitude", "dropoff_longitude")])


@register("haversine_km")
def haversine_km(spark, sf_dir):
    g = _geo_source(spark, sf_dir)
    c = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    rc = [geo.round_coordinate(x) for x in c]
    return g.select("trip_id", "leg", r(geo.haversine_km(*c), 6).alias("h_distance"),
                    r(geo.haversine_km(*rc), 6).alias("h_distance_rounded"))


@register("taxi_features")
def taxi_features(spark, sf_dir):
    """D1-D10 as one stage on the cleaned trips: parts, weekday, weekend, distance."""
    from lodestar.operators import features
    df = cleaned_taxi(spark, sf_dir)
    out = features.add_taxi_features(df, pickup="pickup_datetime", dropoff=None, round_step=None)
    return out.select("trip_id", "leg", "hour", "year", "month", "day", "day_of_week", "is_weekend",
                      "h_distance")


# --------------------------------------------------------------------------- encoders
from lodestar.operators import encoders  # noqa: E402


@register("label_encode")
def label_encode(spark, sf_dir):
    part = load(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type"])
    train, test = sampling.train_test_split(part, "p_partkey", 0.7, seed=1)
    enc = encoders.LabelEncoder(["p_brand", "p_type"]).fit(train)
    return enc.transform(test).select("p_partkey", "p_brand_code", "p_type_code")


@register("category_codes")
def category_codes(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    od = od.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    out = encoders.category_codes(od, ["o_orderpriority", "o_orderstatus"])
    return out.select("o_orderkey", "o_orderpriority_code", "o_orderstatus_code")


@register("target_encode_oof")
def target_encode_oof(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    od = od.select("o_orderkey", "o_orderpriority",
                   (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                   sampling.interleaved_fold("o_orderkey", 5).alias("fold"))
    out = encoders.target_encode_oof(od, "o_orderpriority", "y", "fold", smooth=0.001, out="te")
    return out.select("o_orderkey", "fold", r(F.col("te"), 6).alias("te"))


@register("target_encode_apply")
def target_encode_apply(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    od = od.select("o_orderkey", (F.pmod("o_custkey", F.lit(97))).alias("cust_bucket"),
                   (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    train, test = sampling.train_test_split(od, "o_orderkey", 0.8, seed=2)
    out = encoders.target_encode_apply(train, test, "cust_bucket", "y", smooth=0.001, out="te")
    return out.select("o_orderkey", r(F.col("te"), 6).alias("te"))


# --------------------------------------------------------------------------- feature generation / selection
from lodestar.operators import combos, selection  # noqa: E402

LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@register("pairwise_sums")
def pairwise_sums(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *LINE_NUMERIC[:-1]])
    li = li.withColumn("l_linenumber_f", F.col("l_linenumber").cast("double"))
    cols = [*LINE_NUMERIC[:-1], "l_linenumber_f"]
    gen = combos.pairwise_features(li, cols, "+", keep_original=True)
    new = [c for c in gen.columns if c not in li.columns]
    return gen.select("l_orderkey", "l_linenumber", *[r(F.col(c), 6).alias(c) for c in new])


@register("chi2_scores")
def chi2_scores(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_returnflag"])
    # Exact (decimal) inputs so the per-class sums do not depend on summation order.
    li = li.select("l_returnflag", *[F.col(c).cast("decimal(18,2)").alias(c)
                                     for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")])
    out = selection.chi2_scores(li, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_returnflag")
    return out.select("feature", r(F.col("chi2"), 6).alias("chi2"), "rank")


# --------------------------------------------------------------------------- aggregates
from lodestar.operators import aggregates  # noqa: E402
from lodestar.operators import metrics as metric_ops  # noqa: E402
from lodestar.operators import trials as trial_ops  # noqa: E402
from lodestar.plans import scan  # noqa: E402


def _timing(spark, sf_dir):
    """events as a timing table: type, workers, hardware, elapsed (ms)."""
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    return ev.select("event_id", F.col("event_type").alias("type"),
                     (F.pmod("user_id", F.lit(4)) + 1).cast("int").alias("n_workers"),
                     F.when(F.hour("ts") < 12, F.lit("cpu")).otherwise(F.lit("gpu")).alias("hardware"),
                     F.col("value").alias("elapsed_ms"))


def _trial_log(spark, sf_dir):
    """events as a trial log: trial = user, step = position by (ts, event_id), metric = value."""
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    return trial_ops.trial_log(ev.withColumnRenamed("user_id", "trial"), "trial", ["ts", "event_id"], "value")


def _trial_log_running(spark, sf_dir):
    """The trial log with each trial's running mean of value, from one scan."""
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    return trial_ops.trial_log_running_mean(ev.withColumnRenamed("user_id", "trial"), "trial", ["ts", "event_id"],
                                            "value", out="running_mean")


@register("tip_ratio_by_size")
def tip_ratio_by_size(spark, sf_dir):
    from lodestar.functions import ratio_percent
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice", "l_tax"])
    df = li.select(F.col("l_quantity").cast("int").alias("size"),
                   ratio_percent(F.col("l_extendedprice") * F.col("l_tax"), "l_extendedprice").alias("tip_percentage"))
    out = aggregates.grouped_mean(df, ["size"], "tip_percentage", out="mean_tip_percentage")
    return out.select("size", r(F.col("mean_tip_percentage"), 6).alias("mean_tip_percentage"))


@register("elapsed_ci")
def elapsed_ci(spark, sf_dir):
    t = _timing(spark, sf_dir)
    out = aggregates.confidence_interval(t, ["type", "n_workers", "hardware"], "elapsed_ms", scale=0.001,
                                         exact_scale=2)
    return out.select("type", "n_workers", "hardware", "n", fr(F.col("mean")).alias("mean"),
                      *[r(F.col(c), 6).alias(c) for c in ("std", "ci", "ci_low", "ci_high")])


@register("box_stats")
def box_stats(spark, sf_dir):
    t = _timing(spark, sf_dir)
    out = aggregates.box_stats(t, ["type", "n_workers"], "elapsed_ms", exact=True)
    return out.select("type", "n_workers", "n",
                      *[r(F.col(c), 6).alias(c) for c in ("q1", "median", "q3", "iqr", "min", "max")])


@register("throughput_ratio")
def throughput_ratio(spark, sf_dir):
    t = _timing(spark, sf_dir).withColumn("elapsed_dec", F.col("elapsed_ms").cast("decimal(18,2)"))
    out = aggregates.throughput(t, "type", "elapsed_dec", baseline="view", divisor=1000.0)
    return out.select("type", "rows", F.col("elapsed").alias("elapsed_s"), r(F.col("rows_per_s"), 6).alias("rows_per_s"),
                      r(F.col("speedup"), 6).alias("speedup"))


@register("best_so_far")
def best_so_far(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    curves = aggregates.best_so_far(ev, "user_id", ["ts", "event_id"], "value", step="step", out="best")
    return curves.groupBy("step").agg(fr(xmean("best")).alias("mean_best"), F.count("best").alias("n_runs"))


@register("replicate_band")
def replicate_band(spark, sf_dir):
    out = aggregates.replicate_band(_trial_log(spark, sf_dir), "step", "value", exact_scale=2)
    return out.select("step", fr(F.col("mean")).alias("mean"),
                      *[r(F.col(c), 6).alias(c) for c in ("std", "max", "min", "upper", "lower")])


@register("union_years")
def union_years(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                          "l_shipdate"])
    extra = (["l_quantity"], ["l_quantity", "l_discount"], ["l_tax", "l_quantity"])  # the years' files differ in columns
    years = [r[0] for r in li.select(F.year("l_shipdate")).distinct().collect()]
    return aggregates.union_by_name([li.filter(_in_year(li, "l_shipdate", y)).select("l_orderkey", "l_linenumber", *extra[y % 3])
                                     for y in sorted(y for y in years if y is not None)])


def _values(df: DataFrame, column: str) -> list:
    """The distinct values that become columns, from the data; fails beyond Spark's limit of pivot columns."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(column).distinct().orderBy(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return [r[0] for r in rows]


@register("score_heatmap")
def score_heatmap(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_linenumber", "l_returnflag", "l_discount"])
    return (li.groupBy("l_linenumber").pivot("l_returnflag", _values(li, "l_returnflag"))
              .agg(fr(xmean("l_discount"))))


@register("preview_head")
def preview_head(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
    return od.orderBy("o_orderkey").limit(5)


# --------------------------------------------------------------------------- metrics
def _doc_predictions(spark, sf_dir):
    lab = load(spark, sf_dir, "labels", ["doc_id", "quality"])
    docs = load(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    j = lab.join(docs, "doc_id")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("n_chars").cast("double") - F.lit(1500.0)) / F.lit(500.0)))
    return j.select("doc_id", "quality", "n_chars", p.alias("prob"),
                    (F.col("n_chars") >= 1500).cast("int").alias("pred"))


@register("accuracy")
def accuracy(spark, sf_dir):
    out = metric_ops.accuracy(_doc_predictions(spark, sf_dir), "quality", "pred")
    return out.select("n", fr(F.col("accuracy")).alias("accuracy"), r(F.col("error_rate"), 6).alias("error_rate"))


@register("auc_rank")
def auc_rank(spark, sf_dir):
    out = metric_ops.auc_rank(_doc_predictions(spark, sf_dir), "quality", "n_chars")
    return out.select("n_pos", "n_neg", r(F.col("auc"), 6).alias("auc"))


@register("logloss")
def logloss(spark, sf_dir):
    out = metric_ops.log_loss(_doc_predictions(spark, sf_dir), "quality", "prob")
    return out.select("n", r(F.col("log_loss"), 6).alias("log_loss"))


def _price_predictions(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice", "l_discount"])
    return li.select((F.col("l_extendedprice") / 1000).alias("y"),
                     (F.col("l_quantity") * F.lit(1.5) * (F.lit(1.0) - F.col("l_discount"))).alias("pred"))


@register("rmse")
def rmse(spark, sf_dir):
    out = metric_ops.regression_metrics(_price_predictions(spark, sf_dir), "y", "pred")
    return out.select("n", r(F.col("mse"), 6).alias("mse"), r(F.col("rmse"), 6).alias("rmse"),
                      r(F.col("mae"), 6).alias("mae"))


@register("r2")
def r2(spark, sf_dir):
    out = metric_ops.regression_metrics(_price_predictions(spark, sf_dir), "y", "pred")
    return out.select("n", r(F.col("r2"), 6).alias("r2"))


def embedding_cluster(col: str = "embedding"):
    """Cluster id = position of the largest coordinate (0-based)."""
    return (F.array_position(F.col(col), F.array_max(F.col(col))) - 1).cast("int")


@register("purity")
def purity(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    out = metric_ops.cluster_purity(emb.select(embedding_cluster().alias("cluster"), "label"), "cluster", "label")
    return out.select("n_clusters", "n", r(F.col("purity"), 6).alias("purity"))


# --------------------------------------------------------------------------- trials
@register("trial_table")
def trial_table(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"]).withColumnRenamed("user_id", "trial")
    out = trial_ops.trial_summary(ev, "trial", ["ts", "event_id"], "value", complete_at=60, ts="ts", exact_scale=2)
    return out.select("trial", "n_steps", r(F.col("best"), 6).alias("best"), r(F.col("last"), 6).alias("last"),
                      fr(F.col("mean")).alias("mean"), "is_bad", "start", "complete", "state")


@register("nonfinite_trials")
def nonfinite_trials(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    scored = ev.select("event_id", F.col("user_id").alias("trial"),
                       F.when((F.col("event_type") == "error") & (F.col("value") > 300), F.lit(float("nan")))
                        .otherwise(F.col("value")).alias("score"))
    return trial_ops.nonfinite_rows(scored, "score").select("event_id", "trial")


@register("best_trial")
def best_trial(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["user_id", "value"])
    scores = ev.groupBy(F.col("user_id").alias("trial")).agg(fr(xmean("value")).alias("score"),
                                                             F.count(F.lit(1)).alias("n"))
    return trial_ops.best_trial(scores, "trial", "score")


@register("median_stop")
def median_stop(spark, sf_dir):
    return trial_ops.median_stopping(_trial_log_running(spark, sf_dir), "trial", "step", "value",
                                     grace_period=1, min_samples=3, running="running_mean")


@register("halving_rungs")
def halving_rungs(spark, sf_dir):
    out = trial_ops.successive_halving(_trial_log_running(spark, sf_dir), "trial", "step", "value",
                                       max_t=50, grace_period=1, reduction=3, running="running_mean")
    return out.select("rung", "trial", r(F.col("metric"), 6).alias("metric"), "rank", "promoted")


@register("param_importance")
def param_importance(spark, sf_dir):
    ev = load(spark, sf_dir, "events", ["user_id", "value"])
    scores = ev.groupBy(F.col("user_id").alias("trial")).agg(F.avg("value").alias("score")).select(
        "trial", "score",
        portable_bucket("trial", 21, 5).alias("lr_bin"),
        portable_bucket("trial", 22, 4).alias("depth"),
        portable_bucket("trial", 23, 3).alias("reg"))
    out = trial_ops.param_importance(scores, ["lr_bin", "depth", "reg"], "score")
    return out.select("param", r(F.col("eta_sq"), 6).alias("eta_sq"), "rank")


@register("scaling_sweep")
def scaling_sweep(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey"])
    out = trial_ops.scaling_sweep(od, "o_orderkey", [1, 2, 4, 8], max_fraction=0.5)
    return out.select("scaling_type", "n_workers", r(F.col("fraction"), 6).alias("fraction"), "rows",
                      r(F.col("rows_per_worker"), 6).alias("rows_per_worker"))


# --------------------------------------------------------------------------- linear models / explanation
from lodestar.operators import linear, neighbors  # noqa: E402


def _line_xy(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                          "l_extendedprice"])
    return li.withColumn("y", F.col("l_extendedprice") / 1000)


@register("ols_normal_eq")
def ols_normal_eq(spark, sf_dir):
    fit = linear.fit_linear(_line_xy(spark, sf_dir), ["l_quantity", "l_discount"], "y")
    return fit.coefficient_frame(spark).select("term", r(F.col("value"), 6).alias("value"))


@register("ridge_grid")
def ridge_grid(spark, sf_dir):
    df = _line_xy(spark, sf_dir).withColumn(
        "fold", portable_bucket(F.col("l_orderkey") * 8 + F.col("l_linenumber"), 0, 5).cast("int"))
    out = linear.ridge_cv(df, ["l_quantity"], "y", "fold", [0.0, 10.0, 100.0, 1000.0])
    return out.select("lambda", "fold", r(F.col("mse"), 6).alias("mse"), "n_heldout")


SHAP_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _linear_shap_frame(spark, sf_dir):
    df = _line_xy(spark, sf_dir)
    fit = linear.fit_linear(df, SHAP_FEATURES, "y")
    contrib = fit.contributions(prefix="c_")
    return df.select("l_orderkey", "l_linenumber", *[c.alias(k) for k, c in contrib.items()],
                     F.lit(float(fit.label_mean)).alias("bias"), fit.prediction().alias("prediction"))


@register("linear_shap")
def linear_shap(spark, sf_dir):
    out = _linear_shap_frame(spark, sf_dir)
    return out.select("l_orderkey", "l_linenumber",
                      *[r(F.col(c), 6).alias(c) for c in out.columns if c not in ("l_orderkey", "l_linenumber")])


@register("importance_topk")
def importance_topk(spark, sf_dir):
    from lodestar.operators import explain
    contrib = _linear_shap_frame(spark, sf_dir)
    imp = explain.global_importance(contrib, [f"c_{f}" for f in SHAP_FEATURES])
    top = explain.top_k_importance(imp, 2)
    return top.select("feature", r(F.col("importance"), 6).alias("importance"), "rank")


@register("knn_exact")
def knn_exact(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    nb = neighbors.knn(emb, emb, "vec_id", "embedding", k=5, include_self=True)
    return nb.select("query_id", "neighbor_id", r(F.col("distance"), 6).alias("distance"), "rank")


@register("knn_classify")
def knn_classify(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    nb = neighbors.knn(emb, emb, "vec_id", "embedding", k=5, include_self=False)
    pred = neighbors.knn_classify(nb, emb, "vec_id", "label")
    return pred.join(emb.select(F.col("vec_id").alias("query_id"), "label"), "query_id")


# --------------------------------------------------------------------------- delay label / models
from lodestar.operators import models  # noqa: E402


def delay_table(spark, sf_dir):
    """Flights with a binary label (delay > 10 days), leaking column dropped, origin encoded,
    columns reordered label first + alphabetical inputs."""
    df = fixtures.flights(spark, sf_dir)
    df = clean.add_threshold_label(df, "ArrDelay", "ArrDelayBinary", 10.0, drop_source=True)
    df = df.withColumn("Origin_code", F.substring("Origin", 1, 1).try_cast("int")).drop("Origin")
    inputs = clean.columns_difference(df, ["ArrDelayBinary", "flight_id"])
    return clean.select_label_first(df, "ArrDelayBinary", ["flight_id", *inputs])


@register("delay_label")
def delay_label(spark, sf_dir):
    return delay_table(spark, sf_dir)


def _delay_split(spark, sf_dir):
    df = delay_table(spark, sf_dir).withColumn("ArrDelayBinary", F.col("ArrDelayBinary").cast("double"))
    return sampling.train_test_split(df, "flight_id", 0.8, seed=0)


@register("rf_fit")
def rf_fit(spark, sf_dir):
    train, test = _delay_split(spark, sf_dir)
    m = models.fit_cached(models.random_forest(list(fixtures.FLIGHT_FEATURES), "ArrDelayBinary", n_estimators=10,
                                               max_depth=5, max_features=1.0, n_bins=64, seed=0), train,
                          key="flight_id")
    return models.score(m, test, ["flight_id", "ArrDelayBinary"])


def delay_days_table(spark, sf_dir):
    """Flights with the delay in days as a regression target (origin encoded)."""
    df = fixtures.flights(spark, sf_dir)
    return (df.withColumn("Origin_code", F.substring("Origin", 1, 1).try_cast("int")).drop("Origin")
              .withColumn("ArrDelay", F.col("ArrDelay").cast("double")))


@register("gbt_fit")
def gbt_fit(spark, sf_dir):
    """Boosted-tree regression of the delay (days): depth 5, lr 0.15, row/column subsampling 0.7."""
    train, test = sampling.train_test_split(delay_days_table(spark, sf_dir), "flight_id", 0.8, seed=0)
    m = models.fit_cached(models.boosted_trees(list(fixtures.FLIGHT_FEATURES), "ArrDelay", task="regression",
                                               n_rounds=10, max_depth=5, learning_rate=0.15, subsample=0.7,
                                               colsample=0.7), train, key="flight_id")
    return models.score(m, test, ["flight_id", "ArrDelay"], classification=False)


@register("logreg_fit")
def logreg_fit(spark, sf_dir):
    train, test = _delay_split(spark, sf_dir)
    m = models.fit_cached(lambda n: models.logistic_regression(list(fixtures.FLIGHT_FEATURES), "ArrDelayBinary", penalty="elasticnet",
                                                               C=1.0, l1_ratio=0.5, n_rows=n), train)
    return models.score(m, test, ["flight_id", "ArrDelayBinary"])


def _embedding_vectors(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    from pyspark.ml.functions import array_to_vector
    return emb.withColumn("features", array_to_vector("embedding"))


@register("kmeans_fit")
def kmeans_fit(spark, sf_dir):
    emb = _embedding_vectors(spark, sf_dir)
    m = models.kmeans(None, k=10, max_iter=50, tol=1e-5, seed=1, vector_col="features").fit(emb)
    return m.transform(emb).select("vec_id", "label", "cluster")


@register("pca_fit")
def pca_fit(spark, sf_dir):
    emb = _embedding_vectors(spark, sf_dir)
    m = models.centered_pca(None, k=5, vector_col="features").fit(emb)
    from pyspark.ml.functions import vector_to_array
    out = m.transform(emb).select("vec_id", vector_to_array("pca").alias("p"))
    return out.select("vec_id", *[F.col("p")[i].alias(f"pc{i}") for i in range(5)])


@register("svd_fit")
def svd_fit(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    vecs, _ = models.truncated_svd(emb, "embedding", 64, k=5)
    return emb.select("vec_id", *[c.alias(k) for k, c in models.project("embedding", vecs, "sv").items()])


@register("rff_svm")
def rff_svm(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    emb = emb.withColumn("y", (F.col("label") < 5).cast("double"))
    feats = emb.select("vec_id", "y", models.random_fourier_features("embedding", 64, 64, gamma=1.0, seed=0))
    train, test = sampling.train_test_split(feats, "vec_id", 0.8, seed=0)
    m = models.linear_svc("y", C=100.0, n_rows=train.count()).fit(train)
    return m.transform(test).select("vec_id", "y", "prediction")


@register("linear_family")
def linear_family(spark, sf_dir):
    df = _line_xy(spark, sf_dir)
    feats = ["l_quantity", "l_discount", "l_tax"]
    rows = []
    for name, reg, enet, solver in [("ols", 0.0, 0.0, "normal"), ("ridge", 0.1, 0.0, "normal"),
                                    ("lasso", 0.1, 1.0, "auto"), ("elastic_net", 0.1, 0.5, "auto"),
                                    ("cd_lbfgs", 0.0, 0.0, "l-bfgs")]:
        lm = linear.spark_ml_linear(df, feats, "y", reg=reg, elastic_net=enet, solver=solver).stages[-1]
        rows.append((name, "intercept", float(lm.intercept)))
        rows += [(name, f, float(c)) for f, c in zip(feats, lm.coefficients.toArray())]
    return spark.createDataFrame(rows, "model string, term string, value double")


@register("leaderboard")
def leaderboard(spark, sf_dir):
    """RF, boosted trees, logistic regression and KNN on one split; soft-vote ensemble row."""
    train, test = _delay_split(spark, sf_dir)
    # Several fits and evaluations read the same split: cache it once, release at the end.
    train = models.dealt(train, "flight_id").persist()
    test = models.right_size(test, grow=True).persist()
    feats = list(fixtures.FLIGHT_FEATURES)
    label = "ArrDelayBinary"
    builders = {
        "random_forest": models.random_forest(feats, label, n_estimators=10, max_depth=6, seed=0),
        "boosted_trees": models.boosted_trees(feats, label, n_rounds=10, max_depth=4, seed=0),
        "logistic_regression": models.logistic_regression(feats, label, penalty="l2", C=1.0, n_rows=train.count()),
    }
    preds = {}
    for name, est in builders.items():
        preds[name] = models.score(est.fit(train), test, ["flight_id", label])
    # KNN member on standardised inputs: probability = share of positive neighbours.
    scaled = _standardized_vectors(train, test, feats)
    nb = neighbors.knn(scaled["test"], scaled["train"], "flight_id", "vec", k=15, include_self=False)
    lab = train.select(F.col("flight_id").alias("neighbor_id"), F.col(label).alias("__y"))
    knn_p = nb.join(lab, "neighbor_id").groupBy(F.col("query_id").alias("flight_id")).agg(F.avg("__y").alias("prob"))
    preds["knn"] = knn_p.join(test.select("flight_id", label), "flight_id").withColumn(
        "prediction", (F.col("prob") > 0.5).cast("double"))
    # each model scores the rows once: accuracy, AUC and the ensemble read the kept scores
    preds = {name: p.persist() for name, p in preds.items()}
    rows = []
    frames = []
    for name, p in preds.items():
        frames.append(p.select("flight_id", F.col("prob").alias(name)))
        acc = metric_ops.accuracy(p, label, "prediction").collect()[0]["accuracy"]
        rows.append((name, float(acc), models.auc(p, label)))
    ens = frames[0]
    for f in frames[1:]:
        ens = ens.join(f, "flight_id")
    ens = ens.withColumn("prob", sum(F.col(n) for n in preds) / F.lit(float(len(preds))))
    ens = ens.join(test.select("flight_id", label), "flight_id").withColumn(
        "prediction", (F.col("prob") > 0.5).cast("double"))
    rows.append(("soft_vote", float(metric_ops.accuracy(ens, label, "prediction").collect()[0]["accuracy"]),
                 models.auc(ens, label)))
    board = spark.createDataFrame(rows, "model string, accuracy double, auc double")
    for kept in (train, test, *preds.values()):
        kept.unpersist()
    from pyspark.sql import Window
    return board.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("auc"), F.asc("model"))))


def _standardized_vectors(train, test, feats):
    stats = train.agg(*[F.avg(f).alias(f"m_{f}") for f in feats], *[F.stddev_pop(f).alias(f"s_{f}") for f in feats])
    row = stats.collect()[0]  # 2 * #features numbers

    def vec(df):
        return df.select("flight_id", F.array(*[
            ((F.col(f) - F.lit(float(row[f"m_{f}"] or 0.0))) / F.lit(float(row[f"s_{f}"] or 1.0) or 1.0))
            for f in feats]).alias("vec"))
    return {"train": vec(train), "test": vec(test)}


@register("tree_shap_sampled")
def tree_shap_sampled(spark, sf_dir):
    """Sampled Shapley values of a boosted-tree delay model for every held-out row."""
    from lodestar.operators import explain
    train, test = sampling.train_test_split(delay_days_table(spark, sf_dir), "flight_id", 0.8, seed=0)
    feats = list(fixtures.FLIGHT_FEATURES)
    m = models.fit_cached(models.boosted_trees(feats, "ArrDelay", task="regression", n_rounds=10, max_depth=4),
                          train, key="flight_id")
    background = sampling.fixed_count_sample(train, "flight_id", 200, seed=1)
    return explain.sampled_shapley(m, test, background, "flight_id", feats, n_samples=16, seed=0)


@register("grid_search")
def grid_search(spark, sf_dir):
    train, _ = _delay_split(spark, sf_dir)
    train = train.withColumn("fold", sampling.kfold_column("flight_id", 3, seed=0)).persist()
    try:
        est = models.logistic_regression(list(fixtures.FLIGHT_FEATURES), "ArrDelayBinary", n_rows=train.count())
        return models.grid_search(est, {"regParam": [0.0, 0.01], "elasticNetParam": [0.0, 1.0]}, train,
                                  "ArrDelayBinary", "fold", parallelism=2)
    finally:
        train.unpersist()


@register("random_search")
def random_search(spark, sf_dir):
    train, test = _delay_split(spark, sf_dir)
    space = trial_ops.SearchSpace({"max_depth": ("int", 3, 8), "n_estimators": ("int", 5, 15),
                                   "max_features": ("uniform", 0.3, 1.0)})
    cands = space.random(4, seed=0)
    feats = list(fixtures.FLIGHT_FEATURES)

    def build(c):
        return models.random_forest(feats, "ArrDelayBinary", n_estimators=int(c["n_estimators"]),
                                    max_depth=int(c["max_depth"]), max_features=float(c["max_features"]), seed=0)
    return models.evaluate_candidates(cands, build, models.dealt(train, "flight_id").persist(), test.persist(), "ArrDelayBinary", parallelism=2)


# --------------------------------------------------------------------------- request / stream scoring
import hashlib  # noqa: E402

from lodestar.session import shared_path  # noqa: E402


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:12]


def _request_bodies(spark, sf_dir):
    """Request bodies built from embeddings: 8 consecutive vectors per request; every
    ninth request is malformed text."""
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    inst = emb.select(F.floor(F.col("vec_id") / 8).cast("long").alias("request_id"), "vec_id",
                      F.col("embedding").cast("array<double>").alias("x"))
    grouped = inst.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("vec_id", "x"))).alias("__r"))
    body = F.to_json(F.transform("__r", lambda s: s["x"]))
    return grouped.select("request_id", F.when(F.pmod("request_id", F.lit(9)) == 0,
                                               F.concat(F.lit("{not json "), F.col("request_id").cast("string")))
                          .otherwise(body).alias("body"))


def _embedding_classifier(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    train = emb.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                       (F.col("label") < 5).cast("double").alias("y"))
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(featuresCol="features", labelCol="y", regParam=0.01, maxIter=50).fit(train)


@register("json_score_batch")
def json_score_batch(spark, sf_dir):
    from lodestar.streaming import score_requests
    model = _embedding_classifier(spark, sf_dir)
    return score_requests(model, _request_bodies(spark, sf_dir), "request_id", "body", n_features=model.numFeatures,
                          threshold=0.5)


@register("stream_score")
def stream_score(spark, sf_dir):
    """Embeddings land as files; a Structured Streaming query scores them in bounded batches."""
    from pyspark.ml.functions import array_to_vector
    from lodestar.streaming import stream_score as run_stream
    run = shared_path(spark, "stream_score", _tag(sf_dir), unique=True)
    landing, out, ckpt = f"{run}/landing", f"{run}/scored", f"{run}/_checkpoint"
    emb = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    emb.repartition(4, "vec_id").write.mode("overwrite").parquet(landing)
    model = _embedding_classifier(spark, sf_dir)

    def prepare(df):
        return df.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    return run_stream(spark, model, landing, emb.schema, out, ckpt, prepare, keep=["vec_id"])


# --------------------------------------------------------------------------- sources and sinks
from lodestar import sources  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

CSV_SCHEMA = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("line", T.IntegerType()),
                           T.StructField("qty", T.FloatType()), T.StructField("price", T.DoubleType()),
                           T.StructField("ship_ts", T.TimestampNTZType()), T.StructField("flag", T.StringType())])


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Write chosen columns as headered CSV, read back with names imposed by position and typed schema."""
    path = shared_path(spark, "csv_roundtrip", _tag(sf_dir), unique=True)
    li = load(spark, sf_dir, "lineitem")
    sources.write_csv_columns(li, path, ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                         "l_shipdate", "l_returnflag"])
    return sources.read_csv(spark, path, CSV_SCHEMA, header=True)


@register("orc_cache")
def orc_cache(spark, sf_dir):
    """Prepare-once cache of the cleaned trips as ORC (written only when absent)."""
    path = shared_path(spark, "orc_cache", f"{_tag(sf_dir)}-v1")
    return sources.write_orc_once(cleaned_taxi(spark, sf_dir), path)


def _orders_partitioned(spark, sf_dir) -> str:
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    od = od.withColumns({"o_year": F.year("o_orderdate"), "o_month": F.month("o_orderdate")})
    return sources.write_once(od, shared_path(spark, "orders_by_month", f"{_tag(sf_dir)}-v1"),
                              partition_by=["o_year", "o_month"])


@register("partition_scan")
def partition_scan(spark, sf_dir):
    base = _orders_partitioned(spark, sf_dir)
    df = sources.read_partitioned(spark, base, "o_year = 1996 AND o_month IN (11, 12)")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_year", "o_month")


@register("glob_scan")
def glob_scan(spark, sf_dir):
    """Path glob over partition folders (month 1* matches 1, 10, 11, 12)."""
    base = _orders_partitioned(spark, sf_dir)
    df = spark.read.option("basePath", base).parquet(f"{base}/o_year=1997/o_month=1*")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_year", "o_month")


@register("date_range_scan")
def date_range_scan(spark, sf_dir):
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return sources.read_date_range(od, "o_orderdate", "1996-01-01", "1996-03-31")


PART_SPEC_FIELDS = [("p_partkey", T.LongType()), ("p_brand", T.StringType()), ("p_size", T.IntegerType()),
                    ("p_retailprice", T.DoubleType())]


@register("format_detect")
def format_detect(spark, sf_dir):
    """A folder holding both CSV and Parquet copies: the CSV files are the ones read."""
    path = shared_path(spark, "format_detect", _tag(sf_dir), unique=True)
    part = load(spark, sf_dir, "part", [n for n, _ in PART_SPEC_FIELDS])
    part.write.mode("overwrite").option("header", True).csv(path)
    part.filter("p_size > 25").write.mode("append").parquet(path)
    spec = sources.DatasetSpec(T.StructType([T.StructField(n, t) for n, t in PART_SPEC_FIELDS]))
    return sources.read_detected(spark, path, spec)


@register("delimited_label")
def delimited_label(spark, sf_dir):
    """Headerless ';'-separated numeric text: delimiter sniffed, label and weight picked by index."""
    path = shared_path(spark, "delimited", _tag(sf_dir), unique=True)
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_discount", "l_extendedprice", "l_tax", "l_linenumber"])
    li.write.mode("overwrite").option("sep", ";").option("header", False).csv(path)
    return sources.read_delimited_with_label(spark, path, n_columns=5, label_column=2, weight_column=1)


@register("row_limited")
def row_limited(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem", [*fixtures.LINE_KEY, "l_quantity"])
    return sources.limit_rows(li, 1000, order_by=list(fixtures.LINE_KEY))


@register("spec_ingest")
def spec_ingest(spark, sf_dir):
    """Spec-driven ingest: rename, pushed filters, keep-list with casts (absent column -> NULL), fill."""
    spec = sources.DatasetSpec(
        T.StructType([T.StructField("order_key", T.LongType()), T.StructField("qty", T.FloatType()),
                      T.StructField("price", T.FloatType()), T.StructField("tip", T.FloatType()),
                      T.StructField("ship_ts", T.TimestampNTZType())]),
        rename={"l_orderkey": "order_key", "l_quantity": "qty", "l_extendedprice": "price",
                "l_shipdate": "ship_ts", "no_such_column": "x"},
        filters=("qty > 10", "price < 50000"), fill=0.0)
    return sources.read_dataset(spark, fixtures_path(sf_dir, "lineitem"), spec)


def fixtures_path(sf_dir, name):
    from lodestar.plans.catalog import table_path
    return table_path(sf_dir, name)


@register("result_append")
def result_append(spark, sf_dir):
    """Overwrite a result table with the first event type's records, append those of the others, read the table."""
    path = shared_path(spark, "results", _tag(sf_dir), unique=True)
    ev = load(spark, sf_dir, "events", ["user_id", "event_type", "value"])

    def batch(kind):
        return (ev.filter(F.col("event_type") == kind).groupBy("user_id")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("best"))
                  .withColumn("kind", F.lit(kind)))
    for i, kind in enumerate(_values(ev, "event_type")):
        table = sources.write_result_table(batch(kind), path, append_to_existing=i > 0)
    return table


@register("split_artifact")
def split_artifact(spark, sf_dir):
    """Persist the held-out split (for later explanation) and read it back."""
    path = shared_path(spark, "split_artifact", _tag(sf_dir), unique=True)
    _, test = sampling.train_test_split(cleaned_taxi(spark, sf_dir), "row_id", 0.8, seed=0)
    return sources.write_split(test, path, key_cols=["row_id"])


# --------------------------------------------------------------------------- workflows
@register("feature_search")
def feature_search(spark, sf_dir):
    """Encode + pairwise features + chi-square ranking + 10-trial logistic-regression search."""
    from lodestar.plans.workflows import feature_search as run
    return run(spark, sf_dir, n_trials=10)


# --------------------------------------------------------------------------- more trial/score tables
@register("fold_scores")
def fold_scores(spark, sf_dir):
    """Per-lambda mean / best / worst / total of the held-out fold errors (fold mean = final score)."""
    folds = ridge_grid(spark, sf_dir)
    out = metric_ops.fold_summary(folds, ["lambda"], "mse", higher_is_better=False)
    return out.select("lambda", *[r(F.col(c), 6).alias(c) for c in ("mean_score", "best_score", "worst_score",
                                                                     "total")], "n_folds")


@register("aligned_runs")
def aligned_runs(spark, sf_dir):
    """Runs (one per event type) aligned side by side by their step index (column-wise concat)."""
    ev = load(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    steps = scan.row_number(ev, ["event_type"], ["ts", "event_id"], out="step")
    return steps.groupBy("step").pivot("event_type", _values(ev, "event_type")).agg(F.first("value"))


@register("optimization_history")
def optimization_history(spark, sf_dir):
    """Trial scores in trial order with the best value found so far (the table behind the plot)."""
    ev = load(spark, sf_dir, "events", ["user_id", "value"])
    scores = ev.groupBy(F.col("user_id").alias("trial")).agg(fr(xmean("value")).alias("score"))
    return scan.running_aggregate(scores, [], ["trial"], {"best_so_far": ("max", "score")})


@register("rf_regress_fit")
def rf_regress_fit(spark, sf_dir):
    train, test = sampling.train_test_split(delay_days_table(spark, sf_dir), "flight_id", 0.8, seed=0)
    m = models.fit_cached(models.random_forest(list(fixtures.FLIGHT_FEATURES), "ArrDelay", task="regression",
                                               n_estimators=10, max_depth=12, seed=0), train, key="flight_id")
    return models.score(m, test, ["flight_id", "ArrDelay"], classification=False)


@register("scaled_linear")
def scaled_linear(spark, sf_dir):
    """Standard scaler -> linear regression pipeline, fit on train rows, scored on test rows."""
    df = _line_xy(spark, sf_dir).withColumn("row_id", portable_bucket("l_orderkey", 9, 1000))
    train, test = sampling.train_test_split(df, "l_orderkey", 0.8, seed=4)
    m = models.scaled_linear(["l_quantity", "l_discount", "l_tax"], "y").fit(train)
    out = models.score(m, test, ["l_orderkey", "l_linenumber", "y"], classification=False)
    return out.withColumn("prediction", r("prediction", 6))


@register("refit_best_model")
def refit_best_model(spark, sf_dir):
    """Random search, then the best trial's parameters refit on all labelled rows and scored."""
    train, test = _delay_split(spark, sf_dir)
    feats = list(fixtures.FLIGHT_FEATURES)

    def build(c):
        return models.random_forest(feats, "ArrDelayBinary", n_estimators=int(c["n_estimators"]),
                                    max_depth=int(c["max_depth"]), seed=0)
    space = trial_ops.SearchSpace({"max_depth": ("int", 3, 7), "n_estimators": ("int", 5, 10)})
    everything = models.dealt(train.unionByName(test), "flight_id").persist()
    train, test = (models.dealt(part, "flight_id").persist() for part in (train, test))
    table = models.evaluate_candidates(space.random(3, seed=1), build, train, test, "ArrDelayBinary")
    model = models.refit_best(table, build, everything)
    return models.score(model, everything, ["flight_id", "ArrDelayBinary"])


@register("tree_shap_interactions")
def tree_shap_interactions(spark, sf_dir):
    """Sampled pairwise interaction values of the boosted-tree delay model for every held-out row."""
    from lodestar.operators import explain
    train, test = sampling.train_test_split(delay_days_table(spark, sf_dir), "flight_id", 0.8, seed=0)
    feats = list(fixtures.FLIGHT_FEATURES)
    m = models.fit_cached(models.boosted_trees(feats, "ArrDelay", task="regression", n_rounds=10, max_depth=4),
                          train, key="flight_id")
    background = sampling.fixed_count_sample(train, "flight_id", 200, seed=1)
    return explain.sampled_interactions(m, test, background, "flight_id", feats, n_samples=8, seed=0)


@register("json_score_stream")
def json_score_stream(spark, sf_dir):
    """Request bodies land as JSON files; a streaming query scores them (malformed -> 'unsupported')."""
    from lodestar.streaming import score_requests
    from lodestar.streaming.scoring import finish
    run = shared_path(spark, "json_score_stream", _tag(sf_dir), unique=True)
    bodies = _request_bodies(spark, sf_dir)
    bodies.repartition(4, "request_id").write.mode("overwrite").json(f"{run}/in")
    model = _embedding_classifier(spark, sf_dir)
    stream = spark.readStream.schema(bodies.schema).option("maxBytesPerTrigger", 1 << 30).json(f"{run}/in")
    out = score_requests(model, stream, "request_id", "body", n_features=model.numFeatures, threshold=0.5)
    q = (out.writeStream.format("parquet").option("checkpointLocation", f"{run}/_checkpoint")
         .outputMode("append").trigger(availableNow=True).start(f"{run}/out"))
    finish(q)
    return spark.read.parquet(f"{run}/out")


@register("feature_engineering")
def feature_engineering(spark, sf_dir):
    """Target encoding + pairwise sums of the flight inputs, every feature scored by chi-square."""
    from lodestar.plans.workflows import feature_engineering as run
    return run(spark, sf_dir)


@register("holdout_cv")
def holdout_cv(spark, sf_dir):
    """One search trial as a job: repeated hold-out folds of a random forest on the delay table,
    best fold model saved, final score = fold mean."""
    params = models.load_hyperparameters(None, {"n_estimators": 10, "max_depth": 5, "max_features": 1.0,
                                                "n_bins": 64, "seed": 0})
    df = delay_table(spark, sf_dir).withColumn("ArrDelayBinary", F.col("ArrDelayBinary").cast("double"))
    feats = list(fixtures.FLIGHT_FEATURES)
    saver = models.BestModelSaver(shared_path(spark, "holdout_cv_best", _tag(sf_dir), unique=True))

    def build():
        return models.random_forest(feats, "ArrDelayBinary", n_estimators=int(params["n_estimators"]),
                                    max_depth=int(params["max_depth"]), max_features=params["max_features"],
                                    n_bins=int(params["n_bins"]), seed=int(params["seed"]))
    folds = models.holdout_cv(df, "flight_id", "ArrDelayBinary", build, seeds=[0, 1, 2], saver=saver)
    summary = metric_ops.fold_summary(folds.withColumn("__one", F.lit(1)), ["__one"], "accuracy")
    # one summary row, joined by broadcast on a constant key
    return folds.withColumn("__one", F.lit(1)).join(F.broadcast(summary.select("__one", "mean_score")),
                                                    "__one").drop("__one")


# --------------------------------------------------------------------------- fits with a closed form
def _coefficients(spark, model_rows):
    return spark.createDataFrame(model_rows, "model string, term string, value double").select(
        "model", "term", r(F.col("value"), 4).alias("value"))


@register("penalised_one_feature")
def penalised_one_feature(spark, sf_dir):
    """Lasso and elastic net on one feature, where soft thresholding gives the solution."""
    df = _line_xy(spark, sf_dir).select("l_quantity", "y")
    rows = []
    for name, reg, enet in (("lasso", 5.0, 1.0), ("lasso_zero", 1e6, 1.0), ("elastic_net", 5.0, 0.5)):
        lm = linear.spark_ml_linear(df, ["l_quantity"], "y", reg=reg, elastic_net=enet, max_iter=200).stages[-1]
        rows += [(name, "intercept", float(lm.intercept)), (name, "l_quantity", float(lm.coefficients[0]))]
    return _coefficients(spark, rows)


@register("logit_one_binary")
def logit_one_binary(spark, sf_dir):
    """Unpenalised logistic regression on one binary feature, where the coefficients are log odds."""
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    df = li.select((F.col("l_quantity") > 25).cast("double").alias("many"),
                   (F.col("l_extendedprice") > 40000).cast("double").alias("y"))
    est = models.logistic_regression(["many"], "y", penalty="none", n_rows=1, max_iter=200)
    lm = est.fit(df).stages[-1]
    rows = [("logit", "intercept", float(lm.intercept)), ("logit", "many", float(lm.coefficients[0]))]
    return spark.createDataFrame(rows, "model string, term string, value double").select(
        "model", "term", r(F.col("value"), 2).alias("value"))


def _quantity_model(spark, sf_dir):
    return linear.spark_ml_linear(_line_xy(spark, sf_dir), ["l_quantity"], "y", solver="normal")


@register("batch_linear_score")
def batch_linear_score(spark, sf_dir):
    """Batch scoring of every order line with a least-squares model of one feature."""
    li = _line_xy(spark, sf_dir)
    out = models.score(_quantity_model(spark, sf_dir), li, ["l_orderkey", "l_linenumber"], classification=False)
    return out.select("l_orderkey", "l_linenumber", r(F.col("prediction"), 4).alias("prediction"))


@register("stream_linear_score")
def stream_linear_score(spark, sf_dir):
    """The same scores from a stream over the files of the order lines."""
    from lodestar.streaming import stream_score as run_stream
    run = shared_path(spark, "stream_linear_score", _tag(sf_dir), unique=True)
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    li.repartition(4, "l_orderkey").write.parquet(f"{run}/landing")
    out = run_stream(spark, _quantity_model(spark, sf_dir), f"{run}/landing", li.schema, f"{run}/scored",
                     f"{run}/_checkpoint", lambda df: df, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", r(F.col("prediction"), 4).alias("prediction"))


@register("tree_stumps")
def tree_stumps(spark, sf_dir):
    """Regression trees of one level on all rows, a forest of one and one boosting round, by feature value."""
    li = load(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    df = li.select("l_quantity", (F.col("l_extendedprice") / 1000).alias("y")).persist()
    values = df.select("l_quantity").distinct()
    one = dict(n_estimators=1, max_depth=1, n_bins=64, bootstrap=False)
    fits = {"forest": models.random_forest(["l_quantity"], "y", task="regression", **one),
            "boosted": models.boosted_trees(["l_quantity"], "y", task="regression", n_rounds=1, max_depth=1, n_bins=64)}
    parts = []
    for name, est in fits.items():
        scored = models.score(est.fit(df), values, ["l_quantity"], classification=False)
        parts.append(scored.select(F.lit(name).alias("model"), "l_quantity", r(F.col("prediction"), 4).alias("value")))
    df.unpersist()
    return parts[0].unionByName(parts[1])


@register("rotation_norms")
def rotation_norms(spark, sf_dir):
    """Over all components, PCA keeps each row's distance from the mean and SVD its length."""
    from pyspark.ml.functions import vector_to_array
    emb = _embedding_vectors(spark, sf_dir)
    dim = emb.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x)
    pca = models.centered_pca(None, k=dim, vector_col="features").fit(emb).transform(emb)
    raw = load(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    vecs, _ = models.truncated_svd(raw, "embedding", dim, k=dim)
    svd = raw.select("vec_id", square(F.array(*models.project("embedding", vecs).values())).alias("s"))
    return (pca.select("vec_id", r(square(vector_to_array("pca")), 4).alias("pca_square"))
               .join(svd.select("vec_id", r(F.col("s"), 4).alias("svd_square")), "vec_id"))


# --------------------------------------------------------------------------- boosted trees with second-order gradients
from lodestar.operators import newton_trees  # noqa: E402

TWO_FEATURES = ["l_quantity", "l_discount"]


def _two_level_fits(spark, sf_dir):
    """One round of two levels over two features of all line items, per objective."""
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", *TWO_FEATURES])
    rows = li.withColumns({"binary": (F.col("l_returnflag") == "R").cast("double"), "regression": F.col("l_extendedprice") / 1000})
    fits = {o: newton_trees.fit_newton(rows, TWO_FEATURES, o, newton_trees.NewtonParams(
        objective=o, rounds=1, max_depth=2, learning_rate=0.3, reg_lambda=1.0, reg_alpha=0.5, max_bins=64))
        for o in ("binary", "regression")}
    return rows, fits


@register("newton_two_levels")
def newton_two_levels(spark, sf_dir):
    """Node tables of regularised second-order trees."""
    _, fits = _two_level_fits(spark, sf_dir)
    parts = [m.nodes(spark).withColumn("model", F.lit(o)) for o, m in fits.items()]
    nodes = parts[0].unionByName(parts[1])
    return nodes.select("model", "node", "feature", "threshold", r(F.when(F.col("feature").isNotNull(), F.col("gain")), 4).alias("gain"),
                        F.col("rows").alias("n"), r("value", 5).alias("value"))


@register("tree_contributions")
def tree_contributions(spark, sf_dir):
    """Exact contributions and interactions of the two-level trees for every line item."""
    rows, fits = _two_level_fits(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    parts = []
    for o, m in fits.items():
        cells = rows.select(*TWO_FEATURES).distinct().withColumn("cell", F.concat_ws("|", *TWO_FEATURES))
        phi = m.contributions(cells, ["cell", *TWO_FEATURES])
        both = m.interactions(cells, "cell").groupBy("cell").agg(
            F.max(F.when((F.col("feature_i") == TWO_FEATURES[0]) & (F.col("feature_j") == TWO_FEATURES[1]), F.col("value"))).alias("pair"),
            F.max(F.when((F.col("feature_i") == TWO_FEATURES[0]) & (F.col("feature_j") == TWO_FEATURES[0]), F.col("value"))).alias("own"))
        explained = phi.join(both, "cell").select(
            *TWO_FEATURES, r("c_l_quantity", 5).alias("c_quantity"), r("c_l_discount", 5).alias("c_discount"), r("bias", 5).alias("bias"),
            r(F.coalesce("pair", F.lit(0.0)), 5).alias("pair"), r(F.coalesce("own", F.lit(0.0)), 5).alias("own_quantity"))
        parts.append(rows.select(*keys, *TWO_FEATURES).join(explained, TWO_FEATURES).withColumn("model", F.lit(o)))
    return parts[0].unionByName(parts[1]).drop(*TWO_FEATURES)


@register("gbt_newton")
def gbt_newton(spark, sf_dir):
    """Boosted classifier of the delay label with all penalties and samples; every held-out row is scored."""
    train, test = _delay_split(spark, sf_dir)
    m = newton_trees.fit_newton(train, list(fixtures.FLIGHT_FEATURES), "ArrDelayBinary", newton_trees.NewtonParams(
        rounds=10, max_depth=5, learning_rate=0.15, reg_lambda=1.0, reg_alpha=0.1, gamma=0.01, subsample=0.8,
        colsample_bytree=0.8, colsample_bylevel=0.8, max_bins=64), id_col="flight_id")
    return m.transform(test, ["flight_id", "ArrDelayBinary"])


def _delay_newton(spark, sf_dir):
    train, test = sampling.train_test_split(delay_days_table(spark, sf_dir), "flight_id", 0.8, seed=0)
    m = newton_trees.fit_newton(train, list(fixtures.FLIGHT_FEATURES), "ArrDelay", newton_trees.NewtonParams(
        objective="regression", rounds=10, max_depth=4, learning_rate=0.3, max_bins=64))
    return m, test


@register("gbt_newton_regress")
def gbt_newton_regress(spark, sf_dir):
    m, test = _delay_newton(spark, sf_dir)
    return m.transform(test, ["flight_id", "ArrDelay"])


@register("tree_shap_exact")
def tree_shap_exact(spark, sf_dir):
    """Exact contributions of a boosted-tree delay model, with the constant, for every held-out row."""
    m, test = _delay_newton(spark, sf_dir)
    return m.contributions(test, ["flight_id"])


@register("tree_interactions_exact")
def tree_interactions_exact(spark, sf_dir):
    """Exact pairwise interactions of the same model, diagonal and constant included, for every held-out row."""
    m, test = _delay_newton(spark, sf_dir)
    return m.interactions(test, "flight_id")


from lodestar.plans import modelling  # noqa: E402, F401  more queries
