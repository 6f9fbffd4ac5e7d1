"""Search-trial analytics over an append-only trial/step log.

A trial log has one row per (trial, step) with a metric. Everything here is
a grouped aggregate or a skew-safe scan over that table; decisions that look
at "the other trials at the same step" are computed from per-step order
statistics rather than by pairing trials with each other.
"""

from __future__ import annotations

import bisect
import itertools
import math
import random
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.hashing import portable_bucket
from lodestar.operators.aggregates import mean_std_count
from lodestar.plans import scan


def trial_log(df: DataFrame, trial: str, order: Sequence[str], metric: str,
              step: str = "step") -> DataFrame:
    """Number each trial's rows 1..n by ``order`` (skew-safe) -> (trial, step, metric, ...)."""
    return scan.row_number(df, [trial], list(order), out=step)


def trial_log_running_mean(df: DataFrame, trial: str, order: Sequence[str], metric: str, step: str = "step",
                           out: str = "running_mean", digits: int = 9) -> DataFrame:
    """``trial_log`` and ``running_mean`` in one skew-safe scan: the step number and the running
    sums share the trial key and the total order, so one range-partitioned pass yields both."""
    r = scan.running_aggregate(df, [trial], list(order), {step: ("count", None), "__s": ("sum", metric),
                                                           "__k": ("count", metric)})
    return r.withColumn(out, F.round(F.col("__s") / F.col("__k"), digits)).drop("__s", "__k")


def trial_summary(log: DataFrame, trial: str, step: str | Sequence[str], metric: str, mode: str = "max",
                  complete_at: int | None = None, ts: str | None = None,
                  exact_scale: int | None = None) -> DataFrame:
    """Per-trial result row: steps, best/last/mean metric, non-finite flag, state, in one aggregation.

    ``step`` is the column or columns that order a trial's reports.
    """
    order = F.col(step) if isinstance(step, str) else F.struct(*step)
    best = F.max(metric) if mode == "max" else F.min(metric)
    mean = (F.sum(F.col(metric).cast(f"decimal(38,{exact_scale})")).cast("double") / F.count(metric)
            if exact_scale is not None else F.avg(metric))
    aggs = [F.count(F.lit(1)).alias("n_steps"), best.alias("best"),
            F.max_by(F.col(metric), order).alias("last"), mean.alias("mean"),
            F.max((F.isnan(F.col(metric)) | (F.abs(F.col(metric)) == F.lit(float("inf")))).cast("int"))
             .alias("is_bad")]
    if ts:
        aggs += [F.min(ts).alias("start"), F.max(ts).alias("complete")]
    out = log.groupBy(trial).agg(*aggs)
    if complete_at is not None:
        out = out.withColumn("state", F.when(F.col("is_bad") == 1, F.lit("failed"))
                             .when(F.col("n_steps") >= complete_at, F.lit("complete"))
                             .otherwise(F.lit("running")))
    return out


def nonfinite_rows(df: DataFrame, score: str) -> DataFrame:
    """Rows whose score is NaN or +/-inf (a bad trial ends there)."""
    s = F.col(score)
    return df.filter(F.isnan(s) | (F.abs(s) == F.lit(float("inf"))))


def best_trial(scores: DataFrame, trial: str, score: str, mode: str = "max") -> DataFrame:
    """The single best trial; ties go to the lowest trial id (first wins)."""
    order = F.desc(score) if mode == "max" else F.asc(score)
    return scores.orderBy(order, F.asc(trial)).limit(1)


def running_mean(log: DataFrame, trial: str, step: str, metric: str, out: str = "running_mean",
                 digits: int = 9) -> DataFrame:
    r = scan.running_aggregate(log, [trial], [step], {"__s": ("sum", metric), "__k": ("count", metric)})
    return r.withColumn(out, F.round(F.col("__s") / F.col("__k"), digits)).drop("__s", "__k")


def median_stopping(log: DataFrame, trial: str, step: str, metric: str, grace_period: int = 1,
                    min_samples: int = 3, mode: str = "max", checkpoint: bool = True,
                    running: str | None = None) -> DataFrame:
    """Median stopping rule on running means.

    At (trial, step) the trial stops when step > grace_period, at least
    ``min_samples`` other trials reached that step, and its running mean is
    worse than the median of the other trials' running means there. The
    median of the *others* is derived from the three middle order statistics
    of the step (positions from the skew-safe scan), so no pairs are built.
    ``running`` names a running-mean column the log already carries (from
    ``trial_log_running_mean``); otherwise it is computed here.
    Output: trial, n_steps, stop_step (NULL = never stopped).
    """
    rm = (log.withColumnRenamed(running, "__rm") if running
          else running_mean(log, trial, step, metric, out="__rm"))
    # Read three times below (counts, middle values, decisions): keep it once.
    ranked = scan.row_number(rm, [step], ["__rm", trial], out="__r").persist()
    counts = ranked.groupBy(step).agg(F.count(F.lit(1)).alias("__m"))
    ranked_m = ranked.join(counts, on=step)
    h = F.floor((F.col("__m") - 1) / 2)
    pos = F.col("__r") - 1
    mids = ranked_m.groupBy(step).agg(
        F.max(F.when(pos == h - 1, F.col("__rm"))).alias("__vm1"),
        F.max(F.when(pos == h, F.col("__rm"))).alias("__v0"),
        F.max(F.when(pos == h + 1, F.col("__rm"))).alias("__vp1"))
    j = ranked_m.join(mids, on=step)
    oth_h = F.when(h < pos, F.col("__v0")).otherwise(F.col("__vp1"))
    oth_hm1 = F.when(h - 1 < pos, F.col("__vm1")).otherwise(F.col("__v0"))
    med = F.when(F.col("__m") % 2 == 0, oth_h).otherwise((oth_hm1 + oth_h) / F.lit(2.0))
    worse = F.col("__rm") < med if mode == "max" else F.col("__rm") > med
    stop = (F.col(step) > F.lit(grace_period)) & ((F.col("__m") - 1) >= F.lit(min_samples)) & worse
    out = j.withColumn("__stop", stop).groupBy(trial).agg(
        F.max(step).alias("n_steps"), F.min(F.when(F.col("__stop"), F.col(step))).alias("stop_step"))
    if not checkpoint:
        return out
    # The decision table has one row per trial: materialise it and release the cache.
    out = out.checkpoint(eager=True)
    ranked.unpersist()
    return out


def halving_rungs(max_t: int, grace_period: int = 1, reduction: int = 3) -> list[int]:
    rungs, r = [], grace_period
    while r <= max_t:
        rungs.append(r)
        r *= reduction
    return rungs


def successive_halving(log: DataFrame, trial: str, step: str, metric: str, max_t: int = 50,
                       grace_period: int = 1, reduction: int = 3, mode: str = "max",
                       checkpoint: bool = True, running: str | None = None) -> DataFrame:
    """Synchronous successive halving on running means.

    At each rung r (grace * reduction^i <= max_t) the surviving trials that
    reached step r are ranked by running mean; the top floor(n / reduction)
    are promoted. Survivor sets (one row per trial) are checkpointed between
    rungs to keep the lineage short. Output: rung, trial, metric, rank, promoted.
    """
    rungs = halving_rungs(max_t, grace_period, reduction)
    rm = (log.withColumnRenamed(running, "__rm") if running  # precomputed running mean
          else running_mean(log, trial, step, metric, out="__rm"))
    # One row per (trial, rung step): computed once, then every rung reads it.
    rung_rows = rm.filter(F.col(step).isin(rungs)).select(trial, step, F.col("__rm").alias("metric"))
    if checkpoint:
        rung_rows = rung_rows.checkpoint(eager=True)
    survivors = None
    outs = []
    for rung in rungs:
        cands = rung_rows.filter(F.col(step) == rung).select(trial, "metric")
        if survivors is not None:
            cands = cands.join(survivors, on=trial, how="left_semi")
        key = F.col("metric") if mode != "max" else -F.col("metric")
        ranked = scan.row_number(cands.withColumn("__key", key), [], ["__key", trial], out="rank")
        n = cands.agg(F.count(F.lit(1)).alias("__n")).withColumn("__one", F.lit(1))
        ranked = (ranked.withColumn("__one", F.lit(1)).join(F.broadcast(n), "__one")
                  .withColumn("promoted", F.col("rank") <= F.floor(F.col("__n") / F.lit(reduction)))
                  .select(F.lit(rung).alias("rung"), trial, "metric", "rank", "promoted"))
        if checkpoint:
            ranked = ranked.checkpoint(eager=True)
        outs.append(ranked)
        survivors = ranked.filter("promoted").select(trial)
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _bracket_decisions(pdf: pd.DataFrame, reduction: int, mode: str) -> pd.DataFrame:
    """One bracket's reports in the order of arrival: each is held against those that its rung has seen so far."""
    sign = 1.0 if mode == "max" else -1.0
    seen: dict[int, list[float]] = {}
    stopped: set = set()
    out = []
    for trial, rung, value in pdf.sort_values(["arrival", "trial", "rung"])[["trial", "rung", "value"]].itertuples(index=False):
        if trial in stopped or not math.isfinite(value):
            continue
        earlier = seen.setdefault(rung, [])
        cutoff = None
        if earlier:  # linear interpolation between the neighbouring order statistics
            place = (1 - 1 / reduction) * (len(earlier) - 1)
            low = math.floor(place)
            high = min(low + 1, len(earlier) - 1)
            cutoff = earlier[low] + (place - low) * (earlier[high] - earlier[low])
        stop = cutoff is not None and sign * value < cutoff
        out.append((pdf["bracket"].iloc[0], rung, trial, value, None if cutoff is None else sign * cutoff, bool(stop)))
        bisect.insort(earlier, sign * value)
        if stop:
            stopped.add(trial)
    return pd.DataFrame(out, columns=["bracket", "rung", "trial", "metric", "cutoff", "stopped"])


def async_halving(reports: DataFrame, trial: str, step: str, metric: str, arrival: str, bracket: str, brackets: int = 3,
                  max_t: int = 50, grace_period: int = 1, reduction: int = 3, mode: str = "max") -> DataFrame:
    """Asynchronous successive halving with several brackets.

    Bracket s has rungs at ``grace_period * reduction**(s + k)`` steps, up to ``max_t``. A trial that reaches a rung is
    held against the reports that had arrived there before its own: below their (1 - 1/reduction) quantile it stops, and
    its later reports count nowhere. Nobody waits, so a decision depends on the order of arrival. A bracket's reports at
    rungs (a number per trial and rung, not its log) are taken one after the other by one task; non-finite ones count
    nowhere. Output: bracket, rung, trial, metric, cutoff (null for a rung's first report), stopped.
    """
    rungs = F.array(*(F.array(*(F.lit(r).cast("long") for r in halving_rungs(max_t, grace_period * reduction**s, reduction)))
                      for s in range(brackets)))
    rows = reports.select(F.col(bracket).cast("int").alias("bracket"), F.col(trial).alias("trial"), F.col(step).cast("long").alias("rung"),
                          F.col(metric).cast("double").alias("value"), F.col(arrival).alias("arrival"))
    at_rung = rows.where(F.col("bracket").between(0, brackets - 1) & F.array_contains(F.get(rungs, F.col("bracket")), F.col("rung")))
    schema = T.StructType([T.StructField("bracket", T.IntegerType()), T.StructField("rung", T.LongType()),
                           T.StructField("trial", reports.schema[trial].dataType), T.StructField("metric", T.DoubleType()),
                           T.StructField("cutoff", T.DoubleType()), T.StructField("stopped", T.BooleanType())])
    return at_rung.groupBy("bracket").applyInPandas(lambda pdf: _bracket_decisions(pdf, reduction, mode), schema)


def slice_table(scores: DataFrame, trial: str, params: Sequence[str], score: str) -> DataFrame:
    """One row per trial and parameter: (trial, param, level, score), the table behind slice plots."""
    pairs = F.explode(F.array(*(F.struct(F.lit(p).alias("param"), F.col(p).cast("double").alias("level")) for p in params)))
    return scores.select(trial, score, pairs.alias("p")).select(trial, "p.param", "p.level", score)


def parallel_table(scores: DataFrame, trial: str, params: Sequence[str], score: str) -> DataFrame:
    """Each trial's parameters and score, scaled to 0..1 by their least and largest value (0.5 where these are equal)."""
    columns = [*params, score]
    bounds = scores.agg(*(F.min(c).cast("double").alias(f"__low_{c}") for c in columns),
                        *(F.max(c).cast("double").alias(f"__high_{c}") for c in columns)).withColumn("__one", F.lit(1))
    rows = scores.withColumn("__one", F.lit(1)).join(F.broadcast(bounds), "__one")  # one row
    place = {c: F.coalesce(F.try_divide(F.col(c).cast("double") - F.col(f"__low_{c}"), F.col(f"__high_{c}") - F.col(f"__low_{c}")),
                           F.lit(0.5)) for c in columns}
    return rows.select(trial, *(place[c].alias(c) for c in columns))


def marginal_stats(scores: DataFrame, params: Sequence[str], score: str) -> DataFrame:
    """Mean, sample deviation and number of scores for each level of each parameter, in one aggregation."""
    pairs = F.explode(F.array(*(F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("level")) for p in params)))
    return mean_std_count(scores.select(score, pairs.alias("p")).select("p.param", "p.level", score), ["param", "level"], score)


def param_importance(scores: DataFrame, params: Sequence[str], score: str) -> DataFrame:
    """Share of score variance explained by each (binned) parameter: eta^2 = SS_between / SS_total."""
    long = scores.select(score, F.explode(F.array(*[
        F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("level")) for p in params]))
        .alias("__pv")).select(score, "__pv.param", "__pv.level")
    groups = long.groupBy("param", "level").agg(F.count(F.lit(1)).alias("__n"), F.avg(score).alias("__m"))
    tot = scores.agg(F.avg(score).alias("__mu"), F.var_pop(score).alias("__var"),
                     F.count(F.lit(1)).alias("__rows")).withColumn("__one", F.lit(1))
    j = groups.withColumn("__one", F.lit(1)).join(F.broadcast(tot), "__one")
    between = F.sum(F.col("__n") * F.pow(F.col("__m") - F.col("__mu"), 2))
    out = j.groupBy("param").agg(F.try_divide(between, F.first("__rows") * F.first("__var")).alias("eta_sq"))
    from pyspark.sql import Window
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("eta_sq"), F.asc("param"))))


def scaling_fractions(workers: Sequence[int], max_fraction: float = 1.0) -> list[tuple[str, int, float]]:
    """(scaling_type, n_workers, fraction): weak scales data with workers, strong keeps it fixed."""
    denom = max(workers)
    out = []
    for n in workers:
        out.append(("weak", n, n / denom * max_fraction))
        out.append(("strong", n, max_fraction))
    return out


def scaling_sweep(df: DataFrame, key: str, workers: Sequence[int], max_fraction: float = 1.0,
                  seed: int = 11) -> DataFrame:
    """Rows selected by each sweep configuration, counted in ONE pass (conditional sums)."""
    configs = scaling_fractions(workers, max_fraction)
    b = portable_bucket(key, seed, 1 << 32)
    aggs = [F.sum(F.when(b < F.lit(int(math.floor(f * 2**32 + 0.5))), 1).otherwise(0)).alias(f"c{i}")
            for i, (_, _, f) in enumerate(configs)]
    counts = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("scaling_type"), F.lit(n).alias("n_workers"),
                                        F.lit(float(f)).alias("fraction"), F.col(f"c{i}").alias("rows"))
                               for i, (t, n, f) in enumerate(configs)]))
    out = counts.select(rows.alias("__r")).select("__r.*")
    return out.withColumn("rows_per_worker", F.col("rows") / F.col("n_workers"))


# ----------------------------------------------------------------- search spaces / candidates
class SearchSpace:
    """Declared search space -> candidate table (one row per trial).

    Dimensions: ``("int", lo, hi)``, ``("uniform", lo, hi)``,
    ``("loguniform", lo, hi)``, ``("quniform", lo, hi, q)``, ``("choice", [..])``.
    """

    def __init__(self, dims: Mapping[str, tuple]):
        self.dims = dict(dims)

    def _draw(self, rng: random.Random, spec: tuple):
        kind = spec[0]
        if kind == "int":
            return rng.randint(int(spec[1]), int(spec[2]))
        if kind == "uniform":
            return rng.uniform(spec[1], spec[2])
        if kind == "loguniform":
            return math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        if kind == "quniform":
            return round(rng.uniform(spec[1], spec[2]) / spec[3]) * spec[3]
        if kind == "choice":
            return rng.choice(list(spec[1]))
        raise ValueError(kind)

    def random(self, n: int, seed: int = 0) -> list[dict]:
        rng = random.Random(seed)
        return [{k: self._draw(rng, v) for k, v in self.dims.items()} for _ in range(n)]

    def grid(self) -> list[dict]:
        axes = []
        for k, v in self.dims.items():
            if v[0] != "choice":
                raise ValueError("grid needs choice dimensions")
            axes.append([(k, x) for x in v[1]])
        return [dict(c) for c in itertools.product(*axes)]

    def to_frame(self, spark: SparkSession, candidates: list[dict]) -> DataFrame:
        names = list(self.dims)
        fields = [T.StructField("trial_id", T.IntegerType(), False)]
        for k in names:
            sample = candidates[0][k] if candidates else 0
            dt = T.StringType() if isinstance(sample, str) else T.DoubleType()
            fields.append(T.StructField(k, dt, True))
        rows = [(i, *[c[k] if isinstance(c[k], str) else float(c[k]) for k in names])
                for i, c in enumerate(candidates)]
        return spark.createDataFrame(rows, T.StructType(fields))
