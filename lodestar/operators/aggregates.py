"""Grouped statistics over result/timing tables: means, intervals, quartiles, ratios, curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.plans import scan

# Fixed value: two-sided 95% normal quantile.
Z95 = 1.96


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Row count as a one-row frame (a partial count per task; the scan reads no columns)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def grouped_mean(df: DataFrame, by: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(out))


def mean_std_count(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """mean, sample std and count per group (partial + final hash aggregate)."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                               F.count(F.col(value)).alias("n"))


def exact_mean(col: str, scale: int = 2):
    """Mean from an exact decimal sum of values with ``scale`` decimals (order-independent)."""
    return F.sum(F.col(col).cast(f"decimal(38,{scale})")).cast("double") / F.count(col)


def confidence_interval(df: DataFrame, by: Sequence[str], value: str, z: float = Z95,
                        scale: float = 1.0, exact_scale: int | None = None) -> DataFrame:
    """mean +/- z * std / sqrt(n) per group, after multiplying values by ``scale``.

    ``exact_scale``: the values have that many decimals; the mean is then taken
    from an exact decimal sum (reproducible to the last bit)."""
    v = F.col(value) * F.lit(scale)
    mean = exact_mean(value, exact_scale) * F.lit(scale) if exact_scale is not None else F.avg(v)
    g = df.groupBy(*by).agg(mean.alias("mean"), F.stddev_samp(v).alias("std"),
                            F.count(v).alias("n"))
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return g.withColumns({"ci": half, "ci_low": F.col("mean") - half, "ci_high": F.col("mean") + half})


def box_stats(df: DataFrame, by: Sequence[str], value: str, exact: bool = True,
              accuracy: int = 10000) -> DataFrame:
    """Quartiles, IQR, min and max per group.

    ``exact`` uses the skew-safe scan (sorted distinct values with running
    counts); otherwise ``percentile_approx`` with bounded memory per group.
    """
    if exact:
        q = scan.exact_quantiles(df, by, value, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    else:
        pa = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
        q = df.groupBy(*by).agg(pa.alias("__q")).select(
            *by, F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"), F.col("__q")[2].alias("q3"))
    # NaN counts as missing, as for the quartiles
    df = df.withColumn(value, F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
    mm = df.groupBy(*by).agg(F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
                             F.count(F.col(value)).alias("n"))
    j = q.join(mm, on=list(by)) if by else q.withColumn("__one", F.lit(1)).join(
        F.broadcast(mm.withColumn("__one", F.lit(1))), "__one").drop("__one")
    return j.withColumn("iqr", F.col("q3") - F.col("q1"))


def throughput(df: DataFrame, by: str, elapsed: str, baseline: str, rows: str | None = None,
               divisor: float = 1.0) -> DataFrame:
    """rows per second per group and speed-up relative to the ``baseline`` group.

    Elapsed times are summed (exactly, for decimal input), converted to double
    and divided by ``divisor`` (e.g. 1000 for milliseconds); no time or a missing
    baseline gives NULL rates. The baseline
    rate is a one-row aggregate joined back by broadcast, so no task ever
    holds the whole grouped table, however many groups there are.
    """
    n = F.sum(F.col(rows)) if rows else F.count(F.lit(1))
    g = df.groupBy(by).agg(n.alias("rows"),
                           (F.sum(elapsed).cast("double") / F.lit(float(divisor))).alias("elapsed"))
    g = g.withColumn("rows_per_s", F.try_divide("rows", "elapsed"))
    base = (g.agg(F.max(F.when(F.col(by) == F.lit(baseline), F.col("rows_per_s"))).alias("__base"))
             .withColumn("__one", F.lit(1)))
    out = g.withColumn("__one", F.lit(1)).join(F.broadcast(base), "__one")
    return out.withColumn("speedup", F.try_divide("rows_per_s", "__base")).drop("__one", "__base")


def best_so_far(df: DataFrame, run: str, order: Sequence[str], metric: str, mode: str = "max",
                step: str = "step", out: str = "best") -> DataFrame:
    """Step number and cumulative best metric per run, via the skew-safe scan."""
    op = "max" if mode == "max" else "min"
    return scan.running_aggregate(df, [run], list(order), {step: ("count", None), out: (op, metric)})


def replicate_band(df: DataFrame, step: str, value: str, exact_scale: int | None = None) -> DataFrame:
    """Per step: mean, std, max, min across replicate runs and the clipped mean+/-std band."""
    mean = exact_mean(value, exact_scale) if exact_scale is not None else F.avg(value)
    g = df.groupBy(step).agg(mean.alias("mean"), F.stddev_samp(value).alias("std"),
                             F.max(value).alias("max"), F.min(value).alias("min"))
    return g.withColumns({
        "upper": F.least(F.col("mean") + F.col("std"), F.col("max")),
        "lower": F.greatest(F.col("mean") - F.col("std"), F.col("min")),
    })


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
