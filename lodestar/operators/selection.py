"""Chi-square feature scoring and K-best selection (one grouped pass over the data)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chi2_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Chi-square statistic of each non-negative feature against a class label.

    observed[c, j] = sum of feature j over rows of class c;
    expected[c, j] = P(c) * sum of feature j over all rows;
    chi2_j = sum_c (observed - expected)^2 / expected.
    The only pass over the data is one ``groupBy(label)`` with partial
    aggregation; everything after it is on (#classes x #features) rows.
    Output: feature, chi2 (NULL for a feature that is zero throughout), rank (1 = highest score).
    A negative value fails the query.
    """
    feats = list(features)

    def counted(f: str):
        c = F.col(f)
        return F.when(c < 0, F.raise_error(F.lit(f"chi-square of a negative value in {f}")).cast("double")).otherwise(c)
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"),
                                      *[F.sum(counted(f)).cast("double").alias(f) for f in feats])
    long = per_class.unpivot([label, "__n"], feats, "feature", "observed")
    feat = Window.partitionBy("feature")
    long = long.withColumns({
        "__p": F.col("__n") / F.sum("__n").over(Window.partitionBy("feature")),
        "__tot": F.sum("observed").over(feat),
    })
    long = long.withColumn("__exp", F.col("__p") * F.col("__tot"))
    term = F.try_divide(F.pow(F.col("observed") - F.col("__exp"), 2), F.col("__exp"))
    scores = long.groupBy("feature").agg(F.sum(term).alias("chi2"))
    # Ranking window over #features rows only; features without a score come last.
    rank = Window.orderBy(F.desc_nulls_last("chi2"), F.asc("feature"))
    return scores.withColumn("rank", F.row_number().over(rank))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int) -> list[str]:
    """Names of the k best features (a #features-row result comes to the driver)."""
    rows = chi2_scores(df, features, label).filter(F.col("rank") <= k).orderBy("rank").collect()
    return [r["feature"] for r in rows]
