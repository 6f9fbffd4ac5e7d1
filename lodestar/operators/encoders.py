"""Categorical encoders: dictionary codes, train-fitted label encoding, out-of-fold target encoding.

Dictionaries are DataFrames (never collected). Joining a dictionary back to
the rows is an equi-join that AQE turns into a broadcast join when the
dictionary is small at runtime; a large, skewed one stays a sort-merge join
whose hot keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.plans import scan
from lodestar.session import ensure_checkpoint_dir


#: Values up to which one task numbers a dictionary; larger ones are numbered in range partitions.
SMALL_DICTIONARY = 100_000


def fit_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values with codes 0..n-1 in value order."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    if distinct.limit(SMALL_DICTIONARY + 1).count() <= SMALL_DICTIONARY:  # counted, not estimated
        place = F.row_number().over(Window.orderBy(column))
        return distinct.select(column, (place - 1).cast("int").alias(f"{column}__code"))
    numbered = scan.row_number(distinct, [], [column], out="__pos")
    return numbered.select(column, (F.col("__pos") - 1).cast("int").alias(f"{column}__code"))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, column: str, out: str,
                     unseen: str = "separate", null_code: int = -1) -> DataFrame:
    """Replace ``column`` codes: NULL -> ``null_code``; unseen -> n (``separate``) or 0 (``compat``)."""
    code = f"{column}__code"
    j = df.join(dictionary, on=column, how="left")
    if unseen == "compat":
        fill = F.lit(0)
    else:
        size = dictionary.agg(F.count(F.lit(1)).cast("int").alias("__dict_n")).withColumn("__one", F.lit(1))
        j = j.withColumn("__one", F.lit(1)).join(F.broadcast(size), "__one").drop("__one")
        fill = F.col("__dict_n")
    res = F.when(F.col(column).isNull(), F.lit(null_code)).otherwise(F.coalesce(F.col(code), fill))
    j = j.withColumn(out, res.cast("int")).drop(code)
    return j.drop("__dict_n") if "__dict_n" in j.columns else j


def category_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """String columns -> integer codes in dictionary (sorted) order; NULL -> -1."""
    out = df
    for c in columns:
        out = apply_dictionary(out, fit_dictionary(df, c), c, f"{c}{suffix}")
    return out


class LabelEncoder:
    """Fit dictionaries on one frame (train), apply them to others (test)."""

    def __init__(self, columns: Sequence[str], unseen: str = "separate", suffix: str = "_code"):
        self.columns = list(columns)
        self.unseen = unseen
        self.suffix = suffix
        self.dictionaries: dict[str, DataFrame] = {}

    def fit(self, df: DataFrame) -> "LabelEncoder":
        self.dictionaries = {c: fit_dictionary(df, c) for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.columns:
            out = apply_dictionary(out, self.dictionaries[c], c, f"{c}{self.suffix}", unseen=self.unseen)
        return out


def _kept(stats: DataFrame) -> tuple[DataFrame, bool]:
    """Sums by category, written once, and whether they are few enough to be sent to every task.

    Counted, not estimated: a join on a handful of categories would otherwise deal all rows to a handful of tasks.
    """
    ensure_checkpoint_dir(stats.sparkSession)
    kept = stats.checkpoint()
    return kept, kept.count() <= SMALL_DICTIONARY


def target_encode_oof(df: DataFrame, category: str, target: str, fold: str,
                      smooth: float = 0.001, out: str | None = None) -> DataFrame:
    """Out-of-fold target encoding for training rows.

    A row in fold f gets (S_c - S_cf + smooth*mu) / (N_c - N_cf + smooth): the
    category's target sum/count over the *other* folds, shrunk toward the
    global mean mu. Two small aggregates (category x fold, category) and a
    one-row mean are joined back; no per-row Python.
    """
    out = out or f"{category}_te"
    per_cf = df.groupBy(category, fold).agg(F.sum(F.col(target).cast("double")).alias("__s_cf"),
                                            F.count(F.col(target)).alias("__n_cf"))
    per_cf, few = _kept(per_cf)
    per_c = per_cf.groupBy(category).agg(F.sum("__s_cf").alias("__s_c"), F.sum("__n_cf").alias("__n_c"))
    mean = df.agg(F.avg(F.col(target).cast("double")).alias("__mu")).withColumn("__one", F.lit(1))
    stats = per_cf.join(per_c, on=category)
    j = (df.join(F.broadcast(stats) if few else stats, on=[category, fold], how="left")
           .withColumn("__one", F.lit(1)).join(F.broadcast(mean), "__one"))
    num = F.col("__s_c") - F.col("__s_cf") + F.lit(smooth) * F.col("__mu")
    den = (F.col("__n_c") - F.col("__n_cf")).cast("double") + F.lit(smooth)
    enc = F.when(F.col("__n_c").isNull(), F.col("__mu")).otherwise(F.coalesce(F.try_divide(num, den), F.col("__mu")))
    return j.withColumn(out, enc).drop("__s_cf", "__n_cf", "__s_c", "__n_c", "__mu", "__one")


def target_encode_apply(train: DataFrame, df: DataFrame, category: str, target: str,
                        smooth: float = 0.001, out: str | None = None) -> DataFrame:
    """Encode new rows with all training statistics; unseen categories get the mean."""
    out = out or f"{category}_te"
    per_c = train.groupBy(category).agg(F.sum(F.col(target).cast("double")).alias("__s_c"),
                                        F.count(F.col(target)).alias("__n_c"))
    per_c, few = _kept(per_c)
    mean = train.agg(F.avg(F.col(target).cast("double")).alias("__mu")).withColumn("__one", F.lit(1))
    j = (df.join(F.broadcast(per_c) if few else per_c, on=category, how="left")
           .withColumn("__one", F.lit(1)).join(F.broadcast(mean), "__one"))
    enc = F.when(F.col("__n_c").isNull(), F.col("__mu")).otherwise(
        (F.col("__s_c") + F.lit(smooth) * F.col("__mu")) / (F.col("__n_c").cast("double") + F.lit(smooth)))
    return j.withColumn(out, enc).drop("__s_c", "__n_c", "__mu", "__one")
