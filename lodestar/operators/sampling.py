"""Seeded sampling and splitting by a portable key hash.

Samples, splits and folds are pure filters/projections over
``portable_bucket(key, seed)``: they push below projections, need no extra
pass over the data, are reproducible on any engine with md5, and different
seeds are independent. ``df.sample``/``randomSplit`` remain available in
Spark but depend on partitioning, so they are not used here.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.hashing import portable_bucket
from lodestar.plans import scan

#: Samples and splits compare the whole 32-bit hash, so any fraction is met to one part in four thousand million.
MODULUS = 1 << 32


def _threshold(fraction: float, modulus: int = MODULUS) -> int:
    return int(math.floor(min(max(fraction, 0.0), 1.0) * modulus + 0.5))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int,
                modulus: int = MODULUS) -> DataFrame:
    """Keep rows whose bucket is below ``fraction`` (a pushed-down filter)."""
    return df.filter(portable_bucket(key, seed, modulus) < _threshold(fraction, modulus))


#: Rows up to which one task may merge the tasks' first rows.
TOP_ROWS = 100_000
#: Parts into which a range of hashes is cut when the n-th smallest is looked for; two rounds of it.
CUTS = 4096


def fixed_count_sample(df: DataFrame, key: str, n: int, seed: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: smallest 32-bit key hash first, key as tie-break.

    A small ``n`` is a distributed top-n. For a larger one, two counting passes over the keys (``CUTS`` counts each)
    narrow the n-th hash down to a millionth of the range: rows below it are a filter, and only the rows inside it are
    ranked.
    """
    ranked = df.withColumn("__h", portable_bucket(key, seed, 1 << 32))
    if n <= top_rows:
        return ranked.orderBy("__h", key).limit(n).drop("__h")
    low, width, left = 0, 1 << 32, n
    hashes = ranked.select("__h")
    for _ in range(2):
        width //= CUTS
        part = F.floor((F.col("__h") - low) / width)
        inside = hashes.where((F.col("__h") >= low) & (F.col("__h") < low + width * CUTS))
        counts = {r["p"]: r["c"] for r in inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
        for p in range(CUTS):
            if left <= counts.get(p, 0):
                break
            left -= counts.get(p, 0)
        else:
            return df  # fewer rows than asked for
        low += p * width
    rest = ranked.where((F.col("__h") >= low) & (F.col("__h") < low + width)).orderBy("__h", key).limit(left)
    return ranked.where(F.col("__h") < low).unionByName(rest).drop("__h")


def estimate_rows(sources: Mapping[str, DataFrame], key: str, fraction: float, seed: int) -> DataFrame:
    """Per-source row estimate count(sample)/fraction, plus a total row (source NULL).

    Divides by the share of hashes that the sample takes.
    """
    parts = [hash_sample(df.select(key), key, fraction, seed)
             .agg(F.count(F.lit(1)).alias("sampled")).withColumn("source", F.lit(name))
             for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    share = _threshold(fraction) / MODULUS
    est = F.col("sampled") / F.lit(share) if share else F.lit(0.0)
    per = out.select("source", "sampled", F.round(est).cast("bigint").alias("estimate"))
    total = per.agg(F.lit(None).cast("string").alias("source"), F.sum("sampled").alias("sampled"),
                    F.sum("estimate").alias("estimate"))
    return per.unionByName(total)


def estimate_rows_by(df: DataFrame, source: str, key: str, fraction: float, seed: int) -> DataFrame:
    """``estimate_rows`` for the values of a column, in one scan: source, sampled, estimate and a total (source NULL)."""
    share = _threshold(fraction) / MODULUS
    hit = (portable_bucket(key, seed, MODULUS) < _threshold(fraction)).cast("long")
    per = df.groupBy(F.col(source).alias("source")).agg(F.sum(hit).alias("sampled"))
    est = F.col("sampled") / F.lit(share) if share else F.lit(0.0)
    per = per.withColumn("estimate", F.round(est).cast("bigint"))
    total = per.agg(F.lit(None).cast("string").alias("source"), F.sum("sampled").alias("sampled"), F.sum("estimate").alias("estimate"))
    return per.unionByName(total)


def split_column(key: str, train_fraction: float, seed: int, modulus: int = MODULUS) -> Column:
    """'train' / 'test' label for each row."""
    return F.when(portable_bucket(key, seed, modulus) < _threshold(train_fraction, modulus),
                  F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, key: str, train_fraction: float = 0.8, seed: int = 0,
                     modulus: int = MODULUS) -> tuple[DataFrame, DataFrame]:
    b = portable_bucket(key, seed, modulus)
    t = _threshold(train_fraction, modulus)
    return df.filter(b < t), df.filter(b >= t)


def ordered_split(df: DataFrame, order_by: Sequence[str], test_fraction: float = 0.2,
                  out: str = "split") -> DataFrame:
    """Unshuffled split: the first ``n - ceil(test_fraction*n)`` rows by ``order_by`` are train.

    Only the ordering columns are scanned: their histogram (distinct tuples
    with counts) gets cumulative counts from the skew-safe scan, the tuple at
    the cut position is found with one aggregate, and the split itself is a
    comparison against that cut (a filter that does not move the rows).
    Rows whose ordering tuple equals the cut all go to train.
    """
    cols = list(order_by)
    hist = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    cum = scan.running_aggregate(hist, [], cols, {"__cum": ("sum", "__c")})
    n_train = F.col("__n") - F.ceil(F.col("__n") * F.lit(float(test_fraction)))
    total = hist.agg(F.sum("__c").alias("__n")).withColumn("__one", F.lit(1))
    key = F.struct(*[F.col(c) for c in cols])
    cut = (cum.withColumn("__one", F.lit(1)).join(F.broadcast(total), "__one")
              .filter(F.col("__cum") >= n_train)
              .agg(F.min(key).alias("__cut"), F.max(F.lit(1)).alias("__one"),
                   F.first(n_train <= 0, ignorenulls=True).alias("__empty")))
    j = df.withColumn("__one", F.lit(1)).join(F.broadcast(cut), "__one", "left")
    is_train = F.coalesce(~F.col("__empty"), F.lit(False)) & (key <= F.col("__cut"))
    return (j.withColumn(out, F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
             .drop("__one", "__cut", "__empty"))


def repeated_holdout(df: DataFrame, key: str, seeds: Sequence[int], train_fraction: float = 0.8,
                     modulus: int = MODULUS) -> DataFrame:
    """One fresh seeded split per seed ("repeated hold-out", not K-fold): adds seed, split."""
    t = _threshold(train_fraction, modulus)
    ex = df.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seeds])))
    return ex.withColumn("split", F.when(portable_bucket(key, F.col("seed"), modulus) < t, F.lit("train"))
                         .otherwise(F.lit("test")))


def kfold_column(key: str, k: int = 5, seed: int = 0) -> Column:
    """Fold id in [0, k) for true K-fold cross-validation (usable as ``foldCol``)."""
    return portable_bucket(key, seed, k).cast("int")


def interleaved_fold(key: str, k: int = 5) -> Column:
    """Fold by position modulo k (interleaved split; key stands for row position)."""
    return F.pmod(F.col(key), F.lit(k)).cast("int")


def train_infer_split(df: DataFrame, key: str, infer_fraction: float, seed: int = 0,
                      persist: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train/infer split with the fraction clamped to [0, 1]; 1.0 means infer == train == all."""
    f = min(max(float(infer_fraction), 0.0), 1.0)
    if f >= 1.0:
        train = infer = df
    else:
        train, infer = train_test_split(df, key, 1.0 - f, seed)
    if persist:
        train = train.persist()
        infer = infer if infer is train else infer.persist()
    return train, infer


def infer_subsample(df: DataFrame, key: str, infer_fraction: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train on all rows, infer on an overlapping hash sample of them."""
    return df, hash_sample(df, key, infer_fraction, seed)
