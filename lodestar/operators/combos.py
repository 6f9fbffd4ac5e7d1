"""Pairwise arithmetic feature generation (one projection over all column pairs)."""

from __future__ import annotations

import itertools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Arithmetic operators and their output-name suffixes.
OPERATORS = {"+": ("_plus", operator.add), "-": ("_minus", operator.sub),
             "*": ("_times", operator.mul), "/": ("_div", None)}


def pairwise_name(a: str, b: str, op: str = "+") -> str:
    return f"{a}_{b}{OPERATORS[op][0]}"


def pairwise_features(df: DataFrame, columns: Sequence[str], op: str = "+", r: int = 2,
                      keep_original: bool = True) -> DataFrame:
    """Every unordered combination of ``r`` columns combined with ``op``.

    The widening is quadratic, so it is a single ``select`` (one codegen stage);
    callers that only need scores should compute them in the same pass.
    """
    suffix, fn = OPERATORS[op]
    new = []
    for combo in itertools.combinations(columns, r):
        cols = [F.col(c) for c in combo]
        acc = cols[0]
        for c in cols[1:]:
            acc = F.try_divide(acc, c) if op == "/" else fn(acc, c)
        new.append(acc.alias("_".join(combo) + suffix))
    base = [F.col(c) for c in df.columns] if keep_original else []
    return df.select(*base, *new)


def numeric_feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    ex = set(exclude)
    num = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [c for c, t in df.dtypes if (t in num or t.startswith("decimal")) and c not in ex]
