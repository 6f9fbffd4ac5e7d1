"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_percent(num: Column | str, den: Column | str) -> Column:
    """100 * num / den; NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double")) * F.lit(100.0)


def threshold_label(x: Column | str, threshold: float, null_as: int = 0) -> Column:
    """1 when x > threshold (strict), else 0; NULL input maps to ``null_as``."""
    return F.coalesce((_c(x) > F.lit(threshold)).cast("int"), F.lit(null_as))
