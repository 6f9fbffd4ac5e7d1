"""Column cleaning: names, keep-lists, casts, fills, null handling and row filters.

Every function is a pure projection/filter, so chains of them collapse into
one whole-stage-codegen span and filters on raw columns reach the scan.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_names(df: DataFrame) -> DataFrame:
    """strip() + lower() every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; keys that are not columns are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def keep_columns(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Drop every column not in the keep-list (keep-list order)."""
    cols = set(df.columns)
    return df.select(*[c for c in keep if c in cols])


def strings_to_timestamp(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Parse the named columns that are still strings into timestamp_ntz (bad text -> NULL)."""
    types = dict(df.dtypes)
    exprs = {c: F.try_to_timestamp(F.col(c)).cast("timestamp_ntz")
             for c in columns if types.get(c) == "string"}
    return df.withColumns(exprs) if exprs else df


def strings_to_float(df: DataFrame, skip: Iterable[str] = (), on_string: str = "cast",
                     null_text: str | None = "-1") -> DataFrame:
    """Treat remaining string columns as numbers.

    ``on_string='cast'``: NULL text becomes ``null_text`` (if given) and the
    column is cast to float32 (unparseable text -> NULL). ``'drop'`` removes
    string columns instead.
    """
    skip = set(skip)
    strs = [c for c in string_columns(df) if c not in skip]
    if on_string == "drop":
        return df.drop(*strs) if strs else df
    exprs = {}
    for c in strs:
        col = F.col(c) if null_text is None else F.coalesce(F.col(c), F.lit(null_text))
        exprs[c] = col.try_cast("float")
    return df.withColumns(exprs) if exprs else df


def downcast_numeric(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """int64 -> int32 and float64 -> float32; an integer that does not fit fails the query.

    Keys belong in ``skip``: they keep their 64 bits.
    """
    exprs = {}
    sk = set(skip)
    for f in df.schema.fields:
        if f.name in sk:
            continue
        if isinstance(f.dataType, T.LongType):
            exprs[f.name] = F.expr(f"CAST(`{f.name}` AS INT)")
        elif isinstance(f.dataType, T.DoubleType):
            exprs[f.name] = F.col(f.name).cast("float")
    return df.withColumns(exprs) if exprs else df


def fill_numeric(df: DataFrame, value: float = -1, skip: Iterable[str] = ()) -> DataFrame:
    """Fill NULL (and NaN) in numeric columns; timestamps and strings untouched."""
    exprs = {}
    sk = set(skip)
    for f in df.schema.fields:
        if f.name in sk:
            continue
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            exprs[f.name] = F.coalesce(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)),
                                       F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, NUMERIC_TYPES):
            exprs[f.name] = F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
    return df.withColumns(exprs) if exprs else df


def fill_all(df: DataFrame, value: float = 0) -> DataFrame:
    """Fill NULLs in every numeric column (whole-frame ``fillna``)."""
    return fill_numeric(df, value)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (or NaN in float columns)."""
    cols = list(subset) if subset else df.columns
    types = dict(df.dtypes)
    conds = []
    for c in cols:
        cond = F.col(c).isNotNull()
        if types[c] in ("float", "double"):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return df.filter(functools.reduce(operator.and_, conds)) if conds else df


def cast_all_float(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Cast every column (booleans, ints, numeric text) to float32."""
    ex = set(exclude)
    return df.select(*[F.col(c) if c in ex else F.col(c).try_cast("float").alias(c)
                       for c in df.columns])


def drop_string_columns(df: DataFrame) -> DataFrame:
    strs = string_columns(df)
    return df.drop(*strs) if strs else df


def select_label_first(df: DataFrame, label: str, inputs: Sequence[str]) -> DataFrame:
    """Reorder to [label] + inputs; a missing column becomes a NULL column."""
    cols = set(df.columns)
    return df.select(*[F.col(c) if c in cols else F.lit(None).cast("float").alias(c)
                       for c in [label, *inputs]])


def columns_difference(df: DataFrame, drop: Iterable[str]) -> list[str]:
    """Remaining column names, sorted alphabetically (index-difference semantics)."""
    d = set(drop)
    return sorted(c for c in df.columns if c not in d)


def add_threshold_label(df: DataFrame, source: str, label: str, threshold: float,
                        drop_source: bool = True) -> DataFrame:
    """label = 1 when source > threshold else 0 (NULL source -> 0); drop the leaking source."""
    if label in df.columns:
        out = df.withColumn(label, F.col(label).cast("int"))
    else:
        out = df.withColumn(label, F.coalesce((F.col(source) > F.lit(threshold)).cast("int"), F.lit(0)))
    return out.drop(source) if drop_source and source in out.columns else out


def range_filter(fragments: Iterable[str]) -> Column:
    """AND together SQL predicate fragments (e.g. ``'fare_amount > 0 and fare_amount < 500'``)."""
    return functools.reduce(operator.and_, [F.expr(f) for f in fragments])


def apply_range_filter(df: DataFrame, fragments: Iterable[str]) -> DataFrame:
    frags = list(fragments)
    return df.filter(range_filter(frags)) if frags else df


def filter_query(df: DataFrame, predicate: str | Column, extra: str | None = None) -> DataFrame:
    """Text or Column predicate, then an optional user predicate."""
    out = df.filter(predicate)
    return out.filter(extra) if extra else out


def clean_frame(df: DataFrame, keep: Sequence[str], rename: Mapping[str, str] | None = None,
                timestamp_cols: Sequence[str] = (), on_string: str = "cast",
                null_text: str | None = "-1", fill: float | None = -1,
                filters: Sequence[str] = (), filter_stage: str = "raw",
                id_cols: Sequence[str] = ()) -> DataFrame:
    """The standard cleaning chain: names, rename, keep-list, parse, cast, fill, filter.

    ``filter_stage='raw'`` applies the range filters right after renaming, on
    the source values, so they are pushed into the Parquet scan (casts in
    front of a predicate block pushdown), and again on the cleaned values, which
    decide: a value just inside an open range may be rounded onto its bound.
    ``'clean'`` filters the cleaned values only, as needed where the fill value is
    inside a range. ``id_cols`` keep their type and are never filled.
    """
    out = normalize_names(df)
    if rename:
        out = rename_columns(out, rename)
    out = keep_columns(out, keep)
    if filter_stage == "raw":
        out = apply_range_filter(out, filters)
    out = strings_to_timestamp(out, timestamp_cols)
    out = strings_to_float(out, skip=timestamp_cols, on_string=on_string, null_text=null_text)
    out = downcast_numeric(out, skip=id_cols)
    if fill is not None:
        out = fill_numeric(out, fill, skip=id_cols)
    return apply_range_filter(out, filters)
