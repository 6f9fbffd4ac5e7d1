"""Sinks: cleaned-table cache, CSV export, append/overwrite result tables, split artefacts."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether ``write_once`` finished the table at ``path``: its mark, a table of one row beside it, is there."""
    try:
        return spark.read.schema("done boolean").parquet(f"{path}.done").count() > 0
    except AnalysisException:  # no such path
        return False


def write_once(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` unless a finished copy made from the same input files is there; returns the table's folder.

    The folder's name ends in a key of the inputs, so changed inputs are written anew, and so is a folder that a
    killed job left without its mark.
    """
    spark = df.sparkSession
    place = f"{path.rstrip('/')}-{input_key(df)}"
    if not is_complete(spark, place):
        df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(place)
        spark.createDataFrame([(True,)], "done boolean").coalesce(1).write.mode("overwrite").parquet(f"{place}.done")
    return place


def input_key(df: DataFrame) -> str:
    """A key of the input files' names, sizes and times and of the schema: it changes when they do."""
    files = sorted(df.inputFiles())
    spark = df.sparkSession
    seen = []
    if files:
        found = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        seen = sorted((r.path, r.length, str(r.modificationTime)) for r in found.collect())  # one row per file
    return hashlib.sha1(repr((seen, df.schema.simpleString())).encode()).hexdigest()[:16]


def write_orc_once(df: DataFrame, path: str) -> DataFrame:
    """Prepare-once cache as ORC (see ``write_once``)."""
    return df.sparkSession.read.orc(write_once(df, path, "orc"))


def write_csv_columns(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                      mode: str = "overwrite") -> None:
    out = df.select(*columns) if columns else df
    out.write.mode(mode).option("header", True).csv(path)


def write_result_table(df: DataFrame, path: str, append_to_existing: bool = True,
                       fmt: str = "parquet") -> DataFrame:
    """Append records to (or replace) a result table; returns the table as stored."""
    df.write.mode("append" if append_to_existing else "overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_split(df: DataFrame, path: str, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Persist a split (e.g. held-out rows for later explanation) as Parquet."""
    out = df
    if key_cols:
        out = df.select(*key_cols, *[c for c in df.columns if c not in key_cols])
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

