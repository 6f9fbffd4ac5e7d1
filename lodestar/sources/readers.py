"""Readers: Parquet/CSV/ORC scans with projection, format detection, partition pruning.

All readers are lazy: they build a scan node and let Catalyst push column
selection and predicates into it. Nothing here lists or reads data rows on
the driver; listing files uses the Hadoop file system API (metadata only).
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.sources.spec import DatasetSpec


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; a column list becomes the scan's ReadSchema."""
    df = spark.read.parquet(*_paths(paths))
    return df.select(*columns) if columns else df


def read_orc(spark: SparkSession, paths: str | Sequence[str],
             columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.orc(*_paths(paths))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
             header: bool = True, sep: str = ",", columns: Sequence[str] | None = None) -> DataFrame:
    """CSV scan with an explicit schema (never inferred).

    With ``header=True`` the first line of each file is skipped and the
    schema's names are imposed by position (the file's own header names are
    ignored), which is how named reads of headered files behave.
    """
    reader = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("enforceSchema", True).option("mode", "PERMISSIVE"))
    df = reader.csv(_paths(paths))
    return df.select(*columns) if columns else df


def _list_files(spark: SparkSession, directory: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(hconf)
    if not fs.exists(path):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(path)]


def detect_format(spark: SparkSession, directory: str) -> tuple[str, list[str]]:
    """Pick the reader for a directory: CSV files win over Parquet; neither is an error."""
    files = _list_files(spark, directory)
    csv = sorted(f for f in files if f.endswith(".csv"))
    if csv:
        return "csv", csv
    parquet = sorted(f for f in files if f.endswith(".parquet"))
    if parquet:
        return "parquet", parquet
    raise FileNotFoundError(f"no .csv or .parquet input found in {directory}")


def read_detected(spark: SparkSession, directory: str, spec: DatasetSpec) -> DataFrame:
    fmt, files = detect_format(spark, directory)
    if fmt == "csv":
        return read_csv(spark, files, spec.columns, header=True)
    return read_parquet(spark, files, spec.names)


# Fixed value: candidate delimiters tried when sniffing a delimited text file.
CANDIDATE_DELIMITERS = (",", "\t", ";", "|", " ")


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """Choose the delimiter from the first line only (one tiny read)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return ","
    line = first[0][0] or ""
    counts = [(line.count(d), -i, d) for i, d in enumerate(CANDIDATE_DELIMITERS)]
    best = max(counts)
    return best[2] if best[0] > 0 else ","


def read_delimited_with_label(spark: SparkSession, path: str, n_columns: int,
                              label_column: int = 0, weight_column: int | None = None) -> DataFrame:
    """Headerless numeric delimited file: label picked by index, optional weight column.

    Output columns: ``label``, optional ``weight``, and ``f0..`` for the rest.
    """
    sep = sniff_delimiter(spark, path)
    raw_names = [f"_c{i}" for i in range(n_columns)]
    schema = T.StructType([T.StructField(n, T.DoubleType(), True) for n in raw_names])
    df = read_csv(spark, path, schema, header=False, sep=sep)
    cols = [F.col(raw_names[label_column]).alias("label")]
    if weight_column is not None:
        cols.append(F.col(raw_names[weight_column]).alias("weight"))
    rest = [i for i in range(n_columns) if i not in (label_column, weight_column)]
    cols += [F.col(raw_names[i]).cast("float").alias(f"f{j}") for j, i in enumerate(rest)]
    return df.select(*cols)


def read_partitioned(spark: SparkSession, base_path: str, partition_filter: str | Column | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Hive-partitioned scan; a filter on partition columns prunes directories."""
    df = spark.read.format(fmt).option("basePath", base_path).load(base_path)
    if partition_filter is not None:
        df = df.filter(partition_filter)
    return df


def read_date_range(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Inclusive [start, end] range on a timestamp column (pushed to the scan)."""
    return df.filter((F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
                     & (F.col(ts_col) <= F.lit(end).cast("timestamp_ntz")))


class ScanPlan(NamedTuple):
    files: int
    bytes: int
    split_bytes: int
    open_cost: int
    partitions: int


def plan_scan(spark: SparkSession, paths: str | Sequence[str], target_bytes: int = 128 << 20, min_partitions: int = 1) -> ScanPlan:
    """Split size and open cost for a read, from the files' sizes alone (their contents aren't read).

    Splits hold ``target_bytes``, or less where that would make fewer than ``min_partitions``; opening a file counts as
    much as the average file, at most 4 MB, so that many small files share a partition. ``partitions`` is the estimate
    that follows: each file's bytes and open cost, added up, over the split size.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("length")
    sizes = found.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    n, size = sizes["n"], int(sizes["bytes"] or 0)
    cost = min(4 << 20, size // n) if n else 0
    split = max(1, min(target_bytes, math.ceil((size + n * cost) / max(min_partitions, 1))))
    return ScanPlan(n, size, split, cost, max(1, math.ceil((size + n * cost) / split)))


@contextmanager
def planned_reads(spark: SparkSession, plan: ScanPlan):
    """Reads whose jobs run inside use the plan's split size and open cost; the session's own come back afterwards."""
    wanted = {"spark.sql.files.maxPartitionBytes": plan.split_bytes, "spark.sql.files.openCostInBytes": plan.open_cost}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def from_pandas(spark: SparkSession, pdf, num_partitions: int | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Driver-local frame to a partitioned DataFrame (Arrow path).

    Only for small local inputs (request payloads, parameter tables).
    """
    df = spark.createDataFrame(pdf, schema=schema)
    return df.repartition(num_partitions) if num_partitions else df


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str] | None = None, top_rows: int = 100_000) -> DataFrame:
    """First ``n`` rows; with ``order_by`` (a total order) the choice is deterministic.

    Up to ``top_rows`` one task merges the tasks' first rows; a larger ``n`` numbers the rows in range partitions, so
    no task holds them.
    """
    if not order_by:
        return df.limit(n)
    if n <= top_rows:
        return df.orderBy(*order_by).limit(n)
    from lodestar.plans.scan import row_number
    return row_number(df, [], list(order_by), out="__row").where(F.col("__row") <= n).drop("__row")


def read_dataset(spark: SparkSession, paths: str | Sequence[str], spec: DatasetSpec,
                 fmt: str = "parquet") -> DataFrame:
    """Spec-driven ingest: scan, rename, keep-list with casts, pushed filters, fill."""
    if fmt == "csv":
        df = read_csv(spark, paths, spec.columns, header=True)
    elif fmt == "orc":
        df = read_orc(spark, paths)
    else:
        df = read_parquet(spark, paths)
    present = {k: v for k, v in spec.rename.items() if k in df.columns}
    if present:
        df = df.withColumnsRenamed(present)
    if spec.filters:
        df = df.filter(functools.reduce(operator.and_, [F.expr(f) for f in spec.filters]))
    sel = []
    for fld in spec.columns.fields:
        if fld.name in df.columns:
            sel.append(F.col(fld.name).try_cast(fld.dataType).alias(fld.name))
        else:
            sel.append(F.lit(None).cast(fld.dataType).alias(fld.name))
    df = df.select(*sel)
    if spec.fill is not None:
        df = df.fillna(spec.fill)
    return df
