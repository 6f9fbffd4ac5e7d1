"""Skew-safe running aggregates (segmented prefix scan) and exact quantiles.

A window ``partitionBy(k).orderBy(o)`` sends every row of a key to one task,
so a key holding a third of the data would be sorted by a single task. The
scan here instead:

1. range-partitions by ``(k, o)`` -- a hot key is split across many
   partitions by the sampled range bounds;
2. computes the running aggregate inside each partition (sorted, Arrow
   batches, one pass, carried across batches);
3. aggregates each (partition, key) segment, and takes an exclusive prefix of
   those segment totals over the partition order (a tiny table: at most one
   row per partition can receive a carry, since keys are sorted);
4. broadcasts that carry table (bounded by the partition count, not by the
   data) and folds it into the local results.

The range-partitioned rows are checkpointed once (reliable checkpoint in the
shared folder), so both branches see the same partitions even when the input
order is not deterministic or an executor is lost.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PID = "__pid"
_OPS = ("sum", "max", "min", "count")
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Bytes of a value, about; 16 for types that aren't named.
_WIDTHS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.StringType: 24, T.BinaryType: 64,
           T.ArrayType: 128, T.MapType: 128, T.StructType: 64}


def _out_type(op: str, dtype: T.DataType | None) -> T.DataType:
    if op == "count":
        return T.LongType()
    if isinstance(dtype, _INTEGRAL):
        return T.LongType()
    return T.DoubleType()


def _same(a, b) -> bool:
    """Equal key values; NULL equals NULL and NaN equals NaN."""
    return a == b or (isinstance(a, float) and isinstance(b, float) and np.isnan(a) and np.isnan(b))


def _segments(batch: pa.RecordBatch, key_cols: list[str]) -> np.ndarray:
    """Number of the key run of each row (rows are sorted by key)."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for c in key_cols:
        codes = pc.dictionary_encode(batch[c], null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(change)


def _values(column: pa.Array, integral: bool) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 where missing) and flags of the rows that have one; NULL and NaN are missing."""
    if integral:
        has = np.asarray(pc.is_valid(column))
        return np.asarray(pc.fill_null(column.cast(pa.int64()), 0)), has
    floats = np.asarray(pc.fill_null(column.cast(pa.float64()), float("nan")))
    has = ~np.isnan(floats)
    return np.where(has, floats, 0.0), has


def _local_scan_fn(key_cols: list[str], specs: list[tuple[str, str, str | None]],
                   out_types: dict[str, T.DataType]):
    """Per-partition running aggregates over rows sorted by (keys, order).

    Arrow columns go through untouched; integers are added and compared as 64-bit integers.
    """
    lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def fn(batches):
        prev_key, prev = None, {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            seg = _segments(batch, key_cols)
            first_key = [batch[c][0].as_py() for c in key_cols]
            continues = prev_key is not None and all(_same(a, b) for a, b in zip(prev_key, first_key))
            in_first = seg == 0
            columns = {c: batch[c] for c in batch.schema.names}
            for out, op, col in specs:
                integral = isinstance(out_types[out], T.LongType)
                if col is None:
                    vals, has = np.ones(n, dtype=np.int64), np.ones(n, dtype=bool)
                else:
                    vals, has = _values(batch[col], integral) if op != "count" else (
                        np.zeros(n, dtype=np.int64), np.asarray(pc.is_valid(batch[col])))
                    if op == "count" and pa.types.is_floating(batch[col].type):
                        has = _values(batch[col], False)[1]
                grouped = lambda x: pd.Series(x).groupby(seg)
                seen = grouped(has.astype(np.int64)).cumsum().to_numpy()
                if op == "count":
                    res, join = seen, np.add
                elif op == "sum":
                    res, join = grouped(vals).cumsum().to_numpy(), np.add
                elif op == "max":
                    res = grouped(np.where(has, vals, lowest if integral else -np.inf)).cummax().to_numpy()
                    join = np.maximum
                else:
                    res = grouped(np.where(has, vals, highest if integral else np.inf)).cummin().to_numpy()
                    join = np.minimum
                if continues:
                    carry, carry_seen = prev[out]
                    res = np.where(in_first, join(res, carry), res)
                    seen = np.where(in_first, seen + carry_seen, seen) if op != "count" else res
                prev[out] = (res[-1], seen[-1])
                none = seen == 0 if op != "count" else np.zeros(n, dtype=bool)
                columns[out] = pa.array(res, pa.int64() if integral else pa.float64(), mask=none)
            prev_key = [batch[c][n - 1].as_py() for c in key_cols]
            yield pa.RecordBatch.from_pydict(columns)

    return fn


def scan_partitions(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Range partitions for a scan: enough for ``target_bytes`` of the rows counted at the width of their types.

    The count reads no more columns than the plan below needs. There is no upper limit; the lower one is the default
    parallelism, as AQE cannot coalesce a range exchange of a fixed number.
    """
    width = sum(_WIDTHS.get(type(f.dataType), 16) for f in df.schema.fields)
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * (width + 8) // target_bytes))


def running_aggregate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                      aggs: Mapping[str, tuple[str, str | None]],
                      num_partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """Inclusive running aggregates, like ``agg(col).over(partitionBy.orderBy.rowsBetween(-inf, 0))``.

    ``aggs`` maps output name -> (op, column); op in sum/max/min/count and a
    ``None`` column counts rows (a row number when the order is total). NULL and
    NaN values are missing: they change no aggregate.
    ``order_by`` must be a total order within each key for deterministic results
    (add a unique id as the last element).

    ``materialize`` (default) writes the range-partitioned, sorted rows once
    with a reliable ``checkpoint()`` to the shared checkpoint folder, so the
    scan branch and the carry branch read identical partitions whatever the
    input's order, and a lost executor re-reads files instead of re-sampling
    range bounds. Without it, both branches rely on Spark reusing one range
    exchange, which is only guaranteed for deterministic inputs.
    """
    keys = list(partition_by)
    order = list(order_by)
    specs = [(out, op, col) for out, (op, col) in aggs.items()]
    for out, op, _ in specs:
        if op not in _OPS:
            raise ValueError(f"unsupported running op {op!r}")
        if out in df.columns:
            raise ValueError(f"output column {out!r} already exists")
    spark = df.sparkSession
    n = num_partitions or scan_partitions(df)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out_types = {out: _out_type(op, types.get(col) if col else None) for out, op, col in specs}

    parted = df.repartitionByRange(n, *[F.col(c) for c in keys + order]).sortWithinPartitions(*(keys + order))
    if materialize:
        parted = parted.checkpoint(eager=True)
    ranged = parted.withColumn(_PID, F.spark_partition_id())
    schema = T.StructType(list(ranged.schema.fields)
                          + [T.StructField(o, out_types[o], True) for o, _, _ in specs])
    local = ranged.mapInArrow(_local_scan_fn(keys, specs, out_types), schema=schema)

    # Segment totals per (partition, key) from the raw values, with map-side
    # partial aggregation. With a materialised input they come straight from
    # the checkpoint (no second Python pass); otherwise from ``local``, whose
    # Python pass consumes every column so both branches share one exchange.
    seg_aggs = []
    def present(col: str):
        """The column with NaN as missing, as in the partitions' scan."""
        c = F.col(col)
        return F.nanvl(c, F.lit(None).cast(types[col])) if isinstance(types[col], (T.FloatType, T.DoubleType)) else c

    for out, op, col in specs:
        if op == "count":
            seg_aggs.append((F.count(present(col)) if col else F.count(F.lit(1))).alias(out))
        else:
            seg_aggs.append(getattr(F, op)(present(col)).alias(out))
    summary = (ranged if materialize else local).groupBy(_PID, *keys).agg(*seg_aggs)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(_PID) \
        .rowsBetween(Window.unboundedPreceding, -1)
    prefix = {}
    for out, op, _ in specs:
        fn = F.sum if op in ("sum", "count") else getattr(F, op)
        prefix[f"__carry_{out}"] = fn(F.col(out)).over(w)
    carry = summary.select(F.col(_PID).alias("__c_pid"),
                           *[F.col(k).alias(f"__c_key{i}") for i, k in enumerate(keys)],
                           *[c.alias(k) for k, c in prefix.items()])
    carry = carry.filter(functools.reduce(lambda a, b: a | b,
                                          [F.col(k).isNotNull() for k in prefix]))
    # At most one carried key per partition: the broadcast is bounded by n rows.
    cond = [F.col(_PID) == F.col("__c_pid")] + [
        F.col(k).eqNullSafe(F.col(f"__c_key{i}")) for i, k in enumerate(keys)]
    joined = local.join(F.broadcast(carry), on=functools.reduce(lambda a, b: a & b, cond), how="left")
    cols = []
    for f in local.schema.fields:
        name = f.name
        if name == _PID:
            continue
        spec = next((s for s in specs if s[0] == name), None)
        if spec is None:
            cols.append(F.col(name))
            continue
        _, op, _ = spec
        c = F.col(f"__carry_{name}")
        mine = F.col(name)
        if op in ("sum", "count"):
            expr = F.when(c.isNull(), mine).otherwise(F.coalesce(mine, F.lit(0)) + c)
        elif op == "max":
            expr = F.greatest(mine, c)
        else:
            expr = F.least(mine, c)
        cols.append(expr.cast(out_types[name]).alias(name))
    return joined.select(*cols)


def row_number(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
               out: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """1-based position within each key by a total order (skew-safe ``row_number``)."""
    return running_aggregate(df, partition_by, order_by, {out: ("count", None)}, num_partitions)


def exact_quantiles(df: DataFrame, group_by: Sequence[str], value: str,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group (``quantile_cont`` semantics).

    Duplicates are collapsed first (map-side partial aggregation), the running
    count over the sorted distinct values comes from the skew-safe scan, and
    each quantile is a decomposable ``min`` over the values whose cumulative
    count passes the target rank. No task ever holds a whole group.
    """
    keys = list(group_by)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    hist = (df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c")))
    cum = running_aggregate(hist, keys, [value], {"__cum": ("sum", "__c")}, num_partitions)
    totals = hist.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    if keys:
        # Per-group totals: AQE broadcasts them when small, or splits a skewed key.
        j = cum.join(totals, on=keys, how="inner")
    else:
        # One total row: a broadcast equi-join on a constant key.
        j = cum.withColumn("__one", F.lit(1)).join(
            F.broadcast(totals.withColumn("__one", F.lit(1))), on="__one").drop("__one")
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        v_lo = F.min(F.when(F.col("__cum") > lo, F.col(value)))
        v_hi = F.min(F.when(F.col("__cum") > hi, F.col(value)))
        frac = F.first(h - lo)  # same for every row of the group
        aggs.append((v_lo.cast("double") + frac * (v_hi.cast("double") - v_lo.cast("double"))).alias(name))
    return j.groupBy(*keys).agg(*aggs) if keys else j.agg(*aggs)
