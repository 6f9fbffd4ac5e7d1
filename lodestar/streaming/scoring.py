"""Request and stream scoring with a fitted pipeline.

A request body is a JSON list of feature arrays. Bodies are parsed with
``from_json`` (malformed text -> NULL, never an exception), exploded to one
row per instance with its position, scored by the pipeline's ``transform``
(the model is shipped once per executor), and malformed bodies are returned
as rows with status ``unsupported`` instead of failing the batch. The same
function runs on a batch DataFrame or inside a streaming query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

REQUEST_SCHEMA = T.ArrayType(T.ArrayType(T.DoubleType()))


def parse_requests(df: DataFrame, request_id: str, body: str, n_features: int | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """(instances, rejected): instances = request_id, position, values; rejected = request_id, status.

    Pure per-row expressions (no joins or aggregation), so the same code runs
    on a batch frame and inside a streaming query. A request is rejected when
    its body is not a JSON list of arrays, is empty, or (with ``n_features``)
    any instance has the wrong width.
    """
    parsed = df.select(request_id, F.from_json(F.col(body), REQUEST_SCHEMA).alias("__rows"))
    valid = F.col("__rows").isNotNull() & (F.size("__rows") > 0)
    if n_features is not None:
        valid = valid & F.forall("__rows", lambda x: F.size(x) == F.lit(n_features))
    parsed = parsed.withColumn("__ok", F.coalesce(valid, F.lit(False)))
    inst = parsed.filter("__ok").select(request_id, F.posexplode("__rows").alias("position", "values"))
    rejected = parsed.filter(~F.col("__ok")).select(request_id, F.lit("unsupported").alias("status"))
    return inst, rejected


def score_requests(model, df: DataFrame, request_id: str, body: str, n_features: int | None = None,
                   threshold: float | None = None, features_col: str = "features") -> DataFrame:
    """Scored instances plus rejected requests: request_id, position, prediction, status.

    With ``n_features`` each body is parsed once: a rejected request goes on as one row without a position, is scored
    as zeros, and its prediction is dropped.
    """
    if n_features is None:
        inst, rejected = parse_requests(df, request_id, body)
        scored = model.transform(inst.withColumn(features_col, array_to_vector("values")))
        good = scored.select(request_id, "position", _prediction(scored, threshold).alias("prediction"), F.lit("ok").alias("status"))
        return good.unionByName(rejected.select(request_id, F.lit(None).cast("int").alias("position"),
                                                F.lit(None).cast("double").alias("prediction"), "status"))
    parsed = df.select(request_id, F.from_json(F.col(body), REQUEST_SCHEMA).alias("__rows"))
    valid = (F.size("__rows") > 0) & F.forall("__rows", lambda x: F.size(x) == F.lit(n_features))
    rows = parsed.select(request_id, F.posexplode_outer(F.when(valid, F.col("__rows"))).alias("position", "values"))
    zeros = F.array_repeat(F.lit(0.0), n_features)
    scored = model.transform(rows.withColumn(features_col, array_to_vector(F.coalesce("values", zeros))))
    ok = F.col("position").isNotNull()
    return scored.select(request_id, "position", F.when(ok, _prediction(scored, threshold)).alias("prediction"),
                         F.when(ok, F.lit("ok")).otherwise(F.lit("unsupported")).alias("status"))


def _prediction(scored: DataFrame, threshold: float | None):
    if threshold is not None and "probability" in scored.columns:
        return (vector_to_array("probability")[1] > F.lit(threshold)).cast("double")
    return F.col("prediction").cast("double")


def stream_score(spark: SparkSession, model, source_dir: str, schema: T.StructType, output_dir: str,
                 checkpoint_dir: str, prepare: Callable[[DataFrame], DataFrame], keep: list[str],
                 max_bytes_per_trigger: int = 1 << 30, timeout_s: float | None = None) -> DataFrame:
    """Score every file that lands in ``source_dir`` (Parquet) and append results to ``output_dir``.

    Stateless: each micro-batch is ``prepare -> model.transform``. The trigger
    processes what is available in bounded batches (``maxBytesPerTrigger``)
    and stops; progress lives in ``checkpoint_dir`` so a restarted query skips
    files it already scored. Returns the output table.
    """
    stream = (spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes_per_trigger)
              .parquet(source_dir))
    scored = model.transform(prepare(stream)).select(*keep, F.col("prediction").cast("double").alias("prediction"))
    q = (scored.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start(output_dir))
    finish(q, timeout_s)
    return spark.read.parquet(output_dir)


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for a query over what is available; no limit unless one is given. Errors of the query are raised."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("the stream did not finish in time")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
