"""Encoders as Spark ML stages, so they fit, save, load and apply as part of a pipeline.

A fitted stage keeps what it learned in tables (DataFrames), never on the
driver; saving writes them as Parquet beside the parameters. Values of any type
are compared as text.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.encoders import SMALL_DICTIONARY
from lodestar.plans import scan
from lodestar.session import ensure_checkpoint_dir


class _Writer(MLWriter):
    def __init__(self, stage: _TableModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"tables": sorted(self.stage.tables)})
        for name, table in self.stage.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _TableModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(stage, about)
        stage.tables = {name: self.sparkSession.read.parquet(f"{path}/tables/{name}") for name in about["tables"]}
        return stage


class _TableModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """A fitted stage with its tables."""

    def __init__(self):
        super().__init__()
        self.tables: dict[str, DataFrame] = {}

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def _kept(df: DataFrame) -> DataFrame:
    """What was learned, written once to the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _sent(table: DataFrame, rows: int) -> DataFrame:
    """A table to join rows with: sent to every task when its counted rows are few, so that a frequent value is no hot key."""
    return F.broadcast(table) if rows <= SMALL_DICTIONARY else table


def _long(df: DataFrame, columns: list[str], *others) -> DataFrame:
    """(column, value, others...): one row per row and column, values as text."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p"), *others).select("p.column", "p.value", *others)


# ------------------------------------------------------------------ dictionary codes
class DictionaryEncoder(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Codes 0..n-1 in the order of the values; null is -1, a value not seen while fitting n."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> DictionaryEncoderModel:
        seen = _kept(_long(df, self.getInputCols()).where(F.col("value").isNotNull()).distinct())
        if seen.limit(SMALL_DICTIONARY + 1).count() <= SMALL_DICTIONARY:  # counted, not estimated
            numbered = seen.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy("value")))
        else:
            numbered = scan.row_number(seen, ["column"], ["value"], out="place")  # all columns in one scan
        model = DictionaryEncoderModel()
        model.tables = {"codes": _kept(numbered.select("column", "value", (F.col("place") - 1).cast("int").alias("code")))}
        return self._copyValues(model)


class DictionaryEncoderModel(_TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        codes = self.tables["codes"]
        sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
        for source, out in zip(self.getInputCols(), self.getOutputCols()):
            mine = codes.where(F.col("column") == source).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
            mine = _sent(mine, sizes.get(source, 0))
            joined = df.withColumn("__value", F.col(source).cast("string")).join(mine, "__value", "left")
            code = F.when(F.col(source).isNull(), F.lit(-1)).otherwise(F.coalesce("__code", F.lit(int(sizes.get(source, 0)))))
            df = joined.withColumn(out, code.cast("int")).drop("__value", "__code")
        return df


# ------------------------------------------------------------------ target means
class _TargetParams(HasInputCols, HasOutputCols, HasLabelCol):
    smooth: Param[float] = Param(Params._dummy(), "smooth", "weight of the overall mean", TypeConverters.toFloat)
    foldCol: Param[str] = Param(Params._dummy(), "foldCol", "rows with a fold leave it out of their means", TypeConverters.toString)


class TargetMeanEncoder(Estimator, _TargetParams, DefaultParamsReadable, DefaultParamsWritable):
    """A category's label mean, drawn towards the overall mean by ``smooth`` rows.

    With ``foldCol``, a row that has a fold (a training row) takes the mean of the other folds; a row without that
    column, or with a null in it, takes the mean of all training rows. Unseen and null categories take the overall mean.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, labelCol: str | None = None,
                 smooth: float = 0.001, foldCol: str = ""):
        super().__init__()
        self._setDefault(smooth=0.001, foldCol="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> TargetMeanEncoderModel:
        fold, label = self.getOrDefault("foldCol"), F.col(self.getLabelCol()).cast("double")
        rows = df.select(*self.getInputCols(), label.alias("__y"), (F.col(fold).cast("long") if fold else F.lit(None).cast("long")).alias("fold"))
        sums = _long(rows, self.getInputCols(), "__y", "fold").where(F.col("value").isNotNull()).groupBy("column", "value", "fold").agg(
            F.sum("__y").alias("s"), F.count("__y").alias("n"))
        model = TargetMeanEncoderModel()
        model.tables = {"sums": _kept(sums), "mean": _kept(rows.agg(F.avg("__y").alias("mean")))}
        return self._copyValues(model)


class TargetMeanEncoderModel(_TableModel, _TargetParams):
    def __init__(self):
        super().__init__()
        self._setDefault(smooth=0.001, foldCol="")

    def _transform(self, df: DataFrame) -> DataFrame:
        mean = self.tables["mean"].first()["mean"]  # one number
        fold, smooth = self.getOrDefault("foldCol"), self.getOrDefault("smooth")
        out_of_fold = bool(fold) and fold in df.columns
        sizes = {r["column"]: r["n"] for r in self.tables["sums"].groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
        for source, out in zip(self.getInputCols(), self.getOutputCols()):
            mine = self.tables["sums"].where(F.col("column") == source)
            whole = mine.groupBy(F.col("value").alias("__value")).agg(F.sum("s").alias("__s"), F.sum("n").alias("__n"))
            rows = df.withColumn("__value", F.col(source).cast("string")).join(_sent(whole, sizes.get(source, 0)), "__value", "left")
            s, n = F.col("__s"), F.col("__n")
            if out_of_fold:
                own = mine.where(F.col("fold").isNotNull()).select(
                    F.col("value").alias("__value"), F.col("fold").alias("__fold"), F.col("s").alias("__own_s"), F.col("n").alias("__own_n"))
                rows = rows.withColumn("__fold", F.col(fold).cast("long")).join(_sent(own, sizes.get(source, 0)), ["__value", "__fold"], "left")
                s, n = s - F.coalesce("__own_s", F.lit(0.0)), n - F.coalesce("__own_n", F.lit(0))
            code = F.coalesce(F.try_divide(s + F.lit(smooth * mean), n + F.lit(smooth)), F.lit(mean)) if mean is not None else F.lit(None).cast("double")
            df = rows.withColumn(out, code).drop("__value", "__s", "__n", "__fold", "__own_s", "__own_n")
        return df
