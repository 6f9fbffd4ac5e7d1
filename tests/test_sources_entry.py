import pytest
from pyspark.sql import types as T

import __spark_entry__ as se
from conftest import SF_SMALL
from lodestar import sources
from lodestar.session import shared_path


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"split", "day_of_week", "n_trips", "mean_fare"}


def test_oracle_keys_are_queries():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.queries()) >= 70


def test_format_detection(spark):
    path = shared_path(spark, "t_detect", unique=True)
    with pytest.raises(FileNotFoundError):
        sources.detect_format(spark, path)
    spark.range(5).write.parquet(path)
    assert sources.detect_format(spark, path)[0] == "parquet"
    spark.range(3).write.mode("append").option("header", True).csv(path)
    assert sources.detect_format(spark, path)[0] == "csv"


def test_sniff_and_named_csv(spark):
    path = shared_path(spark, "t_sniff", unique=True)
    spark.createDataFrame([(1, 2.5, 3.0)], "a int, b double, c double").write.option("sep", "|").csv(path)
    assert sources.sniff_delimiter(spark, path) == "|"
    out = sources.read_delimited_with_label(spark, path, 3, label_column=1)
    assert out.columns == ["label", "f0", "f1"] and out.collect()[0].label == 2.5


def test_orc_written_once(spark):
    path = shared_path(spark, "t_orc", unique=True)
    first = sources.write_orc_once(spark.range(4), path)
    second = sources.write_orc_once(spark.range(10), path)
    assert first.count() == 4 and second.count() == 4


def test_partition_pruning(spark):
    from lodestar.plans import queries
    df = queries.partition_scan(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "o_year" in plan
    assert df.filter("o_month not in (11, 12)").count() == 0


def test_column_pruning_in_scan(spark):
    from lodestar.plans import queries
    plan = queries.hash_sample(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_local_frame_to_partitioned(spark):
    import pandas as pd
    df = sources.from_pandas(spark, pd.DataFrame({"a": range(100)}), num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
