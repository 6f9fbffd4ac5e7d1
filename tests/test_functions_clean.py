import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions import (day_of_week_sat0, haversine_km, is_weekend, portable_bucket,
                                portable_bucket_sql, round_coordinate, weekday_mon0)
from lodestar.operators import clean


def test_portable_bucket_matches_sql(spark):
    keys = [0, 1, 7, 123456789, 98765432101]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long")
           .select(portable_bucket("k", 7)).collect()]
    exp = [duckdb.sql(f"SELECT {portable_bucket_sql(str(k), 7)}").fetchall()[0][0] for k in keys]
    assert got == exp
    assert all(0 <= g < 1000 for g in got)


def test_day_of_week_variants(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 Sunday, 2024-01-08 Monday (Jan/Feb included on purpose)
    days = [dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8), dt.datetime(2016, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    rows = df.select(day_of_week_sat0("ts").alias("s"), weekday_mon0("ts").alias("m"),
                     is_weekend("ts").alias("w")).collect()
    assert [(r.s, r.m, r.w) for r in rows] == [(0, 5, 1), (1, 6, 1), (2, 0, 0), (2, 0, 0)]


def test_geo(spark):
    df = spark.createDataFrame([(40.7128, -74.0060, 42.3601, -71.0589, -73.987)], "a double, b double, c double, d double, e double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("h"), round_coordinate("e").alias("rc")).collect()[0]
    assert abs(r.h - 306.1) < 1.0  # New York - Boston
    assert abs(r.rc - (-73.99)) < 1e-9  # floor goes down for negatives


def test_cleaning_chain(spark):
    df = spark.createDataFrame([(" A ", 5, "3.5", None, 2.5), ("b", None, None, "x", None)],
                               "` Id ` string, `Count` long, `Txt` string, `Junk` string, `Val` double")
    out = clean.normalize_names(df)
    assert out.columns == ["id", "count", "txt", "junk", "val"]
    out = clean.rename_columns(out, {"txt": "text_num", "absent": "zzz"})
    out = clean.keep_columns(out, ["count", "text_num", "val", "not_there"])
    assert out.columns == ["count", "text_num", "val"]
    out = clean.strings_to_float(out, null_text="-1")
    out = clean.downcast_numeric(out)
    assert dict(out.dtypes) == {"count": "int", "text_num": "float", "val": "float"}
    out = clean.fill_numeric(out, -1)
    rows = sorted(out.collect(), key=lambda r: r["count"])
    assert [tuple(r) for r in rows] == [(-1, -1.0, -1.0), (5, 3.5, 2.5)]


def test_label_first_difference_threshold(spark):
    df = spark.createDataFrame([(1, 20.0, 3.0), (2, None, 4.0), (3, 5.0, 1.0)], "id int, ArrDelay double, b double")
    lab = clean.add_threshold_label(df, "ArrDelay", "ArrDel15", 10.0)
    assert "ArrDelay" not in lab.columns
    assert [r.ArrDel15 for r in lab.orderBy("id").collect()] == [1, 0, 0]
    assert clean.columns_difference(lab, ["ArrDel15"]) == ["b", "id"]
    sel = clean.select_label_first(lab, "ArrDel15", ["b", "missing"])
    assert sel.columns == ["ArrDel15", "b", "missing"]
    assert sel.filter(F.col("missing").isNotNull()).count() == 0


def test_drop_nulls_and_filters(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 3.0), (600.0, 1.0)], "fare double, p double")
    assert clean.drop_nulls(df).count() == 2
    kept = clean.apply_range_filter(df, ["fare > 0 and fare < 500", "p > 0 and p < 6"])
    assert kept.count() == 1
    with pytest.raises(Exception):
        clean.apply_range_filter(df, ["no_such_col > 1"]).count()


def test_cast_drop_strings_and_text_predicates(spark):
    df = spark.createDataFrame([(True, 3, "4.5", "load"), (False, 1, "x", "fit")], "b boolean, i long, s string, type string")
    casted = clean.cast_all_float(df.drop("type"))
    assert set(t for _, t in casted.dtypes) == {"float"}
    assert clean.drop_string_columns(df).columns == ["b", "i"]
    assert clean.filter_query(df, "type != 'load'", "i > 0").count() == 1
