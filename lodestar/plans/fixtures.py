"""Analogue inputs derived from the supplied tables.

The reference's workloads run on taxi trips, flights, trial logs and timing
tables; these functions re-express the supplied TPC-H-like tables in those
shapes with plain projections, so every named query reads the real tables and
its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.hashing import portable_row_id
from lodestar.plans.catalog import load

# Columns that identify a lineitem row (its (orderkey, linenumber) pair repeats).
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def coord(key: str, base: float) -> F.Column:
    """Synthetic coordinate: base + (key mod 200) / 100 degrees."""
    return F.lit(base) + F.pmod(F.col(key), F.lit(200)) / F.lit(100)


def taxi_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a raw taxi-trip source (mixed-case names, string rate code, nullable counts)."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        portable_row_id(*LINE_KEY).alias("Row_Id"),
        F.col("l_orderkey").alias("Trip_Id"),
        F.col("l_linenumber").cast("bigint").alias("Leg"),
        F.col("l_extendedprice").alias(" Fare_Amount "),
        F.expr("nullif(l_linenumber, 3)").cast("bigint").alias("Passenger_Count"),
        F.col("l_quantity").alias("Trip_Distance"),
        F.col("l_returnflag").alias("Rate_Code"),
        F.col("l_discount").alias("Tip_Rate"),
        F.col("l_tax").alias("Tax_Rate"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        coord("l_suppkey", -75.0).alias("pickup_longitude"),
        coord("l_partkey", 40.0).alias("pickup_latitude"),
        coord("l_orderkey", -75.0).alias("dropoff_longitude"),
        coord("l_partkey", 40.5).alias("dropoff_latitude"),
    )


# Rename map and keep-list of the taxi cleaning stage (analogue names).
TAXI_RENAME = {"tpep_pickup_datetime": "pickup_datetime", "rate_code": "rate_code_id"}
TAXI_KEEP = ("row_id", "trip_id", "leg", "fare_amount", "passenger_count", "trip_distance", "rate_code_id",
             "tip_rate", "tax_rate", "pickup_datetime", "pickup_longitude", "pickup_latitude",
             "dropoff_longitude", "dropoff_latitude")
# Open-interval outlier bounds (fare, passengers, lon x2, lat x2) on the analogue.
TAXI_FILTERS = (
    "fare_amount > 1000 and fare_amount < 100000",
    "passenger_count > 0 and passenger_count < 6",
    "pickup_longitude > -75 and pickup_longitude < -73",
    "dropoff_longitude > -75 and dropoff_longitude < -73",
    "pickup_latitude > 40 and pickup_latitude < 42",
    "dropoff_latitude > 40 and dropoff_latitude < 42",
)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x lineitem as a flight-delay table: delay = ship day - order day (days).

    Categorical-like columns: carrier = part brand key bucket, origin = order
    priority, plus calendar fields of the order date.
    """
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          "l_discount", "l_tax", "l_extendedprice", "l_shipdate"])
    od = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        portable_row_id(*LINE_KEY).alias("flight_id"),
        F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month"),
        F.dayofmonth("o_orderdate").alias("DayofMonth"), F.dayofweek("o_orderdate").alias("DayOfWeek"),
        F.col("o_orderpriority").alias("Origin"),
        F.col("l_quantity").alias("Distance"), F.col("l_discount").alias("TaxiOut"), F.col("l_tax").alias("TaxiIn"),
        (F.col("o_totalprice") / 1000).alias("CRSElapsedTime"),
        F.col("l_linenumber").alias("FlightNum"),
        F.date_diff(F.col("l_shipdate"), F.col("o_orderdate")).alias("ArrDelay"),
    )


# Modelling inputs of the delay classifier (after encoding Origin).
FLIGHT_FEATURES = ("CRSElapsedTime", "DayOfWeek", "DayofMonth", "Distance", "FlightNum", "Month",
                   "Origin_code", "TaxiIn", "TaxiOut", "Year")
