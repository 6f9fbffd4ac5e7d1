"""Date, geo and derived-column feature stages (native expressions, one projection)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import dates, geo

# Modelling columns of the taxi regression table.
TAXI_MODEL_COLUMNS = ("passenger_count", "trip_distance", "pickup_longitude", "pickup_latitude",
                      "rate_code_id", "dropoff_longitude", "dropoff_latitude", "fare_amount",
                      "duration_s", "h_distance", "day_of_week", "is_weekend")


def add_taxi_features(df: DataFrame, pickup: str = "pickup_datetime",
                      dropoff: str | None = "dropoff_datetime",
                      coords: Sequence[str] = ("pickup_latitude", "pickup_longitude",
                                               "dropoff_latitude", "dropoff_longitude"),
                      haversine_on_rounded: bool = False, round_step: float | None = 0.01,
                      drop_timestamps: bool = True) -> DataFrame:
    """Date parts, weekday/weekend, duration, rounded coordinates and haversine distance.

    All of it is one ``withColumns`` projection (no UDF), fused into the scan's
    code-generated stage.
    """
    exprs = dict(dates.date_parts(pickup))
    exprs["day_of_week"] = dates.weekday_mon0(pickup)
    exprs["is_weekend"] = dates.is_weekend(pickup)
    if dropoff and dropoff in df.columns:
        exprs["duration_s"] = dates.duration_seconds(pickup, dropoff)
    lat1, lon1, lat2, lon2 = coords
    if round_step:
        for c in coords:
            exprs[f"{c}_r"] = geo.round_coordinate(c, round_step)
    src = [f"{c}_r" for c in coords] if (haversine_on_rounded and round_step) else list(coords)
    out = df.withColumns(exprs)
    out = out.withColumn("h_distance", geo.haversine_km(*src).cast("float"))
    if drop_timestamps:
        out = out.drop(*[c for c in (pickup, dropoff) if c and c in out.columns])
    return out


def select_model_columns(df: DataFrame, columns: Sequence[str] = TAXI_MODEL_COLUMNS) -> DataFrame:
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])
