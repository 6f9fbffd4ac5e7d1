"""Column-level functions (pure Spark SQL expressions, code-generated)."""

from lodestar.functions.hashing import portable_bucket, portable_bucket_sql, portable_row_id
from lodestar.functions.dates import (
    date_parts, day_of_week_sat0, weekday_mon0, is_weekend, duration_seconds,
)
from lodestar.functions.geo import round_coordinate, haversine_km
from lodestar.functions.numeric import ratio_percent, threshold_label

__all__ = [
    "portable_bucket", "portable_bucket_sql", "portable_row_id", "date_parts", "day_of_week_sat0",
    "weekday_mon0", "is_weekend", "duration_seconds", "round_coordinate",
    "haversine_km", "ratio_percent", "threshold_label",
]
