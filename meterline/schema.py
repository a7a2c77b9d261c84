"""Row shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names of a ride point message ---
RIDE_SCHEMA = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("meter_reading", T.DoubleType()),
        T.StructField("meter_increment", T.DoubleType()),
        T.StructField("ride_status", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("point_idx", T.LongType()),
    ]
)

# Read as text first, so that one bad field makes a reject with a reason and not a NULL row.
RIDE_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RIDE_SCHEMA.fields])

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# --- fixed values: output columns per message kind ---
POINT_COLUMNS = ["latitude", "longitude", "ride_id", "timestamp", "ride_status"]
CELL_COLUMNS = ["latitude", "longitude", "ntaxis"]
RATE_COLUMNS = ["dollar_run_rate_per_minute"]
PANE_COLUMNS = ["dollar_turnover", "dollar_timing", "dollar_window"]
CLOCK_COLUMNS = ["timestamp"]
