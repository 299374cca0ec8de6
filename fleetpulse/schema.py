"""Schemas of the three record kinds and the metrics table."""

from pyspark.sql import types as T

# Raw usage event (JSON names deviceId / timestamp / cpuUsage on the wire).
EVENT_SCHEMA = T.StructType([
    T.StructField("device_id", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),      # epoch ms
    T.StructField("cpu_usage", T.DoubleType(), True),
])

# Wire form of a raw event, as produced by the device fleet.
EVENT_JSON_SCHEMA = T.StructType([
    T.StructField("deviceId", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("cpuUsage", T.DoubleType(), True),
])

# One computed window result (what the stream job emits).
RESULT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("device_id", T.StringType(), False),
    T.StructField("window_start", T.LongType(), False),   # observed min event time, ms
    T.StructField("window_end", T.LongType(), False),     # observed max event time, ms
    T.StructField("percentile_95", T.DoubleType(), False),
    T.StructField("last_updated", T.LongType(), False),   # emission time, ms
])

# Wire form of a result.
RESULT_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("deviceId", T.StringType(), True),
    T.StructField("windowStart", T.LongType(), True),
    T.StructField("windowEnd", T.LongType(), True),
    T.StructField("percentile95", T.DoubleType(), True),
    T.StructField("lastUpdated", T.LongType(), True),
])

# Metrics table. ``window_date`` is the partition column (UTC date of the
# observed window start), used for pruning lookups and the idempotent append.
METRICS_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("device_id", T.StringType(), False),
    T.StructField("window_start", T.LongType(), False),
    T.StructField("window_end", T.LongType(), False),
    T.StructField("percentile_95", T.DoubleType(), False),
    T.StructField("last_updated", T.LongType(), False),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("window_date", T.DateType(), True),
])

# Columns returned by the read queries.
QUERY_COLUMNS = ["device_id", "percentile_95", "window_start", "window_end", "last_updated"]
