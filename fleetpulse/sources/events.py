"""Event sources in batch form.

``bind_events`` maps the driver's ``events`` table onto the event schema
(device_id, timestamp ms, cpu_usage) plus a TIMESTAMP column ``ts`` for
Spark's event-time operators. The device binding is a parameter: the
per-user binding has many small keys, the per-event-type one a handful of
large keys, which is where interpolation and skew handling matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import column_to_ms, ms_to_ts


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def bind_events(raw: DataFrame, device: str | Column = "user_id",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """events(event_id, ts NTZ, user_id, event_type, value, props) ->
    (device_id, timestamp, cpu_usage, ts, *keep).

    ``ts`` arrives as TIMESTAMP_NTZ with microseconds; it is read as UTC
    (whatever the session's time zone) and floored to the millisecond, as
    the wire format carries epoch ms.
    """
    dev = F.col(device) if isinstance(device, str) else device
    ms = column_to_ms(raw, "ts")
    cols = [dev.cast("string").alias("device_id"),
            ms.alias("timestamp"),
            F.col("value").cast("double").alias("cpu_usage")]
    cols += [F.col(k) for k in keep]
    out = raw.select(*cols)
    return out.withColumn("ts", ms_to_ts(F.col("timestamp")))


def load_events(spark: SparkSession, sf_dir: str, device: str = "user_id",
                keep: tuple[str, ...] = ()) -> DataFrame:
    return bind_events(read_table(spark, sf_dir, "events"), device, keep)


def with_event_time(df: DataFrame, ms_col: str = "timestamp") -> DataFrame:
    """O-08: event time is the event's own epoch-ms field."""
    return df.withColumn("ts", ms_to_ts(F.col(ms_col)))
