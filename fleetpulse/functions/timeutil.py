"""Epoch-millisecond helpers (O-08, O-11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_to_ms(ts: Column) -> Column:
    """TIMESTAMP -> epoch ms, floored (unix_millis floors the microseconds)."""
    return F.unix_millis(ts)


def ntz_to_ms(ntz: str) -> Column:
    """TIMESTAMP_NTZ (a wall-clock reading in UTC) -> epoch ms, floored,
    independent of the session time zone (a cast to TIMESTAMP would read
    the wall clock in the session's zone)."""
    us = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ntz}`)"
    return F.expr(f"({us} - pmod({us}, 1000)) div 1000")


def column_to_ms(df, col: str) -> Column:
    """Epoch ms of a time column of any of the usual types."""
    from pyspark.sql import types as T

    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_to_ms(col)
    if isinstance(dtype, T.TimestampType):
        return ts_to_ms(F.col(col))
    return F.col(col).cast("long")


def ms_to_ts(ms: Column) -> Column:
    """O-11: epoch ms -> TIMESTAMP (the Instant view of a long column)."""
    return F.timestamp_millis(ms)


def as_instants(df, cols=("window_start", "window_end", "last_updated")):
    """O-11 on a result or metrics frame: add ``<col>_ts`` for each ms column."""
    for c in cols:
        df = df.withColumn(f"{c}_ts", ms_to_ts(F.col(c)))
    return df


def clock_ms(now_ms: int | None = None) -> Column:
    """Emission clock: the session's current time, or a fixed instant for
    replays and tests (the reference reads the wall clock)."""
    if now_ms is None:
        return F.unix_millis(F.current_timestamp())
    return F.lit(int(now_ms)).cast("long")


def ingest_lag(df, now_ms: int | None = None, ms_col: str = "timestamp"):
    """O-08: lag between the clock and each event's time, in ms."""
    return df.withColumn("lag_ms", clock_ms(now_ms) - F.col(ms_col))
