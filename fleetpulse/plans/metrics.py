"""Questions the metrics table answers (O-12, O-13, O-19, O-20, O-23..O-26).

All take the table as a DataFrame (``MetricsTable.scan()`` or any frame
with the table's columns) and return a DataFrame. "Newest per device" is an
aggregate of a struct ordered by the wanted sort keys rather than a window
over each device, so a device holding a third of the table is combined
map-side like any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import QUERY_COLUMNS

# The argument limits and messages of the read API.
MIN_N = 1
MAX_N = 100
MSG_BLANK_DEVICE = "Device ID cannot be blank"
MSG_N_MIN = "N must be at least 1"
MSG_N_MAX = "N cannot exceed 100"


def check_device_id(device_id) -> str:
    """O-13: the device argument must be a non-blank string."""
    if device_id is None or not isinstance(device_id, str) or device_id.strip() == "":
        raise ValueError(MSG_BLANK_DEVICE)
    return device_id


def check_n(n) -> int:
    """O-13: n must be an integer in 1..100 ("10" is read, "1.5", "abc" and
    "null" are refused)."""
    if isinstance(n, bool):
        raise ValueError(f"Invalid value for parameter 'n': {n!r}")
    if isinstance(n, str):
        s = n.strip()
        if not s.lstrip("-").isdigit():
            raise ValueError(f"Invalid value for parameter 'n': {n!r}")
        n = int(s)
    if not isinstance(n, int):
        raise ValueError(f"Invalid value for parameter 'n': {n!r}")
    if n < MIN_N:
        raise ValueError(MSG_N_MIN)
    if n > MAX_N:
        raise ValueError(MSG_N_MAX)
    return n


def project(df: DataFrame) -> DataFrame:
    """O-12: the five query columns."""
    return df.select(*QUERY_COLUMNS)


def newest_per_device(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """O-20: one row per device, the greatest by ``order`` (default
    last_updated, then window_end, then event_id)."""
    order = order or [F.col("last_updated"), F.col("window_end"), F.col("event_id")]
    payload = [c for c in df.columns if c != "device_id"]
    best = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                          *[F.col(c) for c in payload]))
    return (df.groupBy("device_id").agg(best.alias("_best"))
            .select("device_id", *[F.col(f"_best.{c}").alias(c) for c in payload]))


def latest_for_device(df: DataFrame, device_id: str, checked: bool = True) -> DataFrame:
    """O-23: the newest metric of one device (empty when unknown); of rows
    that tie in both times the greatest event_id. The device filter reaches
    the Parquet scan; top-1 is TakeOrderedAndProject."""
    if checked:
        check_device_id(device_id)
    return project(df.filter(F.col("device_id") == F.lit(device_id))
                   .orderBy(F.col("last_updated").desc(), F.col("window_end").desc(), F.col("event_id").desc())
                   .limit(1))


def _at_scalar_max(df: DataFrame, col: str, slack_ms: int = 0) -> DataFrame:
    """Rows whose ``col`` equals (or is within ``slack_ms`` of) the table's
    maximum: an uncorrelated scalar subquery, one value."""
    top = df.agg(F.max(col)).scalar()
    if slack_ms:
        return df.filter(F.col(col) >= top - F.lit(int(slack_ms)))
    return df.filter(F.col(col) == top)


def top_devices(df: DataFrame, n: int, basis: str = "observed", checked: bool = True) -> DataFrame:
    """O-24: top n devices of the latest window by p95.

    basis "observed" (parity): rows whose observed window_end equals the
    table's maximum, newest row per device, by p95 desc. basis "window":
    the same on the true window end (``win_end``), what the API describes.
    Ties go to the smaller device id.
    """
    if checked:
        n = check_n(n)
    col = {"observed": "window_end", "window": "win_end"}[basis]
    latest = newest_per_device(_at_scalar_max(df, col))
    return (project(latest)
            .orderBy(F.col("percentile_95").desc(), F.col("device_id"))
            .limit(int(n)))


def top_at_latest_update(df: DataFrame, n: int, checked: bool = True) -> DataFrame:
    """O-25: rows at the newest last_updated, by p95 desc (no per-device
    step)."""
    if checked:
        n = check_n(n)
    return (project(_at_scalar_max(df, "last_updated"))
            .orderBy(F.col("percentile_95").desc(), F.col("device_id"),
                     F.col("window_end").desc(), F.col("window_start").desc())
            .limit(int(n)))


def newest_recent(df: DataFrame, n: int, span_ms: int = 60_000, checked: bool = True) -> DataFrame:
    """O-26: rows updated within ``span_ms`` of the newest update, newest
    per device (p95 breaks ties), first n in device order."""
    if checked:
        n = check_n(n)
    recent = _at_scalar_max(df, "last_updated", span_ms)
    newest = newest_per_device(recent, [F.col("last_updated"), F.col("percentile_95"),
                                        F.col("window_end"), F.col("event_id")])
    return project(newest).orderBy("device_id").limit(int(n))


def table_stats(df: DataFrame) -> DataFrame:
    """O-19 summary: rows, devices, p95 min/max/avg, newest update and the
    rows at it. One pass plus the scalar max."""
    top = df.agg(F.max("last_updated")).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("device_id").alias("device_count"),
        F.min("percentile_95").alias("min_p95"),
        F.max("percentile_95").alias("max_p95"),
        F.round(F.avg("percentile_95"), 6).alias("avg_p95"),
        F.max("last_updated").alias("max_last_updated"),
        F.sum(F.when(F.col("last_updated") == top, 1).otherwise(0)).alias("rows_at_max"))


def device_counts(df: DataFrame) -> DataFrame:
    """O-19: rows per device."""
    return df.groupBy("device_id").agg(F.count(F.lit(1)).alias("row_count"))


def device_list(df: DataFrame) -> DataFrame:
    """O-19: distinct devices, sorted."""
    return df.select("device_id").distinct().orderBy("device_id")


def count_for_device(df: DataFrame, device_id: str) -> DataFrame:
    """O-19: rows of one device."""
    return df.filter(F.col("device_id") == F.lit(device_id)).agg(
        F.count(F.lit(1)).alias("row_count"))


# --------------------------------------------------------------------------
# The same questions on a stored table, reading only the dates that can
# answer them.
# --------------------------------------------------------------------------

def stored_latest_for_device(table, device_id: str) -> DataFrame:
    """O-23 on a ``MetricsTable``."""
    check_device_id(device_id)
    return latest_for_device(table.scan_latest_of(device_id), device_id)


def stored_top_devices(table, n: int) -> DataFrame:
    """O-24 on a ``MetricsTable`` (basis: the observed window end)."""
    n = check_n(n)
    return top_devices(table.scan_newest("window_end"), n)


def stored_top_at_latest_update(table, n: int) -> DataFrame:
    """O-25 on a ``MetricsTable``."""
    n = check_n(n)
    return top_at_latest_update(table.scan_newest("last_updated"), n)


def stored_newest_recent(table, n: int, span_ms: int = 60_000) -> DataFrame:
    """O-26 on a ``MetricsTable``."""
    n = check_n(n)
    return newest_recent(table.scan_newest("last_updated", span_ms), n, span_ms)
