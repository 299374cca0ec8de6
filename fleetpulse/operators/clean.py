"""Event filter, result -> table-row mapping and metric validation
(O-07, O-09, O-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import ms_to_ts

# Rejection reasons, in the order the rules are applied.
REASON_NULL = "null_metric"
REASON_DEVICE = "invalid_device_id"
REASON_TIMES = "invalid_window_times"
REASON_RANGE = "invalid_window_range"
REASON_P95 = "invalid_percentile"
REASON_UPDATED = "invalid_last_updated"
REASONS = [REASON_NULL, REASON_DEVICE, REASON_TIMES, REASON_RANGE, REASON_P95, REASON_UPDATED]

# What the table itself refuses, whatever was validated before.
REASON_RECORD = "undecodable_record"
REASON_NO_ID = "null_event_id"
REASON_NO_DEVICE = "null_device_id"
REASON_LONG_ID = "event_id_too_long"
REASON_LONG_DEVICE = "device_id_too_long"
MAX_TEXT = 255

METRIC_FIELDS = ["event_id", "device_id", "window_start", "window_end", "percentile_95",
                 "last_updated"]


def valid_events(df: DataFrame) -> DataFrame:
    """O-07: drop events without a device. A blank device passes here (it is
    only stopped by the writer's validation)."""
    return df.filter(F.col("device_id").isNotNull())


def to_metric_rows(results: DataFrame, created_at=None, keep=()) -> DataFrame:
    """O-09: result rows -> metrics-table rows (``id`` becomes ``event_id``,
    ``created_at`` stamped, ``window_date`` derived for partitioning);
    ``keep`` carries extra result columns along."""
    created = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return results.select(*keep,
        F.col("id").alias("event_id"), "device_id", "window_start", "window_end",
        "percentile_95", "last_updated",
        created.alias("created_at"),
        F.to_date(ms_to_ts(F.col("window_start"))).alias("window_date"))


def reject_reason(df: DataFrame):
    """The first failing rule's reason, or null when the metric is valid. A
    device of blanks and control characters up to U+0020 is blank; NaN is
    neither under 0 nor over 100 and passes, as in the reference."""
    cols = [F.col(c) for c in METRIC_FIELDS if c in df.columns]
    all_null = F.lit(True)
    for c in cols:
        all_null = all_null & c.isNull()
    dev = F.col("device_id")
    ws, we = F.coalesce(F.col("window_start"), F.lit(0)), F.coalesce(F.col("window_end"), F.lit(0))
    p95 = F.col("percentile_95")
    lu = F.coalesce(F.col("last_updated"), F.lit(0))
    return (F.when(all_null, F.lit(REASON_NULL))
            .when(dev.isNull() | dev.rlike(r"^[\x00-\x20]*$"), F.lit(REASON_DEVICE))
            .when((ws <= 0) | (we <= 0), F.lit(REASON_TIMES))
            .when(ws >= we, F.lit(REASON_RANGE))
            .when(p95.isNull() | (~F.isnan(p95) & ((p95 < 0) | (p95 > 100))), F.lit(REASON_P95))
            .when(lu <= 0, F.lit(REASON_UPDATED)))


def validate_metrics(df: DataFrame) -> DataFrame:
    """O-10: add ``reject_reason`` (null = valid)."""
    return df.withColumn("reject_reason", reject_reason(df))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    v = validate_metrics(df)
    return (v.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            v.filter(F.col("reject_reason").isNotNull()))


def constraint_reason(df: DataFrame):
    """Why the table would refuse a row, or null: ids and devices are not
    null and hold at most 255 characters."""
    return (F.when(F.col("event_id").isNull(), F.lit(REASON_NO_ID))
            .when(F.col("device_id").isNull(), F.lit(REASON_NO_DEVICE))
            .when(F.char_length("event_id") > MAX_TEXT, F.lit(REASON_LONG_ID))
            .when(F.char_length("device_id") > MAX_TEXT, F.lit(REASON_LONG_DEVICE)))


def split_storable(df: DataFrame, validate: str = "none") -> tuple[DataFrame, DataFrame]:
    """(rows the table takes, the others with their ``reject_reason``). A row
    that cannot be decoded or stored never holds up the rest of its batch;
    "strict" applies the validation rules (O-10) before the constraints."""
    if validate not in ("none", "strict"):
        raise ValueError(f"unknown validation {validate!r}")
    reason = constraint_reason(df)
    if validate == "strict":
        reason = F.coalesce(reject_reason(df), reason)
    if "record" in df.columns:
        reason = F.when(F.col("record").isNotNull(), F.lit(REASON_RECORD)).otherwise(reason)
    marked = df.withColumn("reject_reason", reason)
    return (marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            marked.filter(F.col("reject_reason").isNotNull()))
