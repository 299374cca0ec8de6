"""Window results in the result-record shape (O-14..O-16, O-29 + ids).

``compute_results`` is the batch twin of the stream job: events in, one
result row per (device, window) out, with the six result fields plus the
true window bounds and the event count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import result_id
from ..functions.timeutil import clock_ms
from .windows import window_p95

# Defaults of the reference's stream job (the code, not its README).
DEFAULT_SIZE = "30 seconds"
DEFAULT_SLIDE = "5 seconds"

RESULT_COLUMNS = ["id", "device_id", "window_start", "window_end", "percentile_95",
                  "last_updated"]


def compute_results(events: DataFrame, size=DEFAULT_SIZE, slide=DEFAULT_SLIDE,
                    now_ms: int | None = None, replay_clock: bool = True,
                    method: str = "auto") -> DataFrame:
    """Result rows: id, device_id, window_start, window_end, percentile_95,
    last_updated, win_start, win_end, event_count.

    ``last_updated`` is the emission clock: ``now_ms`` if given, else the
    window's true end when ``replay_clock`` (deterministic replays and
    oracle runs), else the session's current time.
    """
    w = window_p95(events, size, slide, method=method)
    if now_ms is not None:
        clock = clock_ms(now_ms)
    elif replay_clock:
        clock = F.col("win_end")
    else:
        clock = clock_ms(None)
    return w.select(
        result_id(F.col("device_id"), F.col("win_start"), F.col("win_end"),
                  F.col("event_count")).alias("id"),
        "device_id", "window_start", "window_end", "percentile_95",
        clock.alias("last_updated"), "win_start", "win_end", "event_count")


def global_p95(events: DataFrame, now_ms: int | None = None) -> DataFrame:
    """O-14 + O-18 over all rows at once: one row, with the empty default
    (device "unknown", p95 0.0, times = clock: ``now_ms``, else the session's
    current time) when there is no row.

    The reference keeps the first event's device; a cluster has no "first",
    so the smallest device id is kept. Built on the histogram selection: no
    array of all values is ever formed.
    """
    from .quantile import exact_percentile

    ev = events.filter(F.col("device_id").isNotNull()).withColumn("_g", F.lit(1))
    # A global aggregate yields one row even for empty input.
    stats = ev.agg(F.count(F.lit(1)).alias("event_count"),
                   F.min("device_id").alias("_dev"),
                   F.min("timestamp").alias("_mn"),
                   F.max("timestamp").alias("_mx"),
                   F.lit(None).cast("double").alias("_p95"))
    pct = exact_percentile(ev, ["_g"], "cpu_usage", out="_p95").select(
        F.lit(None).cast("long").alias("event_count"), F.lit(None).cast("string").alias("_dev"),
        F.lit(None).cast("long").alias("_mn"), F.lit(None).cast("long").alias("_mx"), "_p95")
    # One row and at most one row: stacked and folded, no join needed.
    joined = stats.unionByName(pct).agg(*[F.max(c).alias(c) for c in stats.columns])
    empty = F.col("event_count") == 0
    clock = clock_ms(now_ms)
    return joined.select(
        F.when(empty, F.lit("unknown")).otherwise(F.col("_dev")).alias("device_id"),
        F.col("event_count"),
        F.when(empty, clock).otherwise(F.col("_mn")).alias("window_start"),
        F.when(empty, clock).otherwise(F.col("_mx")).alias("window_end"),
        F.when(empty, F.lit(0.0))
         .when(F.col("_p95").isNull(), F.lit(float("nan")))
         .otherwise(F.col("_p95")).alias("percentile_95"))
