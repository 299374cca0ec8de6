"""Keyed event-time windows with the exact p95 (O-14..O-18, O-29).

Window semantics are Spark's ``window()``: epoch-aligned, half-open
[start, start + size), a row belongs to every window that contains it
(size/slide windows for a sliding window, one for a tumbling window).

Batch plan ("hist", the default):

* Each row is assigned to a *pane* of width gcd(size, slide); every pane
  lies wholly inside the same set of windows. Rows are pre-aggregated per
  (key, pane, value) -> (count, min ts, max ts): the only shuffle of raw
  rows, with map-side combining, hashed on the value too so a hot device is
  spread over all tasks.
* Pane rows fan out to their windows (``sequence`` + ``explode``) and are
  re-aggregated per (key, window, value): the 6-fold expansion of a
  30 s / 5 s window happens on the compact pane histogram, not on raw rows.
* Counts and observed bounds come from that histogram; the percentile from
  the distributed rank selection in ``operators.quantile``.

"array" is the plain form (``collect_list`` per window), bounded only by the
size of the largest window; it is kept as a cross-check and for small
windows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.percentile import P95, max_rule_limit, p95_of_values
from .quantile import bucketed_histogram, histogram_windows, percentile_by_buckets, usable


WINDOW_COLUMNS = ["win_start", "win_end", "event_count", "window_start",
                  "window_end", "percentile_95"]


_UNIT_MS = {"ms": 1, "millisecond": 1, "milliseconds": 1,
            "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
            "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
            "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
            "d": 86_400_000, "day": 86_400_000, "days": 86_400_000}


def parse_duration_ms(d) -> int:
    """'30 seconds' / '5s' / '4 hours' / '1 day' / int ms -> ms."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", str(d))
    if not m or m.group(2).lower() not in _UNIT_MS:
        raise ValueError(f"cannot read duration {d!r}")
    return int(round(float(m.group(1)) * _UNIT_MS[m.group(2).lower()]))


def _floor_to(col, step: int):
    return col - F.pmod(col, F.lit(step))


def assign_windows(df: DataFrame, size_ms: int, slide_ms: int,
                   time: str = "timestamp") -> DataFrame:
    """Add ``win_start`` (one row per window a row belongs to). Plain form,
    the same window set as Spark's ``window()``."""
    t = F.col(time)
    last = _floor_to(t, slide_ms)
    n = -(-size_ms // slide_ms)
    starts = F.sequence(last - F.lit((n - 1) * slide_ms), last, F.lit(slide_ms))
    starts = F.filter(starts, lambda s: s + F.lit(size_ms) > t)
    return df.withColumn("win_start", F.explode(starts))


def _pane_histogram(df: DataFrame, keys: Sequence[str], value: str, time: str,
                    pane_ms: int) -> DataFrame:
    return (df.withColumn("_pane", _floor_to(F.col(time), pane_ms))
            .groupBy(*keys, "_pane", value).agg(F.count(F.lit(1)).alias("c")))


def window_stats(df: DataFrame, keys: Sequence[str], size_ms: int, slide_ms: int,
                 time: str = "timestamp") -> DataFrame:
    """O-15, O-16 per (keys, win_start): event_count and the observed bounds.

    Pre-aggregated per pane first, so the shuffle carries one row per
    (key, pane) however many events a pane holds."""
    pane_ms = math.gcd(size_ms, slide_ms)
    ps = (df.withColumn("_pane", _floor_to(F.col(time), pane_ms))
          .groupBy(*keys, "_pane")
          .agg(F.count(F.lit(1)).alias("c"), F.min(time).alias("mn"), F.max(time).alias("mx")))
    if pane_ms == size_ms:
        return ps.select(*keys, F.col("_pane").alias("win_start"), F.col("c").alias("event_count"),
                         F.col("mn").alias("window_start"), F.col("mx").alias("window_end"))
    return (fan_out(ps, size_ms, slide_ms, pane_ms)
            .groupBy(*keys, "win_start")
            .agg(F.sum("c").alias("event_count"), F.min("mn").alias("window_start"),
                 F.max("mx").alias("window_end")))


def fan_out(ph: DataFrame, size_ms: int, slide_ms: int, pane_ms: int) -> DataFrame:
    """Explode each pane to the window starts s with s <= pane and
    s + size >= pane + pane_ms."""
    pane = F.col("_pane")
    last = _floor_to(pane, slide_ms)
    lo = pane + F.lit(pane_ms - size_ms)
    first = lo + F.pmod(-lo, F.lit(slide_ms))
    return ph.withColumn("win_start", F.explode(F.sequence(first, last, F.lit(slide_ms))))


def window_p95(events: DataFrame, size, slide=None, keys: Sequence[str] = ("device_id",),
               value: str = "cpu_usage", time: str = "timestamp", p: float = P95,
               method: str = "auto", drop_null_keys: bool = True) -> DataFrame:
    """Per key and window: win_start, win_end (true bounds, ms), event_count,
    window_start / window_end (observed min / max event time, ms) and
    percentile_95.

    ``events`` needs the key columns, ``value`` (double) and ``time`` (epoch
    ms). Rows with a null key are dropped first (O-07).

    ``method``: "hist" (skew-safe histogram selection for every window),
    "array" (one list per window), "max" (only valid when no window holds
    more rows than the percentile rule returns the maximum for: 19 at
    p = 0.95) or "auto": one plan in which each window takes the way that
    its own size calls for, its maximum up to that many rows and the
    histogram selection beyond. Planning runs no job, and one large window
    changes nothing for the others. -0.0 counts as 0.0.
    """
    size_ms = parse_duration_ms(size)
    slide_ms = size_ms if slide is None else parse_duration_ms(slide)
    if size_ms <= 0 or slide_ms <= 0:
        raise ValueError("window size and slide must be positive")
    keys = list(keys)
    df = events
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    df = df.withColumn(value, F.col(value) + F.lit(0.0))
    if method == "max":
        return _window_p95_max(df, size_ms, slide_ms, keys, value, time)
    if method == "array":
        return _window_p95_array(df, size_ms, slide_ms, keys, value, time, p)
    pane_ms = math.gcd(size_ms, slide_ms)
    if method == "auto":
        return _window_p95_by_size(df, keys, value, time, size_ms, slide_ms, pane_ms, p)
    if method != "hist":
        raise ValueError(f"unknown method {method!r}")
    # Value histogram per (key, pane, value): the one shuffle of raw rows.
    ph = _pane_histogram(df, keys, value, time, pane_ms)
    stats = window_stats(df, keys, size_ms, slide_ms, time)
    return _from_pane_histogram(ph, stats, keys, value, size_ms, slide_ms, pane_ms, p)


def rows_of_large(df: DataFrame, keys: Sequence[str], time: str, size_ms: int, count, p: float = P95) -> DataFrame:
    """The rows that a window of more rows than the maximum rule allows can
    hold. A window lies in two neighbouring tiles of its size at most, so one
    of them has more than half as many; rows go on with their tile where it
    or a neighbour has. Large windows keep all their rows, others perhaps
    some. Done before rows fan out, where they are fewest."""
    tile = _floor_to(F.col(time), size_ms)
    dense = (df.groupBy(*keys, tile.alias("_tile")).agg(count.alias("_n"))
             .filter(F.col("_n") * 2 > F.lit(max_rule_limit(p))))
    near = dense.select(*keys, F.explode(F.array(*[F.col("_tile") + F.lit(k * size_ms) for k in (-1, 0, 1)]))
                        .alias("_tile")).distinct()
    return df.withColumn("_tile", tile).join(near, on=[*keys, "_tile"], how="left_semi").drop("_tile")


def _window_p95_by_size(df, keys, value, time, size_ms, slide_ms, pane_ms, p) -> DataFrame:
    """Windows of few rows take their maximum; the rest select ranks from
    the pane histogram of the rows that can be in such a window."""
    gkeys = list(keys) + ["win_start"]
    every = _window_p95_max(df, size_ms, slide_ms, keys, value, time)
    dense = rows_of_large(df, keys, time, size_ms, F.count(F.lit(1)), p)
    rows = _fanned(_pane_histogram(dense, keys, value, time, pane_ms), size_ms, slide_ms, pane_ms)
    pct = percentile_by_buckets(bucketed_histogram(rows, gkeys, value, "c"), gkeys, value, p, "_p95")
    large = F.col("event_count") > F.lit(max_rule_limit(p))
    return (every.join(pct.select(*gkeys, "_p95"), on=gkeys, how="left")
            .withColumn("percentile_95", F.when(large, F.coalesce("_p95", "percentile_95"))
                        .otherwise(F.col("percentile_95"))).drop("_p95")
            .select(*every.columns))


def _fanned(panes: DataFrame, size_ms: int, slide_ms: int, pane_ms: int) -> DataFrame:
    """Pane rows as rows of their windows."""
    if pane_ms == size_ms:
        return panes.withColumnRenamed("_pane", "win_start")
    return fan_out(panes, size_ms, slide_ms, pane_ms).drop("_pane")


def windows_of_panes(panes: DataFrame, size_ms: int, slide_ms: int, pane_ms: int, keys: Sequence[str],
                     value: str = "cpu_usage", p: float = P95, where=None, touched: str | None = None,
                     always=None) -> DataFrame:
    """Windows of a pane histogram (keys, _pane, value, c, mn, mx; rows may
    repeat a value), each by its own size as in ``window_p95``: event_count,
    window_start, window_end, n and percentile_95 by keys and win_start.

    ``where``: a condition on win_start that windows must meet. ``touched``:
    a boolean column of the panes; only windows over a row that has it are
    told, and those whose win_start meets ``always``. Panes fan out once, and
    once more those that a large window can hold."""
    gkeys = [*keys, "win_start"]

    def rows(df):
        df = _fanned(df, size_ms, slide_ms, pane_ms)
        return df if where is None else df.filter(where)

    every = histogram_windows(rows(panes), gkeys, value, p=p, method="max", touched=touched)
    if touched is not None:
        every = every.filter(F.col(touched) if always is None else F.col(touched) | always).drop(touched)
    dense = rows_of_large(panes.select(*keys, "_pane", value, "c"), keys, "_pane", size_ms, F.sum("c"), p)
    pct = percentile_by_buckets(bucketed_histogram(rows(dense), gkeys, value, "c"), gkeys, value, p, "_p")
    large = F.col("n") > F.lit(max_rule_limit(p))
    return (every.join(pct.select(*gkeys, "_p"), on=gkeys, how="left")
            .withColumn("percentile_95", F.when(large, F.coalesce("_p", "percentile_95"))
                        .otherwise(F.col("percentile_95")))
            .select(*every.columns))


def _from_pane_histogram(ph: DataFrame, stats: DataFrame, keys, value, size_ms, slide_ms,
                         pane_ms, p) -> DataFrame:
    gkeys = list(keys) + ["win_start"]
    if pane_ms == size_ms:
        rows = ph.withColumnRenamed("_pane", "win_start")
    else:
        # Panes fan out to windows; the one exchange on (key, window,
        # bucket) serves the bucket counts and the rank selection.
        rows = fan_out(ph, size_ms, slide_ms, pane_ms)
    pct = percentile_by_buckets(bucketed_histogram(rows, gkeys, value, "c"), gkeys, value, p,
                                "_p95")
    res = stats.join(pct, on=gkeys, how="left")
    # A window with no usable value (only NaN) gets NaN; a single NaN value
    # is returned as is, which is the same NaN.
    p95 = F.when(F.col("n") > 0, F.col("_p95")).otherwise(F.lit(float("nan")))
    return res.select(*keys, "win_start",
                      (F.col("win_start") + F.lit(size_ms)).alias("win_end"),
                      "event_count", "window_start", "window_end",
                      p95.alias("percentile_95"))


def pane_partials(events: DataFrame, pane, keys: Sequence[str] = ("device_id",),
                  value: str = "cpu_usage", time: str = "timestamp") -> DataFrame:
    """O-17 partial aggregates: per (keys, pane start, value) the count and
    the first / last event time. Partials of disjoint inputs merge by plain
    union; any window whose size and slide are multiples of the pane can be
    rolled up from them (``windows_from_partials``) without the raw rows."""
    pane_ms = parse_duration_ms(pane)
    keys = list(keys)
    return (events.filter(F.col(keys[0]).isNotNull())
            .withColumn("pane_start", _floor_to(F.col(time), pane_ms))
            .groupBy(*keys, "pane_start", value)
            .agg(F.count(F.lit(1)).alias("c"), F.min(time).alias("mn"), F.max(time).alias("mx")))


def windows_from_partials(partials: DataFrame, size, slide=None, pane=None,
                          keys: Sequence[str] = ("device_id",), value: str = "cpu_usage",
                          p: float = P95, method: str = "auto", touched: str | None = None) -> DataFrame:
    """O-17 merge: roll pane partials (possibly from several sources or
    batches, unioned) up to windows; same output as ``window_p95``.

    ``method`` as in ``operators.quantile.histogram_windows``; ``touched`` as
    in ``windows_of_panes``."""
    size_ms = parse_duration_ms(size)
    slide_ms = size_ms if slide is None else parse_duration_ms(slide)
    pane_ms = math.gcd(size_ms, slide_ms) if pane is None else parse_duration_ms(pane)
    if size_ms % pane_ms or slide_ms % pane_ms:
        raise ValueError("window size and slide must be multiples of the pane")
    keys = list(keys)
    pp = partials.withColumnRenamed("pane_start", "_pane")
    if method == "auto":
        res = windows_of_panes(pp, size_ms, slide_ms, pane_ms, keys, value, p, touched=touched)
    elif touched is not None:
        raise ValueError("touched windows are told by method 'auto'")
    else:
        res = histogram_windows(_fanned(pp, size_ms, slide_ms, pane_ms), keys + ["win_start"], value, "c", "mn", "mx",
                                p, method)
    return res.select(*keys, "win_start", (F.col("win_start") + F.lit(size_ms)).alias("win_end"),
                      "event_count", "window_start", "window_end", "percentile_95")


def _window_p95_array(df, size_ms, slide_ms, keys, value, time, p):
    w = assign_windows(df, size_ms, slide_ms, time)
    agg = (w.groupBy(*keys, "win_start")
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.min(time).alias("window_start"),
                F.max(time).alias("window_end"),
                F.collect_list(value).alias("_vals")))
    return agg.select(*keys, "win_start",
                      (F.col("win_start") + F.lit(size_ms)).alias("win_end"),
                      "event_count", "window_start", "window_end",
                      # a window always has events; with no usable value it is NaN
                      F.when(F.size("_vals") == 0, F.lit(float("nan")))
                      .otherwise(p95_of_values(F.col("_vals"), p)).alias("percentile_95"))


def _window_p95_max(df, size_ms, slide_ms, keys, value, time):
    """Every window holds few enough rows that the percentile is the
    largest usable value: one hash aggregate, no lists."""
    v = F.col(value)
    w = assign_windows(df, size_ms, slide_ms, time)
    agg = (w.groupBy(*keys, "win_start")
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.min(time).alias("window_start"),
                F.max(time).alias("window_end"),
                F.max(F.when(usable(v), v)).alias("_top")))
    return agg.select(*keys, "win_start",
                      (F.col("win_start") + F.lit(size_ms)).alias("win_end"),
                      "event_count", "window_start", "window_end",
                      F.coalesce(F.col("_top"), F.lit(float("nan"))).alias("percentile_95"))
