"""The registered queries (one per operator group of the inventory) and the
equivalent DuckDB SQL each is checked against.

Every query reads the driver's tables in full. Base binding: ``events`` as
device = user_id, windows of 1 day sliding by 4 hours (the same 6-fold
overlap as the reference's 30 s / 5 s, with enough rows per window to
matter), emission clock = true window end, id = sha256 of
device|win_start|win_end|event_count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bands, late
from ..operators.clean import to_metric_rows, validate_metrics
from ..operators.results import compute_results, global_p95
from ..operators.windows import pane_partials, windows_from_partials
from ..functions.timeutil import as_instants, ingest_lag
from ..sources import codec
from ..sources.events import load_events
from ..sources.store import apply_append, duplicate_ids
from . import metrics as M

# Fixed values used by the registered queries.
DAY_MS = 86_400_000
SLIDE_4H_MS = 14_400_000
FIXED_NOW_MS = 1_706_745_600_000          # 2024-02-01T00:00:00Z
FIXED_CREATED = "2024-02-01 00:00:00"
LOOKUP_DEVICE = "7"
TOP_N = 10
ARRIVAL_PRIME = 7919
ARRIVAL_SPREAD = 50
ARRIVAL_CHUNKS = 8
REFIRE_BATCHES = 4
REFIRE_SPREAD = 400         # late by up to about a day and a half on the smallest table
ACCOUNT_MS = 600_000


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _events(spark, sf, device="user_id", keep=()):
    return load_events(spark, sf, device=device, keep=keep)


def _results(spark, sf, size=DAY_MS, slide=SLIDE_4H_MS, device="user_id"):
    return compute_results(_events(spark, sf, device), size, slide)


def _metric_rows(spark, sf, size=DAY_MS, slide=SLIDE_4H_MS):
    return to_metric_rows(_results(spark, sf, size, slide), created_at=FIXED_CREATED)


def _table(spark, sf):
    """The metrics table the read queries run on (1 day / 4 h windows)."""
    return _metric_rows(spark, sf).drop("created_at")


def _as_text_date(df):
    """DATE travels as ISO text so both engines print it alike."""
    return df.withColumn("window_date", F.col("window_date").cast("string"))


def _with_window_end(spark, sf):
    return to_metric_rows(_results(spark, sf), created_at=FIXED_CREATED, keep=("win_end",))


def _altered(df):
    return (df.withColumn("percentile_95", F.col("percentile_95") + F.lit(1.0))
            .withColumn("last_updated", F.col("last_updated") + F.lit(1)))


def q_idempotent_append(spark, sf):
    existing = _metric_rows(spark, sf).drop("created_at")
    fresh = _metric_rows(spark, sf, 30_000, 5_000).drop("created_at")
    # The batch repeats every stored id with other values (must be ignored),
    # and brings new windows twice (the earlier copy wins).
    batch = _altered(existing).unionByName(fresh).unionByName(
        _altered(fresh).withColumn("percentile_95", F.col("percentile_95") + F.lit(1.0)))
    return _as_text_date(apply_append(existing, batch))


def q_json_round_trip_clean(spark, sf):
    ev = _events(spark, sf, keep=("event_id", "event_type"))
    wire = ev.select("event_id", F.to_json(F.struct(
        F.col("device_id").alias("deviceId"), F.col("timestamp").alias("timestamp"),
        # error events travel without a cpuUsage field: it must decode as 0.0
        F.when(F.col("event_type") != "error", F.col("cpu_usage")).alias("cpuUsage"),
        # an unknown field is ignored
        F.col("event_type").alias("eventType"))).alias("value"))
    return codec.decode_events(wire, "value", keep=("event_id",)).drop("_corrupt")


def q_late_events(spark, sf):
    ev = _events(spark, sf, keep=("event_id",))
    arrival = F.col("event_id") + F.pmod(F.col("event_id") * F.lit(ARRIVAL_PRIME),
                                         F.lit(ARRIVAL_SPREAD))
    ev = ev.withColumn("arrival", arrival)
    return late.late_events(ev, "arrival", "event_id").select(
        "event_id", "device_id", "timestamp", "arrival", "max_before", "message")


def q_stream_refire(spark, sf):
    from ..streaming.replay import refire_replay

    return refire_replay(spark, sf, DAY_MS, SLIDE_4H_MS, lateness=DAY_MS, batches=REFIRE_BATCHES,
                         prime=ARRIVAL_PRIME, spread=REFIRE_SPREAD)


def q_stream_quarantine(spark, sf):
    from ..streaming.replay import quarantine_replay

    return quarantine_replay(spark, sf, chunks=ARRIVAL_CHUNKS).select(
        "event_id", "device_id", "timestamp", "arrival", "message", "batch_id")


def q_stream_row_accounting(spark, sf):
    """Every event is in the windows or in the quarantine: rows by where they
    went, per device (windows of one slide, so that a row is in one)."""
    from ..streaming.replay import job_replay

    out = job_replay(spark, sf, ACCOUNT_MS, ACCOUNT_MS, lateness=0, batches=REFIRE_BATCHES,
                     prime=ARRIVAL_PRIME, spread=REFIRE_SPREAD)
    last = out["outbox"].groupBy("device_id", "win_start").agg(F.max("event_count").alias("n"))
    counted = last.groupBy("device_id").agg(F.sum("n").alias("in_windows"))
    late = out["quarantine"].groupBy("device_id").agg(F.count(F.lit(1)).alias("in_quarantine"))
    total = _events(spark, sf).groupBy("device_id").agg(F.count(F.lit(1)).alias("events"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return total.join(counted, "device_id", "left").join(late, "device_id", "left").select(
        "device_id", "events", zero("in_windows"), zero("in_quarantine"))


def q_writer_stream(spark, sf):
    """Result records through the writer, twice: some without an id, some
    that are not JSON, some with a device too long for the table. What is
    stored and what is kept apart, by reason."""
    from ..streaming.replay import writer_replay

    res = _results(spark, sf)
    kind = F.pmod(F.col("win_start") / SLIDE_4H_MS + F.length("device_id"), F.lit(7)).cast("int")
    res = res.withColumn("kind", kind).withColumn("id", F.when(F.col("kind") != 1, F.col("id"))).withColumn(
        "device_id", F.when(F.col("kind") == 3, F.repeat("device_id", 256)).otherwise(F.col("device_id")))
    wire = codec.encode_results(res, keep=("kind",))
    records = wire.select(F.when(F.col("kind") == 2, F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value"))
                          .alias("value"))
    table, rejects = writer_replay(spark, records, 8)
    stored = table.scan().select(F.lit("stored").alias("reason"), "device_id", "percentile_95")
    apart = rejects.select(F.col("reject_reason").alias("reason"),
                           F.when(F.col("reject_reason") == "null_event_id", F.col("device_id")).alias("device_id"),
                           F.when(F.col("reject_reason") == "null_event_id", F.col("percentile_95")).alias("percentile_95"))
    return stored.unionByName(apart).groupBy("reason", "device_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("percentile_95").alias("max_p95"))


def _stored(spark, sf):
    """A stored table of the 1 day / 4 h windows, appended in three parts, the
    second of them twice."""
    from ..session import shared_path
    from ..sources.store import MetricsTable

    table = MetricsTable(spark, shared_path(spark, "stored"), id_scope="date")
    rows = _metric_rows(spark, sf).persist()
    part = F.pmod(F.datediff(F.col("window_date"), F.lit("2024-01-01").cast("date")), F.lit(3))
    for k in (0, 1, 1, 2):
        table.append(rows.filter(part == k))
    rows.unpersist()
    return table


def q_stored_unique_ids(spark, sf):
    """Ids are unique over the whole table: a batch that repeats every second
    stored id on another date and with other values adds its new ids only."""
    from ..session import shared_path
    from ..sources.store import MetricsTable

    table = MetricsTable(spark, shared_path(spark, "unique"), id_scope="table")
    rows = _metric_rows(spark, sf).persist()
    half = F.pmod(F.col("last_updated") / SLIDE_4H_MS, F.lit(2)) == 0
    table.append(rows.filter(half))
    moved = F.when(half, F.date_add("window_date", 400)).otherwise(F.col("window_date"))
    table.append(rows.withColumn("percentile_95", F.col("percentile_95") + F.lit(1.0)).withColumn("window_date", moved))
    rows.unpersist()
    return _as_text_date(table.scan().drop("created_at"))


def q_stored_partials(spark, sf):
    """Windows kept up to date from stored partials: three batches in order of
    arrival, the second written twice, the first two folded before the third."""
    from ..session import shared_path
    from ..sources.partials import WindowStore

    store = WindowStore(spark, shared_path(spark, "partials"), DAY_MS, SLIDE_4H_MS)
    ev = _events(spark, sf, keep=("event_id",))
    part = F.pmod(F.col("event_id") * F.lit(ARRIVAL_PRIME), F.lit(3))
    for k in (0, 1, 1):
        store.append(ev.filter(part == k), k)
    store.fold(1)
    store.append(ev.filter(part == 2), 2)
    return store.windows()


def q_stored_table(spark, sf):
    return _as_text_date(_stored(spark, sf).scan().drop("created_at"))


def q_stream_append(spark, sf):
    from ..streaming.replay import stream_metrics_once

    return _as_text_date(stream_metrics_once(spark, sf, DAY_MS, SLIDE_4H_MS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p95_sliding_1d_4h": lambda s, d: _results(s, d),
    "p95_sliding_30s_5s": lambda s, d: _results(s, d, 30_000, 5_000),
    "p95_by_event_type_sliding": lambda s, d: _results(s, d, device="event_type"),
    "p95_by_event_type_tumbling_1d": lambda s, d: _results(s, d, DAY_MS, DAY_MS, "event_type"),
    "p95_tumbling_1d": lambda s, d: _results(s, d, DAY_MS, DAY_MS),
    "p95_global": lambda s, d: global_p95(_events(s, d), FIXED_NOW_MS),
    "p95_empty_default": lambda s, d: global_p95(
        _events(s, d).filter(F.col("cpu_usage") < 0), FIXED_NOW_MS),
    "p95_from_panes": lambda s, d: windows_from_partials(
        pane_partials(_events(s, d), SLIDE_4H_MS), DAY_MS, SLIDE_4H_MS),
    "json_round_trip": q_json_round_trip_clean,
    "ingest_lag": lambda s, d: ingest_lag(_events(s, d, keep=("event_id",)), FIXED_NOW_MS)
    .select("event_id", "device_id", "timestamp", "lag_ms"),
    "result_json_round_trip": lambda s, d: codec.decode_results(codec.encode_results(
        compute_results(_events(s, d), "1 day", "4 hours"))),
    "instant_views": lambda s, d: as_instants(_table(s, d).select(
        "event_id", "window_start", "window_end", "last_updated")).select(
        "event_id", *[F.unix_micros(f"{c}_ts").alias(f"{c}_us")
                      for c in ("window_start", "window_end", "last_updated")]),
    "metric_rows": lambda s, d: _as_text_date(_table(s, d)),
    "metrics_rejected_by_reason": lambda s, d: validate_metrics(_table(s, d)).groupBy(
        F.coalesce("reject_reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")),
    "table_stats": lambda s, d: M.table_stats(_table(s, d)),
    "device_counts": lambda s, d: M.device_counts(_table(s, d)),
    "device_list": lambda s, d: M.device_list(_table(s, d)),
    "newest_per_device": lambda s, d: M.newest_per_device(_table(s, d)).select(
        "device_id", "event_id", "percentile_95", "window_start", "window_end", "last_updated"),
    "idempotent_append": q_idempotent_append,
    "duplicate_event_ids": lambda s, d: duplicate_ids(
        _table(s, d).unionByName(_altered(_table(s, d)))),
    "latest_for_device": lambda s, d: M.latest_for_device(_table(s, d), LOOKUP_DEVICE),
    "top_devices_observed": lambda s, d: M.top_devices(_table(s, d), TOP_N),
    "top_devices_window": lambda s, d: M.top_devices(_with_window_end(s, d), TOP_N,
                                                     basis="window"),
    "top_at_latest_update": lambda s, d: M.top_at_latest_update(_table(s, d), TOP_N),
    "newest_last_60s": lambda s, d: M.newest_recent(_table(s, d), TOP_N, span_ms=DAY_MS),
    "late_events": q_late_events,
    "high_usage": lambda s, d: bands.flag_high_usage(_table(s, d)).select(
        "event_id", "device_id", "percentile_95", "high_usage"),
    "usage_bands": lambda s, d: bands.usage_bands(_events(s, d)),
    "usage_bands_test": lambda s, d: bands.usage_bands(_events(s, d), bands.TEST_BANDS),
    "stream_append_matches_batch": q_stream_append,
    "stream_refire_revisions": q_stream_refire,
    "stream_row_accounting": q_stream_row_accounting,
    "writer_stream": q_writer_stream,
    "stored_table": q_stored_table,
    "stored_unique_ids": q_stored_unique_ids,
    "stored_partials": q_stored_partials,
    "stored_latest_for_device": lambda s, d: M.stored_latest_for_device(_stored(s, d), LOOKUP_DEVICE),
    "stored_top_devices": lambda s, d: M.stored_top_devices(_stored(s, d), TOP_N),
    "stored_newest": lambda s, d: M.stored_newest_recent(_stored(s, d), TOP_N, span_ms=DAY_MS),
    "stream_late_quarantine": q_stream_quarantine,
}


# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

def _ev_sql(device="user_id"):
    return (f"SELECT event_id, CAST({device} AS VARCHAR) AS device_id, "
            f"epoch_us(ts) // 1000 AS t, value AS v, event_type FROM events "
            f"WHERE {device} IS NOT NULL")


def _windows_sql(size, slide, device="user_id", sfx=""):
    """Per (device, window): counts, observed bounds and the legacy p95
    (CTE ``win{sfx}``)."""
    k = size // slide
    return f"""
    ev{sfx} AS ({_ev_sql(device)}),
    w{sfx} AS (SELECT device_id, t, v, (t - t % {slide}) - k.k * {slide} AS win_start
          FROM ev{sfx}, range(0, {k}) AS k(k)),
    g{sfx} AS (SELECT device_id, win_start, count(*) AS event_count, min(t) AS window_start,
                 max(t) AS window_end, list_sort(list(v)) AS xs
          FROM w{sfx} GROUP BY device_id, win_start),
    q{sfx} AS (SELECT *, len(xs) AS n, 0.95::DOUBLE * (len(xs) + 1) AS pos FROM g{sfx}),
    win{sfx} AS (SELECT device_id, win_start, win_start + {size} AS win_end, event_count,
                   window_start, window_end,
                   CASE WHEN pos < 1 THEN xs[1] WHEN pos >= n THEN xs[n]
                        ELSE xs[floor(pos)::BIGINT] + (pos - floor(pos))
                             * (xs[floor(pos)::BIGINT + 1] - xs[floor(pos)::BIGINT]) END
                     AS percentile_95
            FROM q{sfx})"""


def _results_sql(size=DAY_MS, slide=SLIDE_4H_MS, device="user_id", sfx=""):
    return f"""{_windows_sql(size, slide, device, sfx)},
    res{sfx} AS (SELECT sha256(concat_ws('|', device_id, win_start, win_end, event_count)) AS id,
                   device_id, window_start, window_end, percentile_95,
                   win_end AS last_updated, win_start, win_end, event_count FROM win{sfx})"""


_RES_COLS = ("id, device_id, window_start, window_end, percentile_95, last_updated, "
             "win_start, win_end, event_count")


def _table_sql(size=DAY_MS, slide=SLIDE_4H_MS, name="m", sfx=""):
    """WITH-list ending in a metrics table CTE called ``name``."""
    return f"""{_results_sql(size, slide, sfx=sfx)},
    {name} AS (SELECT id AS event_id, device_id, window_start, window_end, percentile_95,
                   last_updated, CAST(make_timestamp(window_start * 1000) AS DATE) AS window_date,
                   win_end
            FROM res{sfx})"""


_M_COLS = ("event_id, device_id, window_start, window_end, percentile_95, last_updated, "
           "CAST(window_date AS VARCHAR) AS window_date")


def _global_sql(where=""):
    return f"""WITH ev AS ({_ev_sql()}), f AS (SELECT * FROM ev {where}),
    g AS (SELECT count(*) AS event_count, min(device_id) AS dev, min(t) AS mn, max(t) AS mx,
                 list_sort(list(v)) AS xs FROM f),
    q AS (SELECT *, len(xs) AS n, 0.95::DOUBLE * (len(xs) + 1) AS pos FROM g)
    SELECT CASE WHEN event_count = 0 THEN 'unknown' ELSE dev END AS device_id, event_count,
           CASE WHEN event_count = 0 THEN {FIXED_NOW_MS} ELSE mn END AS window_start,
           CASE WHEN event_count = 0 THEN {FIXED_NOW_MS} ELSE mx END AS window_end,
           CASE WHEN event_count = 0 THEN 0.0 WHEN pos < 1 THEN xs[1] WHEN pos >= n THEN xs[n]
                ELSE xs[floor(pos)::BIGINT] + (pos - floor(pos))
                     * (xs[floor(pos)::BIGINT + 1] - xs[floor(pos)::BIGINT]) END AS percentile_95
    FROM q"""


def _bands_sql(cuts):
    whens = [f"WHEN v < {cuts[0]} THEN 'below'"]
    for lo, hi in zip(cuts[:-2], cuts[1:-1]):
        whens.append(f"WHEN v < {hi} THEN '{lo:g}-{hi:g}'")
    whens.append(f"WHEN v <= {cuts[-1]} THEN '{cuts[-2]:g}-{cuts[-1]:g}'")
    case = "CASE " + " ".join(whens) + " ELSE 'above' END"
    return f"""WITH ev AS ({_ev_sql()})
    SELECT {case} AS band, count(*) AS rows, min(v) AS min_value, max(v) AS max_value
    FROM ev WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1"""


def _newest_sql(src, order):
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id "
            f"ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1)")


def oracle_sql() -> dict[str, str]:
    last_order = "last_updated DESC, window_end DESC, event_id DESC"
    alter = ("SELECT event_id, device_id, window_start, window_end, percentile_95 + 1.0 AS "
             "percentile_95, last_updated + 1 AS last_updated, window_date FROM")
    arrival = f"event_id + ((event_id * {ARRIVAL_PRIME}) % {ARRIVAL_SPREAD})"
    spread_arrival = f"event_id + ((event_id * {ARRIVAL_PRIME}) % {REFIRE_SPREAD})"
    batches = f"""b AS (SELECT min(arrival) AS lo, (max(arrival) - min(arrival)) // {REFIRE_BATCHES} + 1 AS step FROM a),
            c AS (SELECT a.*, (arrival - lo) // step AS batch_id FROM a, b),
            mx AS (SELECT batch_id, max(t) AS top FROM c GROUP BY batch_id),
            pm AS (SELECT batch_id, max(top) OVER (ORDER BY batch_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM mx),
            pm2 AS (SELECT batch_id, max(top) OVER (ORDER BY batch_id) AS now FROM mx)"""
    sql = {
        "p95_sliding_1d_4h": f"WITH {_results_sql()} SELECT {_RES_COLS} FROM res",
        "p95_sliding_30s_5s": f"WITH {_results_sql(30_000, 5_000)} SELECT {_RES_COLS} FROM res",
        "p95_by_event_type_sliding":
            f"WITH {_results_sql(device='event_type')} SELECT {_RES_COLS} FROM res",
        "p95_by_event_type_tumbling_1d":
            f"WITH {_results_sql(DAY_MS, DAY_MS, 'event_type')} SELECT {_RES_COLS} FROM res",
        "p95_tumbling_1d": f"WITH {_results_sql(DAY_MS, DAY_MS)} SELECT {_RES_COLS} FROM res",
        "p95_global": _global_sql(),
        "p95_empty_default": _global_sql("WHERE v < 0"),
        "p95_from_panes": f"""WITH {_windows_sql(DAY_MS, SLIDE_4H_MS)}
            SELECT device_id, win_start, win_end, event_count, window_start, window_end,
                   percentile_95 FROM win""",
        "json_round_trip": f"""WITH ev AS ({_ev_sql()})
            SELECT event_id, device_id, t AS timestamp,
                   CASE WHEN event_type = 'error' THEN 0.0 ELSE v END AS cpu_usage FROM ev""",
        "ingest_lag": f"""WITH ev AS ({_ev_sql()})
            SELECT event_id, device_id, t AS timestamp, {FIXED_NOW_MS} - t AS lag_ms FROM ev""",
        "result_json_round_trip": f"""WITH {_table_sql()}
            SELECT event_id AS id, device_id, window_start, window_end, percentile_95, last_updated FROM m""",
        "instant_views": f"""WITH {_table_sql()}
            SELECT event_id, window_start * 1000 AS window_start_us, window_end * 1000 AS window_end_us,
                   last_updated * 1000 AS last_updated_us FROM m""",
        "metric_rows": f"WITH {_table_sql()} SELECT {_M_COLS} FROM m",
        "metrics_rejected_by_reason": f"""WITH {_table_sql()}
            SELECT CASE WHEN device_id IS NULL OR trim(device_id) = '' THEN 'invalid_device_id'
                        WHEN window_start <= 0 OR window_end <= 0 THEN 'invalid_window_times'
                        WHEN window_start >= window_end THEN 'invalid_window_range'
                        WHEN percentile_95 < 0 OR percentile_95 > 100 THEN 'invalid_percentile'
                        WHEN last_updated <= 0 THEN 'invalid_last_updated'
                        ELSE 'valid' END AS reason, count(*) AS row_count
            FROM m GROUP BY 1""",
        "table_stats": f"""WITH {_table_sql()}
            SELECT count(*) AS row_count, count(DISTINCT device_id) AS device_count,
                   min(percentile_95) AS min_p95, max(percentile_95) AS max_p95,
                   round(avg(percentile_95), 6) AS avg_p95, max(last_updated) AS max_last_updated,
                   sum(CASE WHEN last_updated = (SELECT max(last_updated) FROM m) THEN 1 ELSE 0 END)
                     AS rows_at_max
            FROM m""",
        "device_counts": f"""WITH {_table_sql()}
            SELECT device_id, count(*) AS row_count FROM m GROUP BY device_id""",
        "device_list": f"WITH {_table_sql()} SELECT DISTINCT device_id FROM m ORDER BY device_id",
        "newest_per_device": f"""WITH {_table_sql()}
            SELECT device_id, event_id, percentile_95, window_start, window_end, last_updated
            FROM {_newest_sql('m', last_order)}""",
        "idempotent_append": f"""WITH {_table_sql()}, {_table_sql(30_000, 5_000, "f", "2")}
            SELECT {_M_COLS} FROM m
            UNION ALL
            SELECT {_M_COLS} FROM f WHERE event_id NOT IN (SELECT event_id FROM m)""",
        "duplicate_event_ids": f"""WITH {_table_sql()},
            s AS (SELECT {_M_COLS} FROM m UNION ALL {alter} m)
            SELECT event_id, count(*) AS copies FROM s GROUP BY event_id HAVING count(*) > 1""",
        "latest_for_device": f"""WITH {_table_sql()}
            SELECT device_id, percentile_95, window_start, window_end, last_updated FROM m
            WHERE device_id = '{LOOKUP_DEVICE}' ORDER BY last_updated DESC LIMIT 1""",
        "top_devices_observed": f"""WITH {_table_sql()},
            l AS (SELECT * FROM m WHERE window_end = (SELECT max(window_end) FROM m))
            SELECT device_id, percentile_95, window_start, window_end, last_updated
            FROM {_newest_sql('l', last_order)}
            ORDER BY percentile_95 DESC, device_id LIMIT {TOP_N}""",
        "top_devices_window": f"""WITH {_table_sql()},
            l AS (SELECT * FROM m WHERE win_end = (SELECT max(win_end) FROM m))
            SELECT device_id, percentile_95, window_start, window_end, last_updated
            FROM {_newest_sql('l', last_order)}
            ORDER BY percentile_95 DESC, device_id LIMIT {TOP_N}""",
        "top_at_latest_update": f"""WITH {_table_sql()}
            SELECT device_id, percentile_95, window_start, window_end, last_updated FROM m
            WHERE last_updated = (SELECT max(last_updated) FROM m)
            ORDER BY percentile_95 DESC, device_id, window_end DESC, window_start DESC
            LIMIT {TOP_N}""",
        "newest_last_60s": f"""WITH {_table_sql()},
            l AS (SELECT * FROM m WHERE last_updated >= (SELECT max(last_updated) FROM m) - {DAY_MS})
            SELECT device_id, percentile_95, window_start, window_end, last_updated
            FROM {_newest_sql('l', 'last_updated DESC, percentile_95 DESC, window_end DESC, event_id DESC')}
            ORDER BY device_id LIMIT {TOP_N}""",
        "late_events": f"""WITH ev AS ({_ev_sql()}),
            a AS (SELECT *, {arrival} AS arrival FROM ev),
            mb AS (SELECT *, max(t) OVER (ORDER BY arrival, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before FROM a)
            SELECT event_id, device_id, t AS timestamp, arrival, max_before,
                   'Late event: ' || device_id || ' at ' || CAST(t AS VARCHAR) AS message
            FROM mb WHERE (t - t % {late.DEFAULT_SLIDE_MS}) + {late.DEFAULT_SIZE_MS
                + late.OUT_OF_ORDERNESS_MS + late.ALLOWED_LATENESS_MS} <= max_before""",
        "high_usage": f"""WITH {_table_sql()}
            SELECT event_id, device_id, percentile_95, percentile_95 >= 80.0 AS high_usage FROM m""",
        "usage_bands": _bands_sql(bands.GENERATOR_BANDS),
        "usage_bands_test": _bands_sql(bands.TEST_BANDS),
        "stream_late_quarantine": f"""WITH ev AS ({_ev_sql()}),
            a AS (SELECT *, {arrival} AS arrival FROM ev),
            b AS (SELECT min(arrival) AS lo, (max(arrival) - min(arrival)) // {ARRIVAL_CHUNKS} + 1
                         AS step FROM a),
            c AS (SELECT a.*, (arrival - lo) // step AS batch_id FROM a, b),
            mx AS (SELECT batch_id, max(t) AS top FROM c GROUP BY batch_id),
            pm AS (SELECT batch_id, max(top) OVER (ORDER BY batch_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM mx)
            SELECT c.event_id, c.device_id, c.t AS timestamp, c.arrival,
                   'Late event: ' || c.device_id || ' at ' || CAST(c.t AS VARCHAR) AS message,
                   c.batch_id
            FROM c JOIN pm USING (batch_id)
            WHERE (c.t - c.t % {late.DEFAULT_SLIDE_MS}) + {late.DEFAULT_SIZE_MS
                + late.OUT_OF_ORDERNESS_MS + late.ALLOWED_LATENESS_MS} <= pm.prev""",
        "stream_refire_revisions": f"""WITH ev AS ({_ev_sql()}),
            a AS (SELECT *, {spread_arrival} AS arrival FROM ev),
            {batches},
            w AS (SELECT c.*, (t - t % {SLIDE_4H_MS}) - k.k * {SLIDE_4H_MS} AS win_start, pm.prev
                  FROM c JOIN pm USING (batch_id), range(0, {DAY_MS // SLIDE_4H_MS}) AS k(k)),
            due AS (SELECT *, win_start + {DAY_MS} AS win_end FROM w
                    WHERE win_start + {DAY_MS} + 35000 <= (SELECT max(top) FROM mx)
                      AND (prev IS NULL OR win_start + {DAY_MS} + 35000 + {DAY_MS} > prev)),
            fire AS (SELECT due.*, (SELECT min(batch_id) FROM pm2 WHERE pm2.now >= due.win_end + 35000) AS first_due
                     FROM due),
            g AS (SELECT device_id, win_start, win_end, count(*) AS event_count, min(t) AS window_start,
                         max(t) AS window_end, list_sort(list(v)) AS xs,
                         max(CASE WHEN batch_id <= first_due THEN 1 ELSE 0 END)
                           + count(DISTINCT CASE WHEN batch_id > first_due THEN batch_id END) AS revisions
                  FROM fire GROUP BY device_id, win_start, win_end),
            q AS (SELECT *, len(xs) AS n, 0.95::DOUBLE * (len(xs) + 1) AS pos FROM g)
            SELECT device_id, win_start, win_end, event_count, window_start, window_end,
                   CASE WHEN pos < 1 THEN xs[1] WHEN pos >= n THEN xs[n]
                        ELSE xs[floor(pos)::BIGINT] + (pos - floor(pos))
                             * (xs[floor(pos)::BIGINT + 1] - xs[floor(pos)::BIGINT]) END AS percentile_95,
                   revisions, revisions AS in_table, revisions AS in_sink FROM q""",
        "stream_row_accounting": f"""WITH ev AS ({_ev_sql()}),
            a AS (SELECT *, {spread_arrival} AS arrival FROM ev),
            {batches},
            k AS (SELECT c.*, pm.prev, (SELECT max(top) FROM mx) AS top, (t - t % {ACCOUNT_MS}) + {ACCOUNT_MS} AS win_end
                  FROM c JOIN pm USING (batch_id))
            SELECT device_id, count(*) AS events,
                   count(*) FILTER (WHERE win_end + 35000 <= top AND (prev IS NULL OR win_end + 35000 > prev)) AS in_windows,
                   count(*) FILTER (WHERE win_end + 35000 <= prev) AS in_quarantine
            FROM k GROUP BY device_id""",
        "writer_stream": f"""WITH {_results_sql()},
            k AS (SELECT *, (win_start // {SLIDE_4H_MS} + length(device_id)) % 7 AS kind FROM res),
            r AS (SELECT CASE kind WHEN 1 THEN 'null_event_id' WHEN 2 THEN 'undecodable_record'
                              WHEN 3 THEN 'device_id_too_long' ELSE 'stored' END AS reason,
                         CASE WHEN kind IN (2, 3) THEN NULL ELSE device_id END AS device_id,
                         CASE WHEN kind IN (2, 3) THEN NULL ELSE percentile_95 END AS p FROM k)
            SELECT reason, device_id, count(*) AS row_count, max(p) AS max_p95 FROM r GROUP BY reason, device_id""",
        "stream_append_matches_batch": f"""WITH {_table_sql()}
            SELECT {_M_COLS} FROM m
            WHERE win_end <= (SELECT max(epoch_us(ts) // 1000) FROM events) - 35000""",
    }
    half = f"CAST(last_updated // {SLIDE_4H_MS} AS BIGINT) % 2 = 0"
    sql["stored_unique_ids"] = f"""WITH {_table_sql()}
        SELECT event_id, device_id, window_start, window_end,
               CASE WHEN {half} THEN percentile_95 ELSE percentile_95 + 1.0 END AS percentile_95, last_updated,
               CAST(window_date AS VARCHAR) AS window_date FROM m"""
    sql |= {"stored_partials": sql["p95_from_panes"], "stored_table": sql["metric_rows"], "stored_latest_for_device": sql["latest_for_device"],
            "stored_top_devices": sql["top_devices_observed"], "stored_newest": sql["newest_last_60s"]}
    return sql
