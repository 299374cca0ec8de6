"""Session helpers: the shared checkpoint folder and instant views."""

from fleetpulse.functions.timeutil import as_instants, ingest_lag
from fleetpulse.session import ensure_checkpoint_dir, shared_path


def test_checkpoint_dir_is_read_not_replaced(spark):
    preset = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == preset
    assert shared_path(spark, "x").startswith(preset.rstrip("/") + "/x-")


def test_instants_and_lag(spark):
    df = spark.createDataFrame([(1_704_067_200_123, 1_704_067_230_000, 1_704_067_230_000)],
                               "window_start long, window_end long, last_updated long")
    r = as_instants(df).collect()[0]
    assert r.window_start_ts.isoformat().startswith("2024-01-01T00:00:00.123")
    lag = ingest_lag(df.withColumnRenamed("window_start", "timestamp"), now_ms=1_704_067_201_000)
    assert lag.collect()[0].lag_ms == 877


def test_event_time_from_ms(spark):
    from fleetpulse.sources.events import with_event_time

    df = spark.createDataFrame([(1_704_067_200_500,)], "timestamp long")
    r = with_event_time(df).collect()[0]
    assert r.ts.isoformat().startswith("2024-01-01T00:00:00.5")


def test_ntz_binding_ignores_session_zone(spark):
    from fleetpulse.sources.events import bind_events

    raw = spark.sql("SELECT 1L AS event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS ts, "
                    "7L AS user_id, 'view' AS event_type, 1.5D AS value, '' AS props")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = bind_events(raw).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert r.timestamp == 1_704_067_200_123 and r.device_id == "7"
