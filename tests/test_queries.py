"""The read side: latest metric of a device and the top-N queries, on
fixtures with fixed clocks, plus the argument checks."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.plans import metrics as M

T = 1_700_000_000_000
HOUR = 3_600_000
COLS = ("event_id string, device_id string, window_start long, window_end long, "
        "percentile_95 double, last_updated long")


def table(spark, rows):
    """rows: (device, p95, t) -> default row: start = t - 60 s, end = updated = t."""
    data = [(f"e{i}", d, t - 60_000, t, p, t) for i, (d, p, t) in enumerate(rows)]
    return spark.createDataFrame(data, COLS)


def test_latest_of_three(spark):
    df = table(spark, [("device-001", 60.0, T - 2 * HOUR), ("device-001", 70.0, T - HOUR),
                       ("device-001", 85.5, T)])
    r = M.latest_for_device(df, "device-001").collect()
    assert len(r) == 1 and r[0].percentile_95 == 85.5
    assert r[0].asDict().keys() == {"device_id", "percentile_95", "window_start",
                                    "window_end", "last_updated"}


def test_latest_tie_goes_to_the_greatest_id(spark):
    df = table(spark, [("a", 10.0, T), ("a", 30.0, T), ("a", 20.0, T)])
    assert M.latest_for_device(df.repartition(3), "a").collect()[0].percentile_95 == 20.0


def test_special_and_long_ids(spark):
    special = "device-with-special_chars.123-test@domain"
    long_id = "x" * 200
    df = table(spark, [(special, 42.0, T), (long_id, 0.001, T)])
    assert M.latest_for_device(df, special).collect()[0].percentile_95 == 42.0
    assert M.latest_for_device(df, long_id).collect()[0].percentile_95 == 0.001


def test_edge_values_exact(spark):
    vals = [0.0, 100.0, 99.999, 0.001, 50.0, 75.0]
    df = table(spark, [(f"dev-{i}", v, T) for i, v in enumerate(vals)])
    for i, v in enumerate(vals):
        assert M.latest_for_device(df, f"dev-{i}").collect()[0].percentile_95 == v


def test_not_found_and_empty(spark):
    df = table(spark, [("a", 1.0, T)])
    assert M.latest_for_device(df, "nope").count() == 0
    empty = spark.createDataFrame([], COLS)
    assert M.latest_for_device(empty, "a").count() == 0
    assert M.top_devices(empty, 10).count() == 0


def test_ordered_top(spark):
    df = table(spark, [("d25", 25.0, T), ("d55", 55.0, T), ("d85", 85.0, T), ("d95", 95.0, T)])
    assert [r.percentile_95 for r in M.top_devices(df, 3).collect()] == [95.0, 85.0, 55.0]


def test_time_based_only_latest(spark):
    df = table(spark, [("old-1", 45.0, T - 2 * HOUR), ("old-2", 55.0, T - 2 * HOUR),
                       ("mid-1", 65.0, T - HOUR), ("latest-1", 75.0, T - HOUR),
                       ("latest-1", 85.0, T), ("latest-2", 95.0, T), ("latest-3", 25.0, T)])
    got = [(r.device_id, r.percentile_95) for r in M.top_devices(df, 10).collect()]
    assert got == [("latest-2", 95.0), ("latest-1", 85.0), ("latest-3", 25.0)]


def test_identical_and_fewer_than_n(spark):
    df = table(spark, [("a", 75.0, T), ("b", 75.0, T), ("c", 75.0, T)])
    assert M.top_devices(df, 10).count() == 3
    assert M.top_devices(df, 100).count() == 3
    assert [r.device_id for r in M.top_devices(df, 2).collect()] == ["a", "b"]


def test_n_zero_inner_plan_empty(spark):
    df = table(spark, [(f"d{i}", float(i), T) for i in range(5)])
    assert M.top_devices(df, 0, checked=False).count() == 0
    with pytest.raises(ValueError, match="N must be at least 1"):
        M.top_devices(df, 0)


def test_large_thousand_devices(spark):
    rows = []
    for i in range(1000):
        band = [(0, 30), (30, 60), (60, 90), (90, 100)][0 if i < 400 else 1 if i < 700 else 2 if i < 900 else 3]
        rows.append((f"type-env-{i:04d}", band[0] + (i * 7 % 100) / 100 * (band[1] - band[0]), T))
    df = table(spark, rows)
    top = [r.percentile_95 for r in M.top_devices(df, 10).collect()]
    assert len(top) == 10 and top == sorted(top, reverse=True)
    assert top[0] == max(p for _, p, _ in rows)


def test_history_newest_found(spark):
    df = table(spark, [("dev", float(i), T - (50 - i) * 60_000) for i in range(50)])
    assert M.latest_for_device(df, "dev").collect()[0].percentile_95 == 49.0


def test_observed_vs_window_basis(spark):
    # two devices share the last true window but not the last event time
    data = [("e1", "a", T - 50_000, T - 1_000, 10.0, T, T),
            ("e2", "b", T - 40_000, T - 2_000, 20.0, T, T)]
    df = spark.createDataFrame(data, COLS + ", win_end long")
    assert [r.device_id for r in M.top_devices(df, 10).collect()] == ["a"]
    assert [r.device_id for r in M.top_devices(df, 10, basis="window").collect()] == ["b", "a"]


def test_top_at_latest_update_and_recent(spark):
    df = table(spark, [("a", 10.0, T), ("b", 30.0, T), ("a", 90.0, T - 30_000),
                       ("c", 50.0, T - 120_000)])
    assert [r.device_id for r in M.top_at_latest_update(df, 10).collect()] == ["b", "a"]
    recent = M.newest_recent(df, 10, span_ms=60_000).collect()
    assert [(r.device_id, r.percentile_95) for r in recent] == [("a", 10.0), ("b", 30.0)]


def test_newest_per_device_and_stats(spark):
    df = table(spark, [("a", 1.0, T - HOUR), ("a", 2.0, T), ("b", 3.0, T - HOUR)])
    got = {r.device_id: r.percentile_95 for r in M.newest_per_device(df).collect()}
    assert got == {"a": 2.0, "b": 3.0}
    s = M.table_stats(df).collect()[0]
    assert (s.row_count, s.device_count, s.min_p95, s.max_p95, s.rows_at_max) == (3, 2, 1.0, 3.0, 1)
    assert [r.device_id for r in M.device_list(df).collect()] == ["a", "b"]
    assert M.count_for_device(df, "a").collect()[0].row_count == 2


@pytest.mark.parametrize("n", [1, 50, 100, "10"])
def test_n_accepted(n):
    assert M.check_n(n) == int(n)


@pytest.mark.parametrize("n,msg", [(0, "at least 1"), (-1, "at least 1"), (101, "cannot exceed 100"),
                                   ("abc", "Invalid"), ("1.5", "Invalid"), ("null", "Invalid"),
                                   (1.5, "Invalid")])
def test_n_refused(n, msg):
    with pytest.raises(ValueError, match=msg):
        M.check_n(n)


@pytest.mark.parametrize("d", ["", "   ", None])
def test_blank_device_refused(d):
    with pytest.raises(ValueError, match="Device ID cannot be blank"):
        M.check_device_id(d)


def test_lookup_filter_reaches_scan(spark, tmp_path):
    df = table(spark, [("a", 1.0, T), ("b", 2.0, T)])
    df.write.parquet(str(tmp_path / "m"))
    plan = M.latest_for_device(spark.read.parquet(str(tmp_path / "m")), "a")._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(device_id), EqualTo(device_id,a)]" in plan
    assert "TakeOrderedAndProject" in plan
