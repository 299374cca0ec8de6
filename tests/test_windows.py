"""Window assignment: the pane form equals Spark's own window() and the
list form on shuffled input."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import T0, events_df
from fleetpulse.operators.windows import assign_windows, parse_duration_ms, window_p95


def rows_for(n=400, devices=5, seed=3):
    rnd = random.Random(seed)
    return [(f"device-{rnd.randrange(devices):03d}", T0 + rnd.randrange(600_000),
             round(rnd.uniform(0, 100), 2)) for _ in range(n)]


def test_parse_duration():
    assert parse_duration_ms("30 seconds") == 30_000
    assert parse_duration_ms("5s") == 5_000
    assert parse_duration_ms("4 hours") == 14_400_000
    assert parse_duration_ms("1 day") == 86_400_000
    assert parse_duration_ms(250) == 250


def test_assignment_equals_spark_window(spark):
    df = events_df(spark, rows_for())
    mine = assign_windows(df, 30_000, 5_000).select(
        "device_id", "timestamp", "win_start")
    spark_w = df.select("device_id", "timestamp",
                        F.window("ts", "30 seconds", "5 seconds").alias("w")).select(
        "device_id", "timestamp", F.unix_millis("w.start").alias("win_start"))
    assert sorted(mine.collect()) == sorted(spark_w.collect())


def test_six_windows_per_row(spark):
    df = events_df(spark, [("d", T0 + 7_000, 1.0)])
    starts = sorted(r.win_start for r in assign_windows(df, 30_000, 5_000).collect())
    base = T0 + 5_000
    assert starts == [base - k * 5_000 for k in range(5, -1, -1)]


def test_hist_equals_array_sliding_and_tumbling(spark):
    df = events_df(spark, rows_for(600)).repartition(7)
    for size, slide in [(30_000, 5_000), (60_000, 60_000), (30_000, 20_000)]:
        a = sorted(window_p95(df, size, slide, method="hist").collect())
        b = sorted(window_p95(df, size, slide, method="array").collect())
        assert a == b, (size, slide)


def test_auto_equals_one_plan_for_all(spark):
    df = events_df(spark, rows_for(300))
    a = sorted(window_p95(df, "30 seconds", "5 seconds", method="auto").collect())
    b = sorted(window_p95(df, "30 seconds", "5 seconds", method="array").collect())
    assert a == b


def test_null_device_dropped(spark):
    df = events_df(spark, [(None, T0, 1.0), ("", T0, 2.0), ("d", T0, 3.0)])
    out = {r.device_id for r in window_p95(df, "1 minute").collect()}
    assert out == {"", "d"}


def test_max_rule_threshold():
    from fleetpulse.functions.percentile import max_rule_holds

    assert max_rule_holds(19) and not max_rule_holds(20)


def test_max_method_equals_array_on_small_windows(spark):
    rows = rows_for(300, devices=40) + [("nan-dev", T0, float("nan")),
                                        ("nan-dev", T0 + 1, float("nan"))]
    df = events_df(spark, rows)
    a = window_p95(df, 30_000, 5_000, method="max").collect()
    b = window_p95(df, 30_000, 5_000, method="array").collect()
    assert max(r.event_count for r in b) <= 19

    def key(r):
        return tuple("nan" if isinstance(x, float) and x != x else x for x in r)

    assert sorted(map(key, a)) == sorted(map(key, b))


def test_auto_routes_hot_device_to_buckets(spark, monkeypatch):
    """A device holding a third of the rows: above the list bound, auto must
    take the bucket plan, and the result is the same exact percentile."""
    import fleetpulse.operators.windows as W

    rnd = random.Random(21)
    rows = [("hot", T0 + rnd.randrange(60_000), round(rnd.uniform(0, 100), 3)) for _ in range(600)]
    rows += [(f"d{i % 40}", T0 + rnd.randrange(60_000), round(rnd.uniform(0, 100), 2))
             for i in range(1200)]
    df = events_df(spark, rows)
    got = sorted(window_p95(df, "30 seconds", "5 seconds", method="auto").collect())
    want = sorted(window_p95(df, "30 seconds", "5 seconds", method="array").collect())
    assert got == want


def test_all_null_window_is_nan_in_every_plan(spark):
    import math

    df = events_df(spark, [("n", T0, None), ("n", T0 + 1, None), ("v", T0, 5.0)])
    for method in ["max", "array", "hist"]:
        got = {r.device_id: r.percentile_95 for r in window_p95(df, "1 minute", method=method).collect()}
        assert math.isnan(got["n"]) and got["v"] == 5.0, method


def brute_force_windows(rows, size, slide):
    """Plain Python: every window containing each row, then the rule."""
    from collections import defaultdict

    from conftest import legacy_p95

    groups = defaultdict(list)
    for d, t, v in rows:
        last = t - t % slide
        s = last
        while s > t - size:
            groups[(d, s)].append((t, v))
            s -= slide
    out = {}
    for (d, s), items in groups.items():
        vals = [v for _, v in items]
        out[(d, s)] = (len(items), min(t for t, _ in items), max(t for t, _ in items),
                       legacy_p95(vals))
    return out



@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.integers(min_value=0, max_value=90_000),
                          st.sampled_from([0.0, 1.5, 12.25, 50.0, 75.5, 99.9, 100.0])),
                min_size=1, max_size=80),
       st.sampled_from([(30_000, 5_000), (20_000, 20_000), (30_000, 20_000)]))
def test_every_plan_equals_brute_force(spark, raw, shape):
    size, slide = shape
    rows = [(d, T0 + t, v) for d, t, v in raw]
    want = brute_force_windows(rows, size, slide)
    df = events_df(spark, rows)
    bound = max(c for c, _, _, _ in want.values())
    methods = ["array", "hist", "auto"] + (["max"] if bound <= 19 else [])
    for method in methods:
        got = {(r.device_id, r.win_start): (r.event_count, r.window_start, r.window_end,
                                            r.percentile_95)
               for r in window_p95(df, size, slide, method=method).collect()}
        assert got == want, method
