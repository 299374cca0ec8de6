"""The aggregate's cases (accumulate, result, merge, edge cases) as
DataFrame literals, on both the histogram and the list form."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import T0, events_df, legacy_p95
from fleetpulse.operators.quantile import exact_percentile
from fleetpulse.operators.results import global_p95
from fleetpulse.operators.windows import pane_partials, window_p95, windows_from_partials

METHODS = ["hist", "array"]
HOUR = 3_600_000


def one_window(spark, rows, method):
    """All rows fall in one tumbling hour window of device-001."""
    df = events_df(spark, rows)
    out = window_p95(df, HOUR, method=method).collect()
    assert len(out) == 1
    return out[0]


@pytest.mark.parametrize("method", METHODS)
def test_single_value(spark, method):
    r = one_window(spark, [("device-001", T0, 75.5)], method)
    assert r.percentile_95 == 75.5 and r.window_start == T0 and r.window_end == T0
    assert r.event_count == 1


@pytest.mark.parametrize("method", METHODS)
def test_three_in_order(spark, method):
    r = one_window(spark, [("device-001", T0, 60.0), ("device-001", T0 + 10_000, 75.5),
                           ("device-001", T0 + 20_000, 90.0)], method)
    assert r.event_count == 3 and r.window_start == T0 and r.window_end == T0 + 20_000
    assert r.percentile_95 == 90.0


@pytest.mark.parametrize("method", METHODS)
def test_out_of_order_bounds(spark, method):
    r = one_window(spark, [("device-001", T0 + 20_000, 1.0), ("device-001", T0, 2.0),
                           ("device-001", T0 + 40_000, 3.0)], method)
    assert (r.window_start, r.window_end) == (T0, T0 + 40_000)


@pytest.mark.parametrize("method", METHODS)
def test_twenty_steps_interpolates(spark, method):
    rows = [("device-001", T0 + i * 1000, float(5 * (i + 1))) for i in range(20)]
    assert one_window(spark, rows, method).percentile_95 == 99.75


@pytest.mark.parametrize("method", METHODS)
def test_edge_values(spark, method):
    vals = [0.0, 0.1, 50.0, 99.9, 100.0]
    rows = [("device-001", T0 + i, v) for i, v in enumerate(vals)]
    assert one_window(spark, rows, method).percentile_95 == 100.0


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("v", [0.0, 100.0])
def test_zero_and_hundred(spark, method, v):
    assert one_window(spark, [("device-001", T0, v)], method).percentile_95 == v


@pytest.mark.parametrize("method", METHODS)
def test_large_golden(spark, method):
    # 2000 values i % 100, every 100 ms: the recorded golden, bit for bit.
    rows = [("device-001", T0 + i * 100, float(i % 100)) for i in range(2000)]
    df = events_df(spark, rows)
    out = window_p95(df, "1 day", method=method).collect()
    assert len(out) == 1
    assert out[0].percentile_95 == 94.94999999999982
    assert out[0].event_count == 2000


@pytest.mark.parametrize("method", METHODS)
def test_constant(spark, method):
    rows = [("device-001", T0 + i, 42.5) for i in range(10)]
    assert one_window(spark, rows, method).percentile_95 == 42.5


@pytest.mark.parametrize("method", METHODS)
def test_same_timestamp(spark, method):
    r = one_window(spark, [("device-001", T0, 60.0), ("device-001", T0, 80.0)], method)
    assert (r.window_start, r.window_end, r.event_count) == (T0, T0, 2)


def test_merge_of_partials(spark):
    """Two partial aggregates {60, 70} and {65, 75} merge to count 4 and the
    outer bounds; an empty partial is the identity."""
    a = events_df(spark, [("device-001", T0, 60.0), ("device-001", T0 + 5_000, 70.0)])
    b = events_df(spark, [("device-001", T0 + 10_000, 65.0), ("device-001", T0 + 15_000, 75.0)])
    empty = events_df(spark, [])
    parts = (pane_partials(a, "5 seconds").unionByName(pane_partials(b, "5 seconds"))
             .unionByName(pane_partials(empty, "5 seconds")))
    out = windows_from_partials(parts, "1 hour", pane="5 seconds").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.event_count, r.window_start, r.window_end) == (4, T0, T0 + 15_000)
    assert r.percentile_95 == legacy_p95([60.0, 70.0, 65.0, 75.0])


def test_empty_default(spark):
    live = global_p95(events_df(spark, [])).collect()[0]
    assert live.window_start == live.window_end > 1_700_000_000_000
    out = global_p95(events_df(spark, []), now_ms=123).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.device_id, r.percentile_95, r.window_start, r.window_end) == ("unknown", 0.0, 123, 123)


def test_global_matches_formula(spark):
    rows = [("d", T0 + i, float((i * 37) % 101) / 3) for i in range(500)]
    r = global_p95(events_df(spark, rows)).collect()[0]
    assert r.percentile_95 == legacy_p95([v for _, _, v in rows])
    assert r.event_count == 500


def test_nan_dropped_and_single_nan_kept(spark):
    rows = [("a", T0, float("nan")), ("a", T0 + 1, 10.0), ("a", T0 + 2, 20.0),
            ("b", T0, float("nan"))]
    for method in METHODS:
        out = {r.device_id: r for r in window_p95(events_df(spark, rows), HOUR,
                                                  method=method).collect()}
        assert out["a"].percentile_95 == 20.0 and out["a"].event_count == 3
        assert math.isnan(out["b"].percentile_95)


def test_negative_zero_infinite(spark):
    vals = [-5.0, -0.5, 0.0, 1e-300, 3.0, float("inf"), -float("inf"), 7.25] * 3
    rows = [("d", T0 + i, v) for i, v in enumerate(vals)]
    r = exact_percentile(events_df(spark, rows), ["device_id"], "cpu_usage").collect()[0]
    want = legacy_p95(vals)
    assert r.percentile_95 == want or (math.isnan(r.percentile_95) and math.isnan(want))
    # without the infinities the interpolation is finite
    finite = [v for v in vals if not math.isinf(v)]
    rows = [("d", T0 + i, v) for i, v in enumerate(finite)]
    r = exact_percentile(events_df(spark, rows), ["device_id"], "cpu_usage").collect()[0]
    assert r.percentile_95 == legacy_p95(finite)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, width=64),
                min_size=1, max_size=60),
       st.integers(min_value=1, max_value=4))
def test_property_hist_equals_formula(spark, values, groups):
    rows = [(f"g{i % groups}", T0 + i, v) for i, v in enumerate(values)]
    got = {r.device_id: r.percentile_95 for r in
           exact_percentile(events_df(spark, rows), ["device_id"], "cpu_usage").collect()}
    for g in got:
        vals = [v for d, _, v in rows if d == g]
        xs = sorted(vals)
        want = legacy_p95(xs) if len(xs) > 1 else xs[0]
        assert got[g] == want, (g, vals)


def test_hot_group_many_distinct_values(spark):
    """One group with far more distinct values than the others, spread over
    many coarse buckets: the two-level selection is exact."""
    rows = [("hot", T0 + i, (i * 7919 % 10007) / 7.0) for i in range(20000)]
    rows += [(f"d{i}", T0 + i, float(i)) for i in range(50)]
    df = events_df(spark, rows)
    got = {r.device_id: r.percentile_95 for r in window_p95(df, "1 day", method="hist").collect()}
    assert got["hot"] == legacy_p95([v for d, _, v in rows if d == "hot"])
    assert got["d3"] == 3.0


@pytest.mark.parametrize("method", ["list", "buckets"])
def test_partials_methods_agree(spark, method):
    import random

    rnd = random.Random(9)
    rows = [(f"d{rnd.randrange(3)}", T0 + rnd.randrange(120_000), float(rnd.randrange(50)))
            for _ in range(400)]
    parts = pane_partials(events_df(spark, rows), "5 seconds")
    got = sorted(windows_from_partials(parts, "30 seconds", "5 seconds", method=method).collect())
    want = sorted(window_p95(events_df(spark, rows), "30 seconds", "5 seconds",
                             method="array").collect())
    assert got == want


def test_slices_are_monotone_and_even(spark):
    """Full-precision values of one group: buckets and their slices rise with
    the value, and no slice holds more than a sliver of the rows."""
    import random

    from fleetpulse.operators import quantile as Q

    rnd = random.Random(9)
    values = [rnd.gauss(60.0, 15.0) for _ in range(20_000)] + [rnd.uniform(-1, 1) for _ in range(2_000)] + [
        0.0, -0.0, 1.0, 2.0, 64.0, 1e308, -1e308, 5e-324, float("inf"), float("-inf")]
    df = spark.createDataFrame([(1, float(v)) for v in values], "g int, v double")
    rows = df.select("v", Q.coarse_bucket(F.col("v")).alias("b"), Q.slice_of_bucket(F.col("v")).alias("s")).collect()
    order = sorted(rows, key=lambda r: r.v)
    assert all((x.b, x.s) <= (y.b, y.s) for x, y in zip(order, order[1:]))
    from collections import Counter
    buckets, slices = Counter(r.b for r in rows), Counter((r.b, r.s) for r in rows)
    assert max(buckets.values()) > 200 and max(slices.values()) < 20


def test_one_group_of_full_precision_is_exact_and_dealt_evenly(spark):
    import random

    from conftest import legacy_p95
    from fleetpulse.operators import quantile as Q

    rnd = random.Random(10)
    # nearly all rows in one coarse bucket, which also holds the wanted ranks
    values = [rnd.uniform(90.0, 90.9) for _ in range(30_000)] + [rnd.uniform(0, 80) for _ in range(300)] + [90.5] * 500
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double").repartition(8)
    for p in (0.95, 0.5, 0.01):
        got = Q.exact_percentile(df, ["g"], "v", p, "x").first()
        xs, pos = sorted(values), p * (len(values) + 1)
        f = int(pos)
        assert got.n == len(values) and got.x == xs[f - 1] + (pos - f) * (xs[f] - xs[f - 1])
    assert Q.exact_percentile(df, ["g"], "v", 0.95, "x").first().x == legacy_p95(values)
    hist = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        sizes = Q.bucketed_histogram(hist, ["g"], "v", sliced=True).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    held = [r["count"] for r in sizes]
    assert len(held) == 16 and max(held) < 2 * sum(held) / 16


def test_negative_groups_take_slices_in_order(spark):
    from fleetpulse.operators import quantile as Q

    values = [-(90.0 + k / 10_000) for k in range(5_000)] + [float("nan")] * 7
    df = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values)], "g int, v double")
    for r in Q.exact_percentile(df, ["g"], "v", 0.95, "x").collect():
        xs = sorted(v for k, v in enumerate(values) if k % 2 == r.g and v == v)
        pos = 0.95 * (len(xs) + 1)
        f = int(pos)
        assert r.n == len(xs) and r.x == xs[f - 1] + (pos - f) * (xs[f] - xs[f - 1])
