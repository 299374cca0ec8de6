"""Windows kept up to date from stored partials equal windows over all events,
and a batch replaces the windows that its panes touch and no others."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import T0, events_df
from fleetpulse.operators.windows import window_p95
from fleetpulse.sources.partials import WindowStore

SIZE, SLIDE = 30_000, 5_000


def rows_of(seed, n, days=3):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "d1", "d2", None]), T0 + rnd.randrange(days) * 86_400_000 + rnd.randrange(90_000),
             rnd.choice([float(rnd.randrange(100)), rnd.random(), 0.0, -0.0])) for _ in range(n)]
    return rows + [("d1", T0 - 5_000, float("nan")), ("d2", T0, 1.0)]


def table(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


def expect(spark, rows):
    return table(window_p95(events_df(spark, rows), SIZE, SLIDE))


@pytest.mark.parametrize("fold", [False, True])
def test_batches_equal_one_batch_over_all(spark, tmp_path, fold):
    parts = [rows_of(k, 150) for k in range(3)]
    store = WindowStore(spark, str(tmp_path / "s"), SIZE, SLIDE)
    seen = []
    for k, rows in enumerate(parts):
        store.append(events_df(spark, rows), k)
        store.append(events_df(spark, rows), k)                  # a replay
        seen += rows
        assert table(store.windows()) == expect(spark, seen)
        if fold and k == 1:
            store.fold(1)
            store.append(events_df(spark, rows), 1)              # folded already
            assert table(store.windows()) == expect(spark, seen)
    # The partials alone give any window of whole panes.
    assert store.partials().agg(F.sum("c")).first()[0] == sum(r[0] is not None for r in seen)


def test_a_late_pane_replaces_only_the_windows_it_touches(spark, tmp_path):
    store = WindowStore(spark, str(tmp_path / "s"), SIZE, SLIDE)
    store.append(events_df(spark, rows_of(1, 200)), 0)
    store.append(events_df(spark, [("d1", T0 + 40_000, 99.5)]), 1)
    touched = [(r.device_id, r.win_start - T0) for r in store.touched_by(1).collect()]
    assert sorted(touched) == [("d1", s) for s in range(15_000, 45_000, 5_000)]
    store.append(events_df(spark, [("d3", T0, 1.0)]), 2)
    assert {r.device_id for r in store.touched_by(2).collect()} == {"d3"}


def test_dates_out_of_reach_are_not_read(spark, tmp_path):
    store = WindowStore(spark, str(tmp_path / "s"), SIZE, SLIDE)
    store.append(events_df(spark, [("d1", T0 + k * 86_400_000, 1.0) for k in range(9)]), 0)
    panes = store.partials()
    day = panes.select("pane_date").distinct().orderBy("pane_date").first()[0]
    cut = panes.filter(F.col("pane_date").isin([day]))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "pane_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_batches_and_tumbling_windows_of_two_keys(spark, tmp_path):
    store = WindowStore(spark, str(tmp_path / "s"), 60_000, keys=("device_id", "kind"))
    rows = rows_of(5, 120)
    ev = events_df(spark, rows).withColumn("kind", F.when(F.col("cpu_usage") > 1, F.lit("x")).when(
        F.col("cpu_usage") > 0, F.lit("y")))
    store.append(ev.limit(0), 0)
    assert store.windows().count() == 0
    store.append(ev, 1)
    store.append(ev.limit(0), 2)
    store.fold(2)
    assert table(store.windows()) == table(window_p95(ev, 60_000, keys=("device_id", "kind")))
