"""Re-firing windows from histogram state, their way through the outbox, and
the job as a whole (file sources, one file per micro-batch)."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import T0, legacy_p95
from fleetpulse.session import path_exists
from fleetpulse.sources.codec import decode_results
from fleetpulse.sources.store import MetricsTable
from fleetpulse.streaming import refire
from fleetpulse.streaming.late import read_quarantine
from fleetpulse.streaming.outbox import Outbox, to_files, to_table
from fleetpulse.streaming.streams import (read_event_stream, start_job, start_metrics_stream,
                                          start_results_stream, start_revisions_stream, union_sources)

# Rows (ms after T0) per micro-batch, in arrival order.
SEQUENCE = [[0, 4000, 29999], [65000], [1000], [101000], [2000], [102000]]
SIZE, SLIDE, OOO, LATE = 30_000, 5_000, 35_000, 35_000


def write_files(folder, batches):
    """Batches of (device, time, value), one file each, in this order."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for d, t, v in rows:
                f.write(json.dumps({"deviceId": d, "timestamp": t, "cpuUsage": v}) + "\n")
        os.utime(path, (1000 + i, 1000 + i))


def stream(spark, folder):
    return read_event_stream(spark, "json", str(folder), max_files_per_trigger=1)


def run(q):
    q.awaitTermination(600)
    assert q.exception() is None


def expected(batches):
    """Plain-Python statement: revisions as {(device, win_start): [counts]},
    the last revision's percentile, and the rows no window takes."""
    windows, fired, late, prev = {}, {}, [], None
    for rows in batches:
        now = max([t for _, t, _ in rows] + ([prev] if prev is not None else []))
        touched = set()
        for d, t, v in rows:
            starts = [t - t % SLIDE - SLIDE * k for k in range(SIZE // SLIDE)]
            if prev is not None and max(starts) + SIZE + OOO + LATE <= prev:
                late.append(t)
            for w in starts:
                if prev is None or w + SIZE + OOO + LATE > prev:
                    windows.setdefault((d, w), []).append(v)
                    touched.add((d, w))
        for key, vals in windows.items():
            due = key[1] + SIZE + OOO
            if due <= now and (prev is None or due > prev or key in touched):
                fired.setdefault(key, []).append((len(vals), legacy_p95(vals)))
        prev = now
    return fired, late


def revisions_of(rows):
    out = {}
    for r in rows:
        out.setdefault((r.device_id, r.win_start), []).append((r.event_count, r.percentile_95))
    return {k: sorted(v) for k, v in out.items()}


def random_batches(n, seed=3):
    import random
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        rows = []
        for _ in range(60):
            # one device holds most rows; times trail by up to 140 s
            d = "hot" if rnd.random() < 0.7 else f"d{rnd.randrange(3)}"
            rows.append((d, T0 + 20_000 * k + rnd.randrange(20_000) - (rnd.randrange(140_000) if rnd.random() < 0.3 else 0),
                         round(rnd.uniform(0, 100), 1)))
        out.append(rows)
    return out


def test_refire_sequence(spark, tmp_path):
    write_files(tmp_path / "src", [[("device-001", T0 + t, float(t % 97)) for t in b] for b in SEQUENCE])
    table = MetricsTable(spark, str(tmp_path / "t"))
    run(start_revisions_stream(stream(spark, tmp_path / "src"), table, str(tmp_path / "ck")))
    first = sorted((r for r in Outbox(spark, str(tmp_path / "ck-state/outbox"), {}).read().collect()
                    if r.win_start == T0), key=lambda r: r.event_count)
    # fired with 3 values, re-fired once the row at 1000 came; 2000 dropped
    assert [r.event_count for r in first] == [3, 4]
    assert first[0].percentile_95 == max(0.0, 4000 % 97, 29999 % 97)
    assert (first[1].window_start, first[1].window_end) == (T0, T0 + 29999)
    assert len({r.id for r in first}) == 2
    assert {r.id for r in first} <= {r.event_id for r in table.scan().collect()}


def test_revisions_equal_the_plain_statement(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refire, "ROLL_UP", 2)
    batches = random_batches(7)
    write_files(tmp_path / "src", batches)
    table = MetricsTable(spark, str(tmp_path / "t"))
    run(start_results_stream(stream(spark, tmp_path / "src"),
                             {"table": to_table(table), "files": to_files(str(tmp_path / "sink"))}, str(tmp_path / "ck"),
                             state_partitions=3))
    box = Outbox(spark, str(tmp_path / "ck-state/outbox"), {}).read()
    fired, _ = expected(batches)
    assert revisions_of(box.collect()) == {k: sorted(set(v)) for k, v in fired.items()}
    assert any(len(v) > 1 for v in fired.values())
    ids = sorted(r.id for r in box.collect())
    assert len(set(ids)) == len(ids)
    assert sorted(r.event_id for r in table.scan().collect()) == ids
    assert sorted(r.id for r in decode_results(spark.read.text(str(tmp_path / "sink")).select("value")).collect()) == ids
    # A roll-up keeps the number of folders that a batch reads, and that exist, bounded.
    kept = [f for f in os.listdir(tmp_path / "ck-state/windows/changes")]
    assert len(kept) <= 6


def test_state_is_keyed_by_value(spark, tmp_path):
    """A hot device's state rows spread by value: the stateful exchange is
    hashed on it, and the state holds counts, no lists."""
    write_files(tmp_path / "src", random_batches(1))
    updates = refire.pane_updates(stream(spark, tmp_path / "src"), "30 seconds", "5 seconds", "35 seconds", "35 seconds")
    q = updates.writeStream.outputMode("update").format("memory").queryName("panes_probe") \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run(q)
    plan = q._jsq.explainInternal(False)
    exchange = next(line for line in plan.splitlines() if "hashpartitioning(device_id" in line)
    assert "cpu_usage" in exchange and "Python" not in plan and "collect_list" not in plan


class Boom(RuntimeError):
    pass


def test_a_failed_batch_reaches_every_target_once(spark, tmp_path):
    batches = random_batches(4)
    write_files(tmp_path / "src", batches)
    calls, fail = [], {"left": 2}

    def flaky(rows, batch_id):
        if fail["left"] and batch_id == 2:
            fail["left"] -= 1
            raise Boom("target is down")
        calls.append((batch_id, sorted(r.id for r in rows.collect())))

    table = MetricsTable(spark, str(tmp_path / "t"))
    start = lambda: start_results_stream(
        stream(spark, tmp_path / "src"), {"files": to_files(str(tmp_path / "sink")), "topic": flaky,
                                          "table": to_table(table)}, str(tmp_path / "ck"), live_clock=True)
    for _ in range(2):
        q = start()
        with pytest.raises(Exception, match="target is down"):
            q.awaitTermination(600)
        # the stored results of the failed batch, their clock included, are what the restart serves
        stored = spark.read.parquet(str(tmp_path / "ck-state/outbox/batch_id=2"))
        before = sorted((r.id, r.last_updated) for r in stored.collect())
        time.sleep(0.05)
    run(start())
    assert sorted((r.id, r.last_updated) for r in spark.read.parquet(
        str(tmp_path / "ck-state/outbox/batch_id=2")).collect()) == before
    box = Outbox(spark, str(tmp_path / "ck-state/outbox"), {}).read().collect()
    assert revisions_of(box) == {k: sorted(set(v)) for k, v in expected(batches)[0].items()}
    served = [i for _, ids in calls for i in ids]
    assert sorted(served) == sorted(r.id for r in box) and len({b for b, _ in calls}) == len(calls)
    assert sorted(r.event_id for r in table.scan().collect()) == sorted(served)
    assert spark.read.text(str(tmp_path / "sink")).count() == len(served)
    assert min(r.last_updated for r in box) > T0 + 10 ** 9           # the wall clock, not event time


def test_every_row_is_in_the_windows_or_in_the_quarantine(spark, tmp_path):
    batches = random_batches(4, seed=8)
    write_files(tmp_path / "src", batches)
    table = MetricsTable(spark, str(tmp_path / "t"))
    for q in start_job(lambda: stream(spark, tmp_path / "src"), table, str(tmp_path / "late"), str(tmp_path / "ck")):
        run(q)
    fired, late = expected(batches)
    assert sorted(r.timestamp for r in read_quarantine(spark, str(tmp_path / "late")).collect()) == sorted(late) != []
    got = revisions_of(Outbox(spark, str(tmp_path / "ck/results-state/outbox"), {}).read().collect())
    assert got == {k: sorted(set(v)) for k, v in fired.items()}


def test_live_clock_of_the_append_stream(spark, tmp_path):
    write_files(tmp_path / "src", [[("d", T0, 1.0)], [("d", T0 + 200_000, 2.0)]])
    table = MetricsTable(spark, str(tmp_path / "t"))
    before = int(time.time() * 1000)
    run(start_metrics_stream(stream(spark, tmp_path / "src"), table, str(tmp_path / "ck"), live_clock=True))
    rows = table.scan().collect()
    assert rows and all(r.last_updated >= before for r in rows)


@pytest.mark.parametrize("policy, closes", [("max", True), ("min", False)])
def test_a_silent_source_holds_back_nothing(spark, tmp_path, policy, closes):
    """O-28: two sources as one stream; the second falls silent after one
    row. Windows of the first close all the same (under Spark's default, the
    slowest source, they do not)."""
    write_files(tmp_path / "a", [[("d", T0, 1.0)], [("d", T0 + 200_000, 2.0)]])
    write_files(tmp_path / "b", [[("e", T0 + 1_000, 3.0)]])
    events = union_sources([stream(spark, tmp_path / "a"), stream(spark, tmp_path / "b")], "35 seconds")
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max"
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    try:
        q = events.groupBy("device_id", F.window("ts", "30 seconds").alias("w")).count().writeStream \
            .outputMode("append").format("memory").queryName(f"idle_{policy}") \
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        run(q)
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    closed = {r.device_id for r in spark.sql(f"select * from idle_{policy}").collect()}
    assert closed == ({"d", "e"} if closes else set())


def test_folders_are_resolved_by_spark(spark, tmp_path):
    assert not path_exists(spark, str(tmp_path / "none")) and path_exists(spark, f"file://{tmp_path}")
