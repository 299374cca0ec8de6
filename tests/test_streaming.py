"""Streaming: re-firing on the reference's delay sequence, quarantine,
stream-equals-batch and replay idempotence (file sources, availableNow)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import T0, events_df
from fleetpulse.operators.windows import window_p95
from fleetpulse.session import shared_path
from fleetpulse.sources.store import MetricsTable
from fleetpulse.streaming.late import start_quarantine_stream
from fleetpulse.streaming.streams import (kafka_sink_options, kafka_source_options,
                                          read_event_stream, start_metrics_stream)

# Rows (ms after T0) per micro-batch, in arrival order.
SEQUENCE = [[0, 4000, 29999], [65000], [1000], [101000], [2000], [102000]]


def write_batches(folder, batches, device="device-001"):
    os.makedirs(folder, exist_ok=True)
    for i, grp in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            for t in grp:
                f.write(json.dumps({"deviceId": device, "timestamp": T0 + t,
                                    "cpuUsage": float(t % 97)}) + "\n")
        os.utime(path, (1000 + i, 1000 + i))


def run(q):
    q.awaitTermination(600)
    assert q.exception() is None


@pytest.fixture()
def seq_stream(spark, tmp_path):
    write_batches(str(tmp_path / "src"), SEQUENCE)
    return read_event_stream(spark, "json", str(tmp_path / "src"), max_files_per_trigger=1)


def test_quarantine_sequence(spark, seq_stream, tmp_path):
    qpath = str(tmp_path / "quarantine")
    run(start_quarantine_stream(seq_stream, qpath, str(tmp_path / "state"),
                                str(tmp_path / "ck2")))
    rows = spark.read.parquet(qpath).collect()
    assert [r.timestamp - T0 for r in rows] == [2000]
    assert rows[0].message == f"Late event: device-001 at {T0 + 2000}"


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path):
    import random

    rnd = random.Random(11)
    rows = [(f"device-{rnd.randrange(4):03d}", T0 + rnd.randrange(300_000),
             round(rnd.uniform(0, 100), 2)) for _ in range(300)]
    rows.sort(key=lambda r: r[1])
    src = tmp_path / "src"
    os.makedirs(src)
    for i in range(3):
        path = src / f"part-{i}.json"
        with open(path, "w") as f:
            for d, t, v in rows[i * 100:(i + 1) * 100]:
                f.write(json.dumps({"deviceId": d, "timestamp": t, "cpuUsage": v}) + "\n")
        os.utime(path, (1000 + i, 1000 + i))
    table = MetricsTable(spark, shared_path(spark, "stream-eq"))
    stream = read_event_stream(spark, "json", str(src), max_files_per_trigger=1)
    run(start_metrics_stream(stream, table, str(tmp_path / "ck3")))
    got = {(r.device_id, r.window_start, r.window_end, r.percentile_95)
           for r in table.scan().collect()}
    max_t = max(t for _, t, _ in rows)
    batch = window_p95(events_df(spark, rows), "30 seconds", "5 seconds", method="array")
    want = {(r.device_id, r.window_start, r.window_end, r.percentile_95)
            for r in batch.filter(F.col("win_end") <= max_t - 35_000).collect()}
    assert got == want
    n = table.scan().count()
    # the same data again through a fresh checkpoint: nothing new is stored
    stream = read_event_stream(spark, "json", str(src), max_files_per_trigger=1)
    run(start_metrics_stream(stream, table, str(tmp_path / "ck4")))
    assert table.scan().count() == n
    assert table.duplicate_ids().count() == 0


def test_kafka_option_maps():
    o = kafka_source_options("broker:9092", max_offsets=500)
    assert o["subscribe"] == "events" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "500"
    assert kafka_sink_options("broker:9092")["topic"] == "processed-events"


def test_writer_stream_validates_and_dedups(spark, tmp_path):
    from fleetpulse.streaming.streams import read_result_stream, start_writer_stream

    src = tmp_path / "results"
    os.makedirs(src)
    recs = [{"id": "a", "deviceId": "d1", "windowStart": T0, "windowEnd": T0 + 5, "percentile95": 50.0,
             "lastUpdated": T0 + 9},
            {"id": "a", "deviceId": "d1", "windowStart": T0, "windowEnd": T0 + 5, "percentile95": 50.0,
             "lastUpdated": T0 + 9},
            {"id": "b", "deviceId": " ", "windowStart": T0, "windowEnd": T0 + 5, "percentile95": 50.0,
             "lastUpdated": T0 + 9},
            {"id": "c", "deviceId": "d2", "windowStart": T0, "windowEnd": T0, "percentile95": 10.0,
             "lastUpdated": T0 + 9}]
    with open(src / "part-0.json", "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    table = MetricsTable(spark, shared_path(spark, "writer"))
    rej = str(tmp_path / "rejected")
    run(start_writer_stream(read_result_stream(spark, "text", str(src)), table,
                            str(tmp_path / "ck5"), validate="strict", reject_path=rej,
                            available_now=True))
    assert [r.event_id for r in table.scan().collect()] == ["a"]
    assert sorted(r.reject_reason for r in spark.read.parquet(rej).collect()) == [
        "invalid_device_id", "invalid_window_range"]


def test_stream_equals_batch_on_shuffled_input(spark, tmp_path):
    """Rows arrive out of order (shuffled inside each micro-batch and up to
    20 s late across batches, below the 35 s bound): every closed window
    still equals the batch result."""
    import random

    rnd = random.Random(5)
    rows = [(f"device-{rnd.randrange(3):03d}", T0 + rnd.randrange(240_000),
             round(rnd.uniform(0, 100), 1)) for _ in range(400)]
    # arrival = event time + up to 20 s of delay, then cut into 4 batches
    arrivals = sorted(rows, key=lambda r: r[1] + rnd.randrange(20_000))
    src = tmp_path / "src"
    os.makedirs(src)
    for i in range(4):
        part = arrivals[i * 100:(i + 1) * 100]
        rnd.shuffle(part)
        path = src / f"part-{i}.json"
        with open(path, "w") as f:
            for d, t, v in part:
                f.write(json.dumps({"deviceId": d, "timestamp": t, "cpuUsage": v}) + "\n")
        os.utime(path, (1000 + i, 1000 + i))
    table = MetricsTable(spark, shared_path(spark, "stream-shuffled"))
    stream = read_event_stream(spark, "json", str(src), max_files_per_trigger=1)
    run(start_metrics_stream(stream, table, str(tmp_path / "ck6"), state_partitions=3))
    got = {(r.device_id, r.window_start, r.window_end, r.percentile_95)
           for r in table.scan().collect()}
    max_t = max(t for _, t, _ in rows)
    batch = window_p95(events_df(spark, rows), "30 seconds", "5 seconds")
    want = {(r.device_id, r.window_start, r.window_end, r.percentile_95)
            for r in batch.filter(F.col("win_end") <= max_t - 35_000).collect()}
    assert got == want


def test_state_partitions_do_not_leak_into_the_session(spark, seq_stream, tmp_path):
    from fleetpulse.session import start_with_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    w = (seq_stream.groupBy("device_id").count().writeStream.outputMode("complete")
         .format("memory").queryName("parts_probe")
         .option("checkpointLocation", str(tmp_path / "ck7")).trigger(availableNow=True))
    run(start_with_partitions(w, spark, 3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.sql("select sum(count) as n from parts_probe").collect()[0].n == 8
