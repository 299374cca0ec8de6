"""Findings of round 4: what the append moves and keeps on disk."""

import os
import time

from pyspark.sql import functions as F

from fleetpulse.session import drop_dead_shuffles, shared_path
from fleetpulse.sources import store
from fleetpulse.streaming.replay import writer_replay
from fleetpulse.streaming.streams import _as_columns
from fleetpulse.sources.store import MetricsTable, apply_append, first_per_id, new_rows, packed_id, unpacked_id

ROW = "event_id string, device_id string, percentile_95 double, last_updated long"
HASH = "0123456789abcdef" * 4


def test_f1_the_append_shuffles_once_by_packed_ids(spark):
    """No join beside the collapse, and no digits of a hash on the way."""
    frame = lambda n: spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
                                            F.lit("d").alias("device_id"), F.rand(1).alias("percentile_95"),
                                            F.col("id").alias("last_updated"))
    rows = new_rows(frame(200), frame(100))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_id") == plan.count("Exchange ") == 1
    assert "Join" not in plan and plan.count("WindowGroupLimit") == 2      # before and after the shuffle
    assert rows.count() == 100


def test_f1_packed_ids_are_as_short_as_hashes_and_come_back(spark):
    ids = [HASH, HASH.upper(), HASH[1:], "", "00", "0", "g", "id-1", "é", "0123 ", "\x010", None]
    got = spark.createDataFrame([(x,) for x in ids], "id string").select(
        "id", packed_id(F.col("id")).alias("p")).select("id", "p", unpacked_id(F.col("p")).alias("back")).collect()
    assert all(r.id == r.back for r in got)
    assert len({None if r.p is None else bytes(r.p) for r in got}) == len(ids)
    assert len(got[0].p) == 33


def test_f1_first_rows_and_stored_ids_as_before(spark):
    batch = [(HASH, "b", 2.0, 5), (HASH, "a", 3.0, 5), (HASH.upper(), "a", 1.0, 9), ("x", None, 1.0, None),
             ("x", "d", float("nan"), 1), (None, "d", 1.0, 2), (None, "c", 1.0, 2), ("y", "d", 7.0, 1), ("y", "d", None, 1)]
    first = [(HASH, "a", 3.0, 5), (HASH.upper(), "a", 1.0, 9), ("x", None, 1.0, None), (None, "c", 1.0, 2), ("y", "d", None, 1)]
    stored = [("y", "e", 0.0, 0), ("y", "e", 0.0, 0), (HASH, "e", 0.0, 0), (None, "e", 0.0, 0)]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    b, s = spark.createDataFrame(batch, ROW), spark.createDataFrame(stored, ROW)
    assert order(first_per_id(b).collect()) == order(first)
    left = [r for r in first if r[0] not in ("y", HASH)]         # a null id equals no stored one
    assert order(new_rows(b, s).collect()) == order(left)
    assert order(apply_append(s, b).collect()) == order(stored + left)
    # an order that the table does not keep, here of a struct
    arrival = b.withColumn("at", F.struct(F.length("device_id").alias("n"), -F.col("percentile_95")))
    assert order(new_rows(arrival, s, ("at",)).drop("at").collect()) == order(left)


def wire(spark, n, device="d"):
    """Records on the wire; one in ten without an id, one in ten no JSON."""
    json_text = F.to_json(F.struct(
        F.when(F.col("id") % 10 != 3, F.sha2(F.col("id").cast("string"), 256)).alias("id"), F.lit(device).alias("deviceId"),
        (F.col("id") + 1).alias("windowStart"), (F.col("id") + 2).alias("windowEnd"), F.rand(1).alias("percentile95"),
        F.col("id").alias("lastUpdated")))
    return spark.range(n).select(F.when(F.col("id") % 10 == 4, F.lit("{")).otherwise(json_text).alias("value"))


def files_under(path, end):
    return [f"{at}/{f}" for at, _, names in os.walk(path) for f in names if f.endswith(end)]


def test_f2_records_are_staged_packed_and_dealt_to_two_micro_batches(spark):
    table, rejects = writer_replay(spark, wire(spark, 2000).repartition(1), 8)
    base = os.path.dirname(table.path)
    assert os.listdir(base).count("staged") == 0
    text = files_under(f"{base}/records", ".txt.gz")
    assert len(text) == 8 and not files_under(f"{base}/records", ".txt")
    raw = sum(len(r.value) + 1 for r in spark.read.text(f"{base}/records").collect())
    assert sum(map(os.path.getsize, text)) < 0.6 * raw
    assert len(files_under(f"{base}/ckpt-0/commits", "")) - len(files_under(f"{base}/ckpt-0/commits", ".crc")) == 2
    assert table.scan().count() == 1600 and table.duplicate_ids().count() == 0
    assert {r.reject_reason: r["count"] for r in rejects.groupBy("reject_reason").count().collect()} == {
        "null_event_id": 200, "undecodable_record": 200}
    assert len(files_under(table.path, ".parquet")) == len(files_under(table.path, ".zstd.parquet")) > 0


def test_f2_many_tasks_write_their_own_files_without_a_shuffle(spark):
    table, _ = writer_replay(spark, wire(spark, 2000).repartition(16), 8, runs=1)
    base = os.path.dirname(table.path)
    assert len(files_under(f"{base}/records", ".txt.gz")) == 16
    assert table.scan().count() == 1600


def test_f2_an_arrival_is_cached_as_columns_that_sort_like_it(spark):
    rows = spark.range(20_000).select("id", F.struct(F.lit(7).alias("at"), F.lit("/a/long/path" * 20).alias("path")).alias("arrival"))
    size = lambda: sum(x.memSize() + x.diskSize() for x in spark.sparkContext._jsc.sc().getRDDStorageInfo())

    def held(df):
        before, df = size(), df.persist()
        df.count()
        taken = size() - before
        df.unpersist(True)
        return taken

    flat, order = _as_columns(rows, "arrival")
    assert flat.columns == ["id", *order]
    assert held(flat) * 10 < held(rows)
    odd = spark.createDataFrame([(0, (1, "b")), (1, (1, "a")), (2, (None, "z")), (3, (None, None)), (4, None), (5, (0, "c"))],
                                "n int, arrival struct<at: int, path: string>")
    flat, order = _as_columns(odd, "arrival")
    assert [r.n for r in flat.orderBy(*order).collect()] == [r.n for r in odd.orderBy("arrival").collect()]
    assert _as_columns(rows, "id") == (rows, ["id"])


def test_f2_an_append_keeps_only_what_it_stores_and_gives_its_shuffles_back(spark, monkeypatch):
    frames = type(spark.range(0))
    held, given_back, persist = [], [], frames.persist
    monkeypatch.setattr(frames, "persist", lambda df, *a: held.append(df.schema) or persist(df, *a))
    monkeypatch.setattr(store, "drop_dead_shuffles", given_back.append)
    monkeypatch.setattr(store, "MANY_ROWS", 3)
    fields = ("event_id string, device_id string, window_start long, window_end long, percentile_95 double, "
              "last_updated long, created_at timestamp, window_date date, at string")
    frame = lambda ids: spark.createDataFrame([(i, "d", 1, 2, 3.0, 4, None, None, f"{k}") for k, i in enumerate(ids)], fields)
    table = MetricsTable(spark, shared_path(spark, "f2"))
    batch = persist(frame([HASH, "b", "b"]))
    table.append(batch, ("at",), cached=True)
    assert len(held) == 1 and "at" not in held[0].names and held[0]["_id"].dataType.simpleString() == "binary"
    assert len(given_back) == 1
    table.append(frame(["b", "c"]), ("at",))
    assert len(held) == 3 and len(given_back) == 1
    assert sorted(r.event_id for r in table.scan().collect()) == sorted([HASH, "b", "c"])


def test_f2_dead_shuffles_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = disk.getAllFiles()
        return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))

    before = shuffles()
    assert spark.range(1000).repartition(3, "id").groupBy().count().collect()[0][0] == 1000
    assert shuffles() > before
    for _ in range(50):
        drop_dead_shuffles(spark)
        time.sleep(0.2)
        if shuffles() <= before:
            break
    assert shuffles() <= before
