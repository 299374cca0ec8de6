"""Late-event side output: the two-level running max equals a plain
window, and the lateness rule on the reference's delay sequence."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import T0, events_df
from fleetpulse.operators.late import late_events, max_seen_before


def test_two_level_running_max_equals_plain(spark):
    rnd = random.Random(5)
    rows = [(f"d{i % 3}", T0 + rnd.randrange(10_000_000), 1.0) for i in range(3000)]
    df = events_df(spark, rows).withColumn("arr", F.monotonically_increasing_id()) \
        .withColumn("tie", F.col("arr"))
    df = df.select("device_id", "timestamp", "cpu_usage", "ts",
                   (F.col("arr") % 1000 * 7 + F.col("arr") / 1000).cast("long").alias("arr"),
                   "tie")
    mine = max_seen_before(df, "timestamp", "arr", "tie", chunk=8).select("arr", "tie", "max_before")
    plain = df.withColumn("max_before", F.max("timestamp").over(
        Window.orderBy("arr", "tie").rowsBetween(Window.unboundedPreceding, -1))) \
        .select("arr", "tie", "max_before")
    assert sorted(mine.collect()) == sorted(plain.collect())


def test_delay_sequence(spark):
    # arrival order as listed; only the row at T0+2000 is too late for all
    # of its windows (its last window closes at 5000 + 30000 + 70000).
    seq = [0, 4000, 29999, 65000, 1000, 101000, 2000, 102000]
    rows = [("device-001", T0 + t, 1.0) for t in seq]
    df = events_df(spark, rows)
    df = spark.createDataFrame(
        [(r.device_id, r.timestamp, r.cpu_usage, i) for i, r in enumerate(df.collect())],
        "device_id string, timestamp long, cpu_usage double, arr long")
    late = late_events(df, "arr", "arr").collect()
    assert [r.timestamp - T0 for r in late] == [2000]
    assert late[0].message == f"Late event: device-001 at {T0 + 2000}"


def test_on_time_is_the_complement(spark):
    from fleetpulse.operators.late import on_time_events

    seq = [0, 4000, 29999, 65000, 1000, 101000, 2000, 102000]
    df = spark.createDataFrame([("device-001", T0 + t, 1.0, i) for i, t in enumerate(seq)],
                               "device_id string, timestamp long, cpu_usage double, arr long")
    kept = sorted(r.timestamp - T0 for r in on_time_events(df, "arr", "arr").collect())
    assert kept == sorted(t for t in seq if t != 2000)


def test_running_max_with_many_rows_of_one_arrival_number(spark):
    # Half of the rows share one arrival number, a chunk beside it is full of small ones; chunks of 8.
    rnd = random.Random(9)
    rows = []
    for i in range(2400):
        arr = 20 if i % 2 else rnd.choice([rnd.randrange(8), 16 + rnd.randrange(8), rnd.randrange(4000)])
        rows.append((f"d{i}", T0 + rnd.randrange(10_000_000), arr, rnd.choice([i, i * 10 ** 15])))
    for tie in ("long", "string"):
        df = spark.createDataFrame(rows, "device_id string, timestamp long, arr long, tie long") \
            .withColumn("tie", F.col("tie").cast(tie))
        mine = max_seen_before(df, "timestamp", "arr", "tie", chunk=8)
        assert mine.columns == ["device_id", "timestamp", "arr", "tie", "max_before"]
        plain = df.withColumn("max_before", F.max("timestamp").over(
            Window.orderBy("arr", "tie", "timestamp").rowsBetween(Window.unboundedPreceding, -1)))
        key = lambda r: (r.device_id, r.max_before or 0)
        assert sorted(mine.collect(), key=key) == sorted(plain.collect(), key=key)


def test_no_unit_of_a_tied_arrival_number_holds_it_all(spark):
    # One arrival number for half of the rows: the window's partitions stay near the chunk.
    n, chunk = 4000, 100
    df = spark.range(n).select(F.concat(F.lit("d"), "id").alias("device_id"), (F.lit(T0) + F.col("id")).alias("timestamp"),
                               F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).cast("long").alias("arr"),
                               F.col("id").alias("tie"))
    out = max_seen_before(df, "timestamp", "arr", "tie", chunk=chunk)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "_before_in#" in line and "Window" in line]
    assert windows and "_own" in windows[0] and "_part" in windows[0]
    assert out.filter("max_before is null").count() == 1


def test_null_arrival_numbers_and_an_empty_table(spark):
    schema = "device_id string, timestamp long, arr long, tie long"
    df = spark.createDataFrame([("a", T0, None, 1), ("b", T0 + 5, None, 2), ("c", T0 + 1, 3, 1)], schema)
    assert max_seen_before(df, "timestamp", "arr", "tie", chunk=2).count() == 3
    assert max_seen_before(df.limit(0), "timestamp", "arr", "tie").count() == 0
