"""The writer's six validation rules, their order, and the row mapping."""

from pyspark.sql import types as T

from fleetpulse.operators import clean

SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("device_id", T.StringType()),
    T.StructField("window_start", T.LongType()), T.StructField("window_end", T.LongType()),
    T.StructField("percentile_95", T.DoubleType()), T.StructField("last_updated", T.LongType()),
])

CASES = [
    (("e1", "dev", 1000, 2000, 50.0, 3000), None),
    ((None, None, None, None, None, None), clean.REASON_NULL),
    (("e2", "   ", 1000, 2000, 50.0, 3000), clean.REASON_DEVICE),
    (("e3", None, 1000, 2000, 50.0, 3000), clean.REASON_DEVICE),
    (("e4", "dev", 0, 2000, 50.0, 3000), clean.REASON_TIMES),
    (("e5", "dev", 2000, 2000, 50.0, 3000), clean.REASON_RANGE),
    (("e6", "dev", 1000, 2000, -0.1, 3000), clean.REASON_P95),
    (("e7", "dev", 1000, 2000, 100.1, 3000), clean.REASON_P95),
    (("e8", "dev", 1000, 2000, 50.0, 0), clean.REASON_UPDATED),
    # several rules fail: the first one in order wins
    (("e9", " ", 0, 0, 200.0, 0), clean.REASON_DEVICE),
    (("e10", "dev", 5000, 2000, 200.0, 0), clean.REASON_RANGE),
]


def test_rules_and_order(spark):
    df = spark.createDataFrame([c[0] for c in CASES], SCHEMA)
    got = [r.reject_reason for r in clean.validate_metrics(df).collect()]
    assert got == [c[1] for c in CASES]


def test_split(spark):
    df = spark.createDataFrame([c[0] for c in CASES], SCHEMA)
    good, bad = clean.split_valid(df)
    assert good.count() == 1 and bad.count() == len(CASES) - 1


def test_metric_row_mapping(spark):
    res = spark.createDataFrame([("id1", "dev", 1_704_067_200_000, 1_704_067_230_000, 42.0,
                                  1_704_067_230_000)],
                                "id string, device_id string, window_start long, "
                                "window_end long, percentile_95 double, last_updated long")
    r = clean.to_metric_rows(res, created_at="2024-02-01 00:00:00").collect()[0]
    assert r.event_id == "id1" and str(r.window_date) == "2024-01-01"
    assert r.created_at is not None
