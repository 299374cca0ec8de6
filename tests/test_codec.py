"""JSON decode/encode: defaults, unknown fields, malformed records."""

from fleetpulse.sources import codec


def test_decode_defaults_and_quarantine(spark):
    lines = [
        '{"deviceId":"device-001","timestamp":1692617400000,"cpuUsage":75.5}',
        '{"deviceId":"device-002","timestamp":1692617400000}',
        '{"deviceId":"device-003","cpuUsage":1.5,"extra":"x"}',
        '{"timestamp":5,"cpuUsage":2.0}',
        'not json at all',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = codec.split_decoded(codec.decode_events(df))
    rows = sorted(good.collect(), key=lambda r: str(r.device_id))
    assert [(r.device_id, r.timestamp, r.cpu_usage) for r in rows] == [
        (None, 5, 2.0),
        ("device-001", 1692617400000, 75.5),
        ("device-002", 1692617400000, 0.0),
        ("device-003", 0, 1.5)]
    assert [r.raw for r in bad.collect()] == ["not json at all"]


def test_round_trip(spark):
    df = spark.createDataFrame([("d", 10, 1.25), ("e", 20, 99.0)],
                               "device_id string, timestamp long, cpu_usage double")
    back = codec.decode_events(codec.encode_events(df)).drop("_corrupt")
    assert sorted(back.collect()) == sorted(df.collect())


def test_result_encoding(spark):
    df = spark.createDataFrame([("i", "d", 1, 2, 3.5, 4)],
                               "id string, device_id string, window_start long, "
                               "window_end long, percentile_95 double, last_updated long")
    v = codec.encode_results(df).collect()[0].value
    assert v == ('{"id":"i","deviceId":"d","windowStart":1,"windowEnd":2,'
                 '"percentile95":3.5,"lastUpdated":4}')
    back = codec.decode_results(codec.encode_results(df)).collect()[0]
    assert tuple(back) == ("i", "d", 1, 2, 3.5, 4)
