"""The writer stream keeps what the table cannot take apart from what it can."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import T0
from fleetpulse.operators.clean import split_storable, to_metric_rows
from fleetpulse.sources.codec import decode_results
from fleetpulse.sources.store import MetricsTable
from fleetpulse.streaming.streams import read_result_stream, start_writer_stream

GOOD = {"id": "a", "deviceId": "d1", "windowStart": T0, "windowEnd": T0 + 5, "percentile95": 50.0, "lastUpdated": T0 + 9}
NO_ID = {k: v for k, v in GOOD.items() if k != "id"}
BROKEN = '{"id": "b", "deviceId"'


def _write(folder, name, lines, at):
    os.makedirs(folder, exist_ok=True)
    with open(folder / name, "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    os.utime(folder / name, (at, at))


def _run(spark, tmp_path, table, ckpt, validate, rejects):
    q = start_writer_stream(read_result_stream(spark, "text", str(tmp_path / "in"), max_files_per_trigger=1), table,
                            str(tmp_path / ckpt), validate, rejects, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None


@pytest.mark.parametrize("validate", ["none", "strict"])
def test_a_bad_record_does_not_hold_up_its_batch(spark, tmp_path, validate):
    _write(tmp_path / "in", "0.json", [GOOD, NO_ID, BROKEN], 1000)
    _write(tmp_path / "in", "1.json", [dict(GOOD, id="z"), dict(GOOD, id="x" * 256), dict(GOOD, id="y", deviceId=None)], 1001)
    table = MetricsTable(spark, str(tmp_path / "t"))
    rejects = str(tmp_path / "r")
    _run(spark, tmp_path, table, "c1", validate, rejects)
    assert sorted(r.event_id for r in table.scan().collect()) == ["a", "z"]
    first = sorted((r.batch_id, r.reject_reason, r.record or "") for r in spark.read.parquet(rejects).collect())
    no_device = "null_device_id" if validate == "none" else "invalid_device_id"
    assert first == sorted([(0, "null_event_id", ""), (0, "undecodable_record", BROKEN), (1, "event_id_too_long", ""),
                            (1, no_device, "")])
    # the same batches again, as after a lost checkpoint: nothing changes
    _run(spark, tmp_path, table, "c2", validate, rejects)
    assert sorted(r.event_id for r in table.scan().collect()) == ["a", "z"]
    assert sorted((r.batch_id, r.reject_reason, r.record or "") for r in spark.read.parquet(rejects).collect()) == first


def test_rejects_go_beside_the_table_by_default(spark, tmp_path):
    _write(tmp_path / "in", "0.json", [GOOD, BROKEN], 1000)
    table = MetricsTable(spark, str(tmp_path / "t"))
    _run(spark, tmp_path, table, "c", "none", None)
    assert spark.read.parquet(table.path + "-rejects").count() == 1 and table.scan().count() == 1


def test_the_first_to_arrive_is_stored(spark, tmp_path):
    """Not the one with the smaller clock reading."""
    _write(tmp_path / "in", "0.json", [dict(GOOD, percentile95=1.0, lastUpdated=T0 + 900)], 1000)
    _write(tmp_path / "in", "1.json", [dict(GOOD, percentile95=2.0, lastUpdated=T0 + 1)], 2000)
    table = MetricsTable(spark, str(tmp_path / "t"))
    q = start_writer_stream(read_result_stream(spark, "text", str(tmp_path / "in")), table, str(tmp_path / "c"),
                            available_now=True)
    q.awaitTermination(600)
    assert [r.percentile_95 for r in table.scan().collect()] == [1.0]


def test_direct_appends_still_refuse_a_null_id(spark, tmp_path):
    rows = to_metric_rows(decode_results(spark.createDataFrame([(json.dumps(NO_ID),)], "value string")))
    with pytest.raises(ValueError):
        MetricsTable(spark, str(tmp_path / "t")).append(rows)


def test_reasons_in_order(spark):
    lines = [GOOD, dict(GOOD, windowEnd=T0), dict(GOOD, id=None, deviceId=None), {}, "null", "", "[1]",
             dict(GOOD, windowStart="no number")]
    df = decode_results(spark.createDataFrame([(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(lines)],
                                              "n int, value string"), keep=("n",), record=True)
    rows = to_metric_rows(df, keep=("n", "record"))
    told = lambda mode: {r.n: r.reject_reason for r in split_storable(rows, mode)[1].collect()}
    broken = {4: "undecodable_record", 5: "undecodable_record", 6: "undecodable_record", 7: "undecodable_record"}
    assert told("none") == {2: "null_event_id", 3: "null_event_id", **broken}
    assert told("strict") == {1: "invalid_window_range", 2: "invalid_device_id", 3: "null_metric", **broken}
    with pytest.raises(ValueError):
        split_storable(rows, "maybe")
