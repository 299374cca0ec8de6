import math
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetpulse.session import build_session  # noqa: E402

# Fixed instant used by the reference's aggregate tests.
T0 = 1692617400000


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="fleetpulse-test-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="fleetpulse-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def legacy_p95(values):
    """Plain-Python statement of the percentile rule, for checks."""
    if len(values) == 0:
        return 0.0
    if len(values) == 1:
        return values[0]
    xs = sorted(v for v in values if not math.isnan(v))
    n = len(xs)
    if n == 0:
        return float("nan")
    pos = 0.95 * (n + 1)
    if pos < 1:
        return xs[0]
    if pos >= n:
        return xs[-1]
    f = math.floor(pos)
    return xs[f - 1] + (pos - f) * (xs[f] - xs[f - 1])


def events_df(spark, rows):
    """rows: (device_id, timestamp_ms, cpu_usage)."""
    from pyspark.sql import functions as F

    from fleetpulse.schema import EVENT_SCHEMA

    return spark.createDataFrame(rows, EVENT_SCHEMA).withColumn(
        "ts", F.timestamp_millis("timestamp"))
