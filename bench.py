"""Time the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line. Each query is executed in
full into Spark's ``noop`` sink (nothing is pulled to the driver); the
session is warmed up first by running every query once on the sf0.001
tables (JIT and code generation), so the timings are steady-state.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetpulse.plans.catalog import QUERIES  # noqa: E402
from fleetpulse.session import build_session  # noqa: E402

HEADLINE = [
    "p95_sliding_30s_5s",          # the reference job's own windows
    "p95_sliding_1d_4h",
    "p95_by_event_type_sliding",   # few, large groups: real interpolation
    "p95_global",                  # one group holding every row
    "p95_from_panes",
    "metric_rows",
    "idempotent_append",
    "latest_for_device",           # reference test ceiling: < 100 ms on 50 rows
    "top_devices_observed",        # with the lookup: < 1000 ms on 1000 rows
    "newest_per_device",
    "late_events",
    "usage_bands",
    "stream_append_matches_batch",
]


def stored_table_reads(spark, sf_dir: str) -> dict[str, float]:
    """The reference's read path: build the metrics table once (idempotent
    append into the shared folder), then time one device lookup and one
    top-10 against the stored Parquet table."""
    from fleetpulse.operators.clean import to_metric_rows
    from fleetpulse.operators.results import compute_results
    from fleetpulse.plans import metrics as M
    from fleetpulse.session import shared_path
    from fleetpulse.sources.events import load_events
    from fleetpulse.sources.store import MetricsTable

    out = {}
    table = MetricsTable(spark, shared_path(spark, "bench-table"))
    t0 = time.perf_counter()
    table.append(to_metric_rows(compute_results(load_events(spark, sf_dir), "1 day", "4 hours")))
    out["table_build_append"] = round(time.perf_counter() - t0, 3)
    scan = table.scan()
    M.latest_for_device(scan, "7").collect()          # warm the read path
    M.top_devices(scan, 10).collect()
    t0 = time.perf_counter()
    M.latest_for_device(table.scan(), "7").collect()
    out["stored_lookup"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    M.top_devices(table.scan(), 10).collect()
    out["stored_top10"] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          app_name="fleetpulse-bench")
    # Warm-up: every query once on the smallest tables (JIT, codegen).
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not sys.argv[1:]:
        times.update(stored_table_reads(spark, sf_dir))
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
