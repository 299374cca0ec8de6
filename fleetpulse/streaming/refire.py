"""O-30: windows that fire once the watermark passes their end and fire again
for every micro-batch that brings rows, up to the allowed lateness.

No built-in output mode does this for windows, but it does for their parts:

* Spark's own state holds a histogram, (device, pane, value) -> count, first
  and last time, where a pane is gcd(size, slide) wide: one state row per
  value however many windows overlap, and a hot device spread over partitions
  by value. In update mode each micro-batch hands over the rows that changed.
* Spark drops a pane when the last window over it takes no more rows, and rows
  that are too late for it before they reach the state: its delay is
  ``out_of_orderness + lateness + size - pane``.
* ``foreachBatch`` keeps what changed as a delta beside the checkpoint, rolled
  up every ``ROLL_UP`` batches into the panes that are still open, so a batch
  reads one roll-up and a bounded number of deltas. From them it assembles the
  windows that fire now: those that became due with this batch, and those due
  before, not yet closed, over a pane that changed. The percentile is the batch
  selection of ``operators.quantile``, on the JVM; no list of values exists
  anywhere.

Per micro-batch, with ``prev`` and ``now`` the greatest event time before and
after it: a window is due when ``end + out_of_orderness <= now``, newly so when
also ``> prev``; it is closed to a batch when ``end + out_of_orderness +
lateness <= prev``. A batch that runs again finds the same state, so it makes
the same revisions. Closed windows keep their last revision.

Revisions: id (a hash of device, window and event count), device_id, observed
window_start / window_end, percentile_95, last_updated, win_start, win_end,
event_count (which grows with every revision). ``last_updated`` is the window's
end when it first fires and the watermark afterwards, or the wall clock.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import result_id
from ..functions.percentile import P95
from ..operators.clean import valid_events
from ..operators.windows import parse_duration_ms, windows_of_panes
from ..session import delete_path, path_exists, read_number, write_number

PANES = "device_id string, _pane long, cpu_usage double, c long, mn long, mx long"

# Deltas that a micro-batch reads at most, before they are rolled up.
ROLL_UP = 16


def pane_updates(events: DataFrame, size, slide, out_of_orderness, lateness) -> DataFrame:
    """The stateful part, for update mode: (device_id, _pane, cpu_usage, c,
    mn, mx), counts so far."""
    size_ms, slide_ms = parse_duration_ms(size), parse_duration_ms(slide)
    pane_ms = math.gcd(size_ms, slide_ms)
    delay = parse_duration_ms(out_of_orderness) + parse_duration_ms(lateness) + size_ms - pane_ms
    return (valid_events(events).withWatermark("ts", f"{delay} milliseconds")
            .withColumn("cpu_usage", F.col("cpu_usage") + F.lit(0.0))
            .groupBy("device_id", F.window("ts", f"{pane_ms} milliseconds").alias("w"), "cpu_usage")
            .agg(F.count(F.lit(1)).alias("c"), F.min("timestamp").alias("mn"), F.max("timestamp").alias("mx"))
            .select("device_id", F.unix_millis("w.start").alias("_pane"), "cpu_usage", "c", "mn", "mx"))


class Revisions:
    """What the micro-batches of one query have brought so far, in a shared
    folder, and the revisions that follow."""

    def __init__(self, spark, path: str, size, slide, out_of_orderness, lateness, p: float = P95):
        self.spark = spark
        self.path = path.rstrip("/")
        self.size_ms, self.slide_ms = parse_duration_ms(size), parse_duration_ms(slide)
        self.pane_ms = math.gcd(self.size_ms, self.slide_ms)
        self.ooo_ms, self.late_ms = parse_duration_ms(out_of_orderness), parse_duration_ms(lateness)
        self.p = p

    def _held(self, batch_id: int) -> DataFrame:
        """The panes as batches before this one left them: parts that merge
        by the greatest count."""
        base = (batch_id - 1) // ROLL_UP * ROLL_UP if batch_id else 0
        folders = [f"{self.path}/panes/{base}"] + [f"{self.path}/changes/{k}" for k in range(base, batch_id)]
        folders = [f for f in folders if path_exists(self.spark, f"{f}/_SUCCESS")]
        if not folders:
            return self.spark.createDataFrame([], PANES)
        return self.spark.read.schema(PANES).parquet(*folders)

    @staticmethod
    def _merged(parts: DataFrame, *more) -> DataFrame:
        # Counts only grow: of the states of one pane value the latest has the greatest.
        return parts.groupBy("device_id", "_pane", "cpu_usage").agg(
            F.max("c").alias("c"), F.min("mn").alias("mn"), F.max("mx").alias("mx"), *more)

    def record(self, changes: DataFrame, batch_id: int) -> tuple[int | None, int | None]:
        """Keep a batch's changes; the greatest event time before and after
        (None after a batch without rows)."""
        prev = read_number(self.spark, f"{self.path}/clock/{batch_id - 1}")
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/{batch_id}")
        top = self.spark.read.schema(PANES).parquet(f"{self.path}/changes/{batch_id}").agg(F.max("mx")).first()[0]
        now = max((x for x in (prev, top) if x is not None), default=None)
        if now is not None:
            write_number(self.spark, f"{self.path}/clock/{batch_id}", now)
        if batch_id and batch_id % ROLL_UP == 0:
            parts = self._held(batch_id)
            if prev is not None:    # panes whose windows all take no more rows are left behind
                parts = parts.filter(F.col("_pane") + F.lit(self.size_ms + self.ooo_ms + self.late_ms) > prev)
            self._merged(parts).write.mode("overwrite").parquet(f"{self.path}/panes/{batch_id}")
            self._forget(batch_id - ROLL_UP)
        return prev, None if top is None else now

    def _forget(self, before: int) -> None:
        """Folders that no batch reads again."""
        for k in range(max(0, before - ROLL_UP), before):
            for kind in ("changes", "clock"):
                delete_path(self.spark, f"{self.path}/{kind}/{k}")
        delete_path(self.spark, f"{self.path}/panes/{before - ROLL_UP}")

    def of_batch(self, batch_id: int, prev: int | None, now: int | None, wall_ms: int | None = None) -> DataFrame:
        """The windows that fire with this batch."""
        changes = self.spark.read.schema(PANES).parquet(f"{self.path}/changes/{batch_id}")
        end = F.col("win_start") + F.lit(self.size_ms)
        due = end + F.lit(self.ooo_ms) <= F.lit(now)
        newly = F.lit(True) if prev is None else end + F.lit(self.ooo_ms) > F.lit(prev)
        open_ = F.lit(True) if prev is None else end + F.lit(self.ooo_ms + self.late_ms) > F.lit(prev)
        panes = self._held(batch_id).withColumn("_new", F.lit(False)) \
            .unionByName(changes.withColumn("_new", F.lit(True)))
        if prev is not None:
            panes = panes.filter(F.col("_pane") + F.lit(self.size_ms + self.ooo_ms + self.late_ms) > F.lit(prev))
        # Windows due before fire again over a pane that changed.
        res = windows_of_panes(self._merged(panes, F.max("_new").alias("_new")), self.size_ms, self.slide_ms,
                               self.pane_ms, ["device_id"], p=self.p, where=due & (newly | open_), touched="_new",
                               always=newly)
        clock = F.lit(wall_ms).cast("long") if wall_ms is not None else \
            F.when(newly, end).otherwise(F.greatest(end, F.lit(now - self.ooo_ms)))
        win_end = end.alias("win_end")
        return res.select(
            result_id(F.col("device_id"), F.col("win_start"), end, F.col("event_count")).alias("id"),
            "device_id", "window_start", "window_end", "percentile_95",
            clock.cast("long").alias("last_updated"), "win_start", win_end, "event_count")


def revisions_writer(revisions: Revisions, outbox, live_clock: bool = False):
    """The ``foreachBatch`` function: changes -> revisions -> outbox."""
    def write(batch: DataFrame, batch_id: int) -> None:
        prev, now = revisions.record(batch, batch_id)
        if now is not None:         # without a row nothing becomes due and nothing changes
            wall = int(time.time() * 1000) if live_clock else None
            outbox.deliver(batch_id, lambda: revisions.of_batch(batch_id, prev, now, wall))
    return write
