"""O-02, O-30: results leave through an outbox.

A micro-batch's results are stored under its batch id before anything else
sees them, and every target (the metrics table, a topic, a folder of files)
is served from what is stored. A batch that runs again after a failure finds
its stored results (the clock reading in them included) and the marks of the
targets already served, so a target gets every revision once: exactly once
where it replaces its own batch (files) or ignores known ids (the table), and
at least once in the moment between serving a topic and setting its mark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import to_metric_rows
from ..session import path_exists, touch
from ..sources.codec import encode_results
from ..sources.store import MetricsTable

Target = Callable[[DataFrame, int], None]

RESULT_ROW = ("id string, device_id string, window_start long, window_end long, percentile_95 double, "
              "last_updated long, win_start long, win_end long, event_count long")
RESULT_NAMES = [f.split()[0] for f in RESULT_ROW.split(", ")]


class Outbox:
    """Results by batch id in a shared folder, and the targets they go to."""

    def __init__(self, spark: SparkSession, path: str, targets: dict[str, Target]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.targets = targets

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def stored(self, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self._folder(batch_id)}/_SUCCESS")

    def read(self) -> DataFrame:
        """Every stored result, with its ``batch_id``."""
        schema = f"{RESULT_ROW}, batch_id long"
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def deliver(self, batch_id: int, results: Callable[[], DataFrame]) -> None:
        """Store the batch's results unless they are, then serve the targets
        that have not been served."""
        if not self.stored(batch_id):
            (results().select(*RESULT_NAMES).write.mode("overwrite").parquet(self._folder(batch_id)))
        rows = self.spark.read.schema(RESULT_ROW).parquet(self._folder(batch_id))
        if rows.isEmpty():
            return
        for name, put in self.targets.items():
            mark = f"{self.path}/_served/{name}/{batch_id}"
            if not path_exists(self.spark, mark):
                put(rows, batch_id)
                touch(self.spark, mark)


def to_table(table: MetricsTable) -> Target:
    return lambda rows, batch_id: table.append(to_metric_rows(rows))


def to_files(path: str) -> Target:
    """JSON lines, one folder per batch (a batch that comes again replaces its own)."""
    return lambda rows, batch_id: encode_results(rows).write.mode("overwrite").text(
        f"{path.rstrip('/')}/batch_id={batch_id}")


def to_kafka(options: dict[str, str]) -> Target:
    return lambda rows, batch_id: encode_results(rows).write.format("kafka").options(**options).save()
