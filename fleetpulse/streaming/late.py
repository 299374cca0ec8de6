"""O-31 in streaming form: rows too late for every window go to a
quarantine table.

A second query over the same source. Its ``foreachBatch`` keeps the max
event time so far, one small file per batch id beside the checkpoint, of which
a batch reads its predecessor's alone; a row of batch k is late when its last
window closed before the max event time of batches < k:

    floor(t / slide) * slide + size + out_of_orderness + lateness <= max_{<k}

Replaying batch k (after a failure) reads the same earlier maxima and
overwrites its own partition of the quarantine table, so it is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.clean import valid_events
from ..operators.late import (ALLOWED_LATENESS_MS, DEFAULT_SIZE_MS, DEFAULT_SLIDE_MS,
                              OUT_OF_ORDERNESS_MS, close_time)
from ..operators.windows import parse_duration_ms
from ..session import delete_path, read_number, start_with_partitions, write_number


def start_quarantine_stream(events: DataFrame, quarantine_path: str, state_path: str,
                            checkpoint: str, size=DEFAULT_SIZE_MS, slide=DEFAULT_SLIDE_MS,
                            out_of_orderness=OUT_OF_ORDERNESS_MS,
                            lateness=ALLOWED_LATENESS_MS, available_now: bool = True,
                            state_partitions: int | None = None):
    size_ms, slide_ms = parse_duration_ms(size), parse_duration_ms(slide)
    ooo_ms, late_ms = parse_duration_ms(out_of_orderness), parse_duration_ms(lateness)
    spark = events.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        prev = read_number(spark, f"{state_path}/{batch_id - 1}")
        batch = valid_events(batch).persist()
        try:
            if prev is not None:
                late = batch.filter(close_time(F.col("timestamp"), size_ms, slide_ms, ooo_ms,
                                               late_ms) <= F.lit(int(prev)))
                (late.withColumn("message", F.concat(F.lit("Late event: "), F.col("device_id"),
                                                     F.lit(" at "),
                                                     F.col("timestamp").cast("string")))
                 .withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(quarantine_path))
            top = batch.agg(F.max("timestamp")).first()[0]
            top = max((int(x) for x in (prev, top) if x is not None), default=None)
            if top is not None:
                write_number(spark, f"{state_path}/{batch_id}", top)
            delete_path(spark, f"{state_path}/{batch_id - 2}")
        finally:
            batch.unpersist()

    w = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return start_with_partitions(w, spark, state_partitions)


def read_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """The quarantined rows (none, if no row was ever late)."""
    try:
        return spark.read.parquet(quarantine_path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "device_id string, timestamp long, cpu_usage double, ts timestamp, "
                                         "event_id long, arrival long, message string, batch_id long")
