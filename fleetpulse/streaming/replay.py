"""Run the streaming pipeline over a table as a file stream, to completion.

Used to check the streaming path against the batch path: the events file is
read by a file-stream source with ``availableNow``, windows are closed by
the watermark, each micro-batch is appended idempotently to a metrics table
in the shared folder, and that table is returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import (default_state_partitions, delete_path, drop_dead_shuffles, files_in, move_path, path_exists,
                       shared_path)
from ..sources.codec import decode_results
from ..sources.events import bind_events, table_path
from ..sources.store import TABLE_COLUMNS, MetricsTable
from .late import read_quarantine, start_quarantine_stream
from .outbox import Outbox, to_files
from .streams import (WATERMARK_DELAY, read_result_stream, read_table_stream, start_job, start_metrics_stream,
                      start_writer_stream)


def _until_done(query) -> bool:
    query.awaitTermination()
    return True


def stream_metrics_once(spark: SparkSession, sf_dir: str, size, slide,
                        watermark: str = WATERMARK_DELAY, device: str = "user_id",
                        timeout_s: int | None = None) -> DataFrame:
    path = table_path(sf_dir, "events")
    batch = spark.read.parquet(path)
    # A table may be one file (picked by name in its folder) or a folder of files.
    single = all(f.endswith("/events.parquet") for f in batch.inputFiles())
    events = read_table_stream(spark, sf_dir if single else path, batch.schema, device,
                               glob="events.parquet" if single else None)
    table = MetricsTable(spark, shared_path(spark, "stream-metrics"), id_scope="date")
    q = start_metrics_stream(events, table, shared_path(spark, "stream-ckpt"), size, slide,
                             watermark, available_now=True,
                             state_partitions=default_state_partitions(spark))
    if not (q.awaitTermination(timeout_s) if timeout_s else _until_done(q)):
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table.scan().select(*[c for c in TABLE_COLUMNS if c != "created_at"])


class ArrivalBatches:
    """``events`` in order of arrival as the files of a stream source, one
    micro-batch after the other: written once, in parallel, several files a
    batch by volume; each batch's folder is then moved into the source's."""

    def __init__(self, spark: SparkSession, events: DataFrame, arrival: str, batches: int):
        self.spark, self.batches = spark, batches
        lo, hi = (int(x) for x in events.agg(F.min(arrival), F.max(arrival)).first())
        step = (hi - lo) // batches + 1
        self.staged, self.source = shared_path(spark, "arrivals"), shared_path(spark, "arrived")
        (events.withColumn("_batch", F.floor((F.col(arrival) - lo) / step).cast("int"))
         .repartitionByRange("_batch", arrival).write.partitionBy("_batch").parquet(self.staged))
        self.schema = events.schema

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.source)

    def run(self, start) -> None:
        """Deliver one batch, run the queries that ``start`` gives until
        they have read it, and so on."""
        for k in range(self.batches):
            folder = f"{self.staged}/_batch={k}"
            if not path_exists(self.spark, folder):         # no event arrived in this range
                continue
            move_path(self.spark, folder, f"{self.source}/{k:05d}")
            for q in start():
                q.awaitTermination()
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))

    def clear(self) -> None:
        delete_path(self.spark, self.staged)
        delete_path(self.spark, self.source)


def arriving(spark: SparkSession, sf_dir: str, prime: int, spread: int, batches: int) -> ArrivalBatches:
    """The driver's events with arrival = event_id + (event_id * prime) % spread."""
    raw = spark.read.parquet(table_path(sf_dir, "events"))
    arrival = F.col("event_id") + F.pmod(F.col("event_id") * F.lit(prime), F.lit(spread))
    return ArrivalBatches(spark, raw.withColumn("arrival", arrival), "arrival", batches)


def job_replay(spark: SparkSession, sf_dir: str, size, slide, lateness, batches: int, prime: int, spread: int,
               out_of_orderness="35 seconds") -> dict[str, DataFrame]:
    """The whole job over the driver's events in order of arrival: the
    outbox, the metrics table, the quarantine, and the files of the sink."""
    source = arriving(spark, sf_dir, prime, spread, batches)
    base = shared_path(spark, "job")
    table = MetricsTable(spark, f"{base}/table", id_scope="date")
    events = lambda: bind_events(source.stream(), "user_id", keep=("event_id", "arrival"))
    source.run(lambda: start_job(
        events, table, f"{base}/late", f"{base}/ckpt", size, slide, out_of_orderness, lateness,
        targets={"files": to_files(f"{base}/sink")}, state_partitions=default_state_partitions(spark)))
    source.clear()
    return {"outbox": Outbox(spark, f"{base}/ckpt/results-state/outbox", {}).read(), "table": table.scan(),
            "quarantine": read_quarantine(spark, f"{base}/late"),
            "sink": decode_results(spark.read.text(f"{base}/sink").select("value"))}


def refire_replay(spark: SparkSession, sf_dir: str, size, slide, lateness, batches: int, prime: int = 7919,
                  spread: int = 50) -> DataFrame:
    """O-30: the last revision of every window that fired, how many there
    were, and how many of them the sink and the table hold."""
    out = job_replay(spark, sf_dir, size, slide, lateness, batches, prime, spread)
    last = F.max(F.struct("event_count", "window_start", "window_end", "percentile_95", "id")).alias("last")
    windows = out["outbox"].groupBy("device_id", "win_start", "win_end").agg(
        last, F.count(F.lit(1)).alias("revisions"))
    served = out["outbox"].select("id", "device_id", "win_start", "win_end") \
        .join(out["table"].select(F.col("event_id").alias("id"), F.lit(1).alias("t")), "id", "left") \
        .join(out["sink"].select("id", F.lit(1).alias("s")), "id", "left") \
        .groupBy("device_id", "win_start", "win_end").agg(F.count("t").alias("in_table"), F.count("s").alias("in_sink"))
    return windows.join(served, ["device_id", "win_start", "win_end"]).select(
        "device_id", "win_start", "win_end", "last.event_count", "last.window_start", "last.window_end",
        "last.percentile_95", "revisions", "in_table", "in_sink")


def quarantine_replay(spark: SparkSession, sf_dir: str, chunks: int = 8, prime: int = 7919,
                      spread: int = 50) -> DataFrame:
    """O-31 stream over the driver's events in arrival order, ``chunks``
    micro-batches: the quarantined rows."""
    source = arriving(spark, sf_dir, prime, spread, chunks)
    base = shared_path(spark, "quarantine")
    source.run(lambda: [start_quarantine_stream(
        bind_events(source.stream(), "user_id", keep=("event_id", "arrival")), f"{base}/late", f"{base}/state",
        f"{base}/ckpt", state_partitions=default_state_partitions(spark))])
    source.clear()
    return read_quarantine(spark, f"{base}/late")


def writer_replay(spark: SparkSession, records: DataFrame, files: int, validate: str = "none",
                  runs: int = 2) -> tuple[MetricsTable, DataFrame]:
    """O-03: result records (column value) through the writer stream, in two
    micro-batches, ``runs`` times over; the table and the rejects. Records are
    packed files of the tasks they come from; where these are fewer than
    ``files``, the records are few, and are dealt to as many."""
    base = shared_path(spark, "writer")
    packed = lambda df, to: df.write.option("compression", "gzip").text(to)
    packed(records, f"{base}/records")
    if files_in(spark, f"{base}/records") < files:
        move_path(spark, f"{base}/records", f"{base}/staged")
        packed(spark.read.text(f"{base}/staged").repartition(files), f"{base}/records")
        delete_path(spark, f"{base}/staged")
    files = max(files, files_in(spark, f"{base}/records"))
    drop_dead_shuffles(spark)
    table = MetricsTable(spark, f"{base}/table")
    for k in range(runs):
        q = start_writer_stream(read_result_stream(spark, "text", f"{base}/records", max_files_per_trigger=-(-files // 2)),
                                table, f"{base}/ckpt-{k}", validate, f"{base}/rejects-{k}", available_now=True)
        _until_done(q)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return table, spark.read.parquet(f"{base}/rejects-{runs - 1}")
