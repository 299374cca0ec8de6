"""Structured Streaming form of the pipeline (O-01..O-03, O-27, O-28, O-32).

Events (Kafka JSON, JSON files, or a Parquet folder) -> event time +
watermark -> sliding windows -> p95 -> result sink or the metrics table.

State is a *histogram*: the stateful operator is ``count / min / max``
grouped by (device, pane, value), see ``refire``; ``foreachBatch`` keeps what
changed and runs the batch rank selection of ``operators.quantile`` over the
windows that fire with that batch. No window's values are ever held as one
list, and a hot device's state is spread over partitions by value.

O-28 (source idleness): one source has one global watermark (the max event
time seen minus the delay), so an idle partition never holds it back; for
several sources ``union_sources`` keeps a silent one from holding the others.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import split_storable, to_metric_rows
from ..schema import EVENT_SCHEMA
from ..sources.codec import decode_events, encode_results
from ..sources.events import bind_events
from ..session import start_with_partitions
from ..sources.store import CODEC, MetricsTable

# The reference job's settings (code, not README).
WATERMARK_DELAY = "35 seconds"
WINDOW_SIZE = "30 seconds"
WINDOW_SLIDE = "5 seconds"
EVENTS_TOPIC = "events"
RESULTS_TOPIC = "processed-events"


def kafka_source_options(bootstrap: str, topic: str = EVENTS_TOPIC,
                         max_offsets: int | None = None,
                         fail_on_data_loss: bool = True) -> dict[str, str]:
    """O-01 / O-03 options: value-only records, start at the earliest
    offset; ``max_offsets`` bounds a micro-batch (the writer's 500). A query
    fails on expired offsets unless ``fail_on_data_loss`` is False."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": "earliest", "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    return opts


def kafka_sink_options(bootstrap: str, topic: str = RESULTS_TOPIC) -> dict[str, str]:
    """O-02 options: JSON value, no key (at-least-once; replays are absorbed
    by the idempotent table append)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def read_event_stream(spark: SparkSession, fmt: str = "json", path: str | None = None,
                      options: dict | None = None, max_files_per_trigger: int | None = None,
                      malformed: bool = False) -> DataFrame:
    """O-01 + O-05 + O-08: a stream of (device_id, timestamp, cpu_usage, ts).

    fmt "kafka": JSON values from a topic (needs the Kafka connector on
    the classpath); "json" or "text": JSON-lines files in ``path`` with the
    wire names. Malformed records are not events; ``malformed=True`` gives
    those instead (column ``record``), for a query that keeps them.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "kafka":
        raw = reader.format("kafka").options(**(options or {})).load()
        dec = decode_events(raw.select(F.col("value").cast("string").alias("value")))
    elif fmt in ("json", "text"):
        dec = decode_events(reader.text(path))
    else:
        raise ValueError(f"unknown stream format {fmt!r}")
    if malformed:
        return dec.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("record"))
    good = dec.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    return good.withColumn("ts", F.timestamp_millis("timestamp"))


def read_table_stream(spark: SparkSession, path: str, schema, device: str = "user_id",
                      max_files_per_trigger: int | None = None, glob: str | None = None
                      ) -> DataFrame:
    """A folder of ``events``-shaped Parquet files as a file stream, bound to
    the event schema; ``glob`` picks files by name."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return bind_events(reader.parquet(path), device)


def start_metrics_stream(events: DataFrame, table: MetricsTable, checkpoint: str,
                         size=WINDOW_SIZE, slide=WINDOW_SLIDE,
                         watermark: str = WATERMARK_DELAY, available_now: bool = True,
                         processing_time: str | None = None, validate: str = "none",
                         reject_table: MetricsTable | None = None,
                         state_partitions: int | None = None, live_clock: bool = False,
                         state_path: str | None = None):
    """O-32: windows -> results -> idempotent append, one transaction per
    micro-batch. Each window is written once, when the watermark passes its
    end: the windows of ``Revisions`` without lateness, so the state holds a
    row for every value of a pane, not of every window over it. Rows later
    than that are for a quarantine stream started with
    ``lateness=0``, so that every row is in one of the two. Windows that
    fire again for late rows are ``start_revisions_stream``'s (with a
    quarantine of the default lateness). A replayed batch (after a failure, before the checkpoint
    commit) appends nothing new, as the ids are deterministic.

    ``validate`` "none" follows the reference's bulk path; "strict" applies
    O-10 and sends rejected rows to ``reject_table``. ``state_partitions``
    fixes the number of state partitions at the query's first start
    (default: the session's shuffle partitions). ``live_clock`` stamps
    ``last_updated`` with the wall clock at emission. ``state_path`` as in
    ``start_results_stream``.
    """
    from ..operators.clean import split_valid
    from .refire import Revisions, pane_updates

    spark = events.sparkSession
    state = (state_path or checkpoint.rstrip("/") + "-state").rstrip("/")
    revisions = Revisions(spark, f"{state}/windows", size, slide, watermark, 0)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        prev, now = revisions.record(batch, batch_id)
        if now is None:
            return
        now_ms = int(time.time() * 1000) if live_clock else None
        rows = to_metric_rows(revisions.of_batch(batch_id, prev, now, now_ms)).persist()
        try:
            if validate == "strict":
                good, rejected = split_valid(rows)
                if reject_table is not None:
                    write_rejects(rejected, reject_table.path, batch_id)
                table.append(good)
            else:
                table.append(rows)
        finally:
            rows.unpersist()

    w = (pane_updates(events, size, slide, watermark, 0)
         .writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return start_with_partitions(w, spark, state_partitions)


def write_rejects(rejected: DataFrame, path: str, batch_id: int) -> None:
    """Rejected rows with their reason; a replayed batch replaces its own."""
    (rejected.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
     .partitionBy("batch_id").parquet(path))


def _as_columns(rows: DataFrame, column: str) -> tuple[DataFrame, list[str]]:
    """``rows`` with a struct column as columns that sort as it does. Cached
    columns pack what repeats from row to row (the file of a record), the
    bytes of a struct they keep as they are."""
    kind = rows.schema[column].dataType
    if not isinstance(kind, T.StructType):
        return rows, [column]
    parts = {f"_{column}": F.col(column).isNotNull()} | {
        f"_{column}_{f.name}": F.col(column)[f.name] for f in kind.fields}
    return rows.withColumns(parts).drop(column), list(parts)


def union_sources(sources: list[DataFrame], delay: str) -> DataFrame:
    """O-28: several event streams as one, with a watermark of ``delay`` that
    follows the source that is furthest ahead, so that one that is silent
    holds back nothing. (Spark's own default is the slowest source; the
    session's policy is set for queries started from now on.)"""
    spark = sources[0].sparkSession
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    out = None
    for source in sources:
        marked = source.withWatermark("ts", delay)
        out = marked if out is None else out.unionByName(marked)
    return out


def start_results_stream(events: DataFrame, targets: dict, checkpoint: str,
                         size=WINDOW_SIZE, slide=WINDOW_SLIDE,
                         out_of_orderness: str = WATERMARK_DELAY,
                         lateness: str = WATERMARK_DELAY, available_now: bool = True,
                         processing_time: str | None = None,
                         state_partitions: int | None = None, live_clock: bool = False,
                         state_path: str | None = None):
    """O-30 + O-02 + O-32, the whole job: every revision of the re-firing
    windows goes once to each of ``targets`` (name -> ``outbox.Target``: the
    metrics table, a topic, files), under its own id. A window fires when the
    watermark passes its end and again for each batch with late rows, until it
    closes for good; what is later still belongs to a quarantine stream of the
    same bounds. The stream's panes and outbox lie in ``state_path`` (default:
    beside the checkpoint). ``live_clock`` stamps ``last_updated`` with the
    wall clock at emission."""
    from .outbox import Outbox
    from .refire import Revisions, pane_updates, revisions_writer

    spark = events.sparkSession
    state = (state_path or checkpoint.rstrip("/") + "-state").rstrip("/")
    revisions = Revisions(spark, f"{state}/windows", size, slide, out_of_orderness, lateness)
    write = revisions_writer(revisions, Outbox(spark, f"{state}/outbox", targets), live_clock)
    w = (pane_updates(events, size, slide, out_of_orderness, lateness)
         .writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return start_with_partitions(w, spark, state_partitions)


def start_revisions_stream(events: DataFrame, table: MetricsTable, checkpoint: str, **options):
    """``start_results_stream`` into the metrics table alone."""
    from .outbox import to_table

    return start_results_stream(events, {"table": to_table(table)}, checkpoint, **options)


def start_kafka_results_stream(events: DataFrame, bootstrap: str, checkpoint: str,
                               topic: str = RESULTS_TOPIC, **options):
    """O-02: every revision as a JSON value to the results topic."""
    from .outbox import to_kafka

    return start_results_stream(events, {"topic": to_kafka(kafka_sink_options(bootstrap, topic))}, checkpoint,
                                **options)


def start_job(events, table: MetricsTable, quarantine_path: str, checkpoint: str, size=WINDOW_SIZE,
              slide=WINDOW_SLIDE, out_of_orderness: str = WATERMARK_DELAY, lateness: str = WATERMARK_DELAY,
              targets: dict | None = None, available_now: bool = True, state_partitions: int | None = None,
              live_clock: bool = False):
    """Results and quarantine with one set of bounds: every row with a device
    is in the windows or in the quarantine. ``events``: a function giving the
    stream (each query reads the source on its own). Returns both queries."""
    from .late import start_quarantine_stream
    from .outbox import to_table

    bounds = {"size": size, "slide": slide, "out_of_orderness": out_of_orderness, "lateness": lateness,
              "available_now": available_now, "state_partitions": state_partitions}
    base = checkpoint.rstrip("/")
    results = start_results_stream(events(), {"table": to_table(table), **(targets or {})}, f"{base}/results",
                                   live_clock=live_clock, state_path=f"{base}/results-state", **bounds)
    late = start_quarantine_stream(events(), quarantine_path, f"{base}/late-state", f"{base}/late", **bounds)
    return results, late


__all__ = ["EVENT_SCHEMA", "kafka_source_options", "kafka_sink_options", "read_event_stream",
           "read_table_stream", "start_metrics_stream", "start_results_stream", "start_revisions_stream",
           "start_kafka_results_stream", "start_job", "union_sources"]


def read_result_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                       options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """O-03: the result records the writer consumes (JSON values from the
    results topic, or JSON-lines files). ``arrival`` tells which of two
    records came first, ``record`` holds the text of one that cannot be
    decoded."""
    from ..sources.codec import decode_results

    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**(options or {})).load()
        raw = raw.select(F.col("value").cast("string").alias("value"),
                         F.struct("timestamp", "partition", "offset").alias("arrival"))
    elif fmt == "text":
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        raw = reader.text(path).select("value", F.struct("_metadata.file_modification_time",
                                                         "_metadata.file_path").alias("arrival"))
    else:
        raise ValueError(f"unknown stream format {fmt!r}")
    return decode_results(raw, keep=("arrival",), record=True)


def start_writer_stream(results: DataFrame, table: MetricsTable, checkpoint: str,
                        validate: str = "none", reject_path: str | None = None,
                        available_now: bool = False, processing_time: str | None = None):
    """O-03 + O-09 + O-10 + O-21 + O-32: result records -> metrics rows ->
    idempotent append, one transaction per micro-batch; the source offsets are
    committed only after the append.

    A record that cannot be decoded, or that the table would refuse (no id, no
    device, too long), goes to ``reject_path`` (default: beside the table) with
    its reason and text, by batch id, and the rest of its batch is stored;
    "strict" sends what fails validation there too. Of records that share an
    id the first to arrive is stored."""
    reject_path = reject_path or table.path + "-rejects"
    extra = [c for c in ("arrival", "record") if c in results.columns]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows, order = to_metric_rows(batch, keep=extra), []
        if "arrival" in extra:
            rows, order = _as_columns(rows, "arrival")
        rows = rows.persist()
        try:
            good, rejected = split_storable(rows, validate)
            write_rejects(rejected.drop(*order), reject_path, batch_id)
            table.append(good, order_cols=(*order, "last_updated"), cached=True)
        finally:
            rows.unpersist()

    w = results.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
