"""Late-event side output in batch form (O-27, O-31).

An event is dropped from every window, and goes to the side output, when
its *last* window has closed for good before it arrives:

    floor(t / slide) * slide + size + out_of_orderness + lateness
        <= max event time of the events that arrived before it

(defaults 5 s, 30 s, 35 s, 35 s). Arrival order is a column (a Kafka
offset, an ingest sequence); ties are broken by a second column.

The running maximum over arrival order is computed in levels so that no
step sees the whole table in one task: rows are cut into chunks of
consecutive arrival numbers; a per-chunk max is a plain aggregate; a prefix
max over the chunk table (itself split into groups of chunks) gives the max
of all earlier chunks; the running max inside a chunk is a window
partitioned by chunk. A chunk that many rows share (few arrival numbers, many
rows each) is cut further, by arrival number and by stretches of the tie
column, and the same three steps run on those units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .clean import valid_events
from .windows import parse_duration_ms

# The reference job's window and watermark settings.
DEFAULT_SIZE_MS = 30_000
DEFAULT_SLIDE_MS = 5_000
OUT_OF_ORDERNESS_MS = 35_000
ALLOWED_LATENESS_MS = 35_000

# Arrival numbers per chunk, and rows that a unit of the running maximum may hold.
CHUNK = 1 << 16


def close_time(t, size_ms: int, slide_ms: int, ooo_ms: int, late_ms: int):
    """Event time after which the last window of an event at ``t`` takes no
    more rows."""
    return t - F.pmod(t, F.lit(slide_ms)) + F.lit(size_ms + ooo_ms + late_ms)


def _exclusive_prefix_max(table: DataFrame, order: str, value: str, out: str,
                          fan: int) -> DataFrame:
    """Max of ``value`` over rows with a smaller ``order`` (dense integer
    ids), in two levels: within groups of ``fan`` consecutive ids, and over
    the group maxima. The only window without a partition key runs on
    len(table) / fan rows."""
    t = table.withColumn("_grp", F.floor(F.col(order) / F.lit(fan)).cast("long"))
    groups = t.groupBy("_grp").agg(F.max(value).alias("_gmax"))
    groups = groups.withColumn("_before_grp", F.max("_gmax").over(
        Window.orderBy("_grp").rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy("_grp").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_before_in_grp", F.max(value).over(inside))
    t = t.join(groups.select("_grp", "_before_grp"), on="_grp", how="left")
    return t.withColumn(out, F.greatest("_before_grp", "_before_in_grp")).drop(
        "_grp", "_before_grp", "_before_in_grp")


def max_seen_before(df: DataFrame, time: str, arrival: str, tie: str,
                    chunk: int = CHUNK) -> DataFrame:
    """Add ``max_before``: max of ``time`` over rows strictly earlier in
    (arrival, tie) order (null for the first row; rows equal in both are
    taken by time).

    The largest units: the rows of one *unit*, the units of one chunk, the
    chunks of one group of ``chunk`` chunks, the groups. A chunk of arrival
    numbers with at most twice ``chunk`` rows is a unit. In a fuller one every
    arrival number is a unit of its own, and one with more than ``chunk`` rows
    is cut into as many stretches of equal width of a numeric ``tie`` as it
    has times ``chunk`` rows. Where no chunk is that full the tables of units
    are empty, and adaptive execution drops their joins."""
    c = df.withColumn("_chunk", F.floor(F.col(arrival) / F.lit(chunk)).cast("long"))
    per_chunk = c.groupBy("_chunk").agg(F.max(time).alias("_cmax"), F.count(F.lit(1)).alias("_rows"))
    prefix = _exclusive_prefix_max(per_chunk, "_chunk", "_cmax", "_before_chunk", chunk)
    c = c.join(prefix.select("_chunk", "_before_chunk", (F.col("_rows") > F.lit(2 * chunk)).alias("_full")),
               on="_chunk", how="left")
    # What each arrival number of a full chunk holds, and its stretches.
    c = c.withColumn("_own", F.when(F.col("_full"), F.col(arrival)))
    numeric = isinstance(df.schema[tie].dataType, NumericType)
    at = F.col(tie).cast("double") if numeric else F.lit(0.0)
    per_arrival = (c.filter("_full").groupBy("_own").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk)).alias("_cuts"), F.min(at).alias("_lo"), F.max(at).alias("_hi"))
        .filter("_cuts > 1 and _hi > _lo"))
    part = F.floor((at - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("_cuts")).cast("long")
    c = c.join(per_arrival, on="_own", how="left").withColumn("_part", F.coalesce(part, F.lit(0).cast("long")))
    # What came before a unit within its chunk.
    units = c.filter("_full").groupBy("_chunk", "_own", "_part").agg(F.max(time).alias("_umax"))
    earlier = Window.partitionBy("_chunk").orderBy("_own", "_part").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("_before_unit", F.max("_umax").over(earlier)).select("_own", "_part", "_before_unit")
    c = c.join(units, on=["_own", "_part"], how="left")
    inner = Window.partitionBy("_chunk", "_own", "_part").orderBy(arrival, tie, time).rowsBetween(
        Window.unboundedPreceding, -1)
    c = c.withColumn("_before_in", F.max(time).over(inner))
    return (c.withColumn("max_before", F.greatest("_before_chunk", "_before_unit", "_before_in"))
            .select(*df.columns, "max_before"))


def late_events(df: DataFrame, arrival: str, tie: str, time: str = "timestamp",
                size=DEFAULT_SIZE_MS, slide=DEFAULT_SLIDE_MS,
                out_of_orderness=OUT_OF_ORDERNESS_MS, lateness=ALLOWED_LATENESS_MS,
                chunk: int = CHUNK) -> DataFrame:
    """Rows that go to the side output, with ``max_before`` and the
    reference's message ``Late event: <device> at <time>``."""
    size_ms, slide_ms = parse_duration_ms(size), parse_duration_ms(slide)
    ooo_ms, late_ms = parse_duration_ms(out_of_orderness), parse_duration_ms(lateness)
    m = max_seen_before(valid_events(df) if "device_id" in df.columns else df, time, arrival, tie, chunk)
    late = m.filter(close_time(F.col(time), size_ms, slide_ms, ooo_ms, late_ms)
                    <= F.col("max_before"))
    return late.withColumn("message", F.concat(F.lit("Late event: "), F.col("device_id"),
                                               F.lit(" at "), F.col(time).cast("string")))


def on_time_events(df: DataFrame, arrival: str, tie: str, time: str = "timestamp",
                   **kw) -> DataFrame:
    """The complement of ``late_events`` (what the windows still take)."""
    late = late_events(df, arrival, tie, time, **kw).select(arrival, tie)
    return df.join(late, on=[arrival, tie], how="left_anti")
