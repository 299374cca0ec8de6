"""JSON wire formats (O-05, O-06).

Decoding is PERMISSIVE: a malformed record keeps its text in ``_corrupt``
and goes to quarantine instead of failing the job; a missing number reads
as 0 / 0.0 as it would in the reference's primitive fields; unknown fields
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EVENT_JSON_SCHEMA

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def decode_events(df: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """value (JSON text) -> *keep, device_id, timestamp, cpu_usage, _corrupt."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value_col).cast("string"), _with_corrupt(EVENT_JSON_SCHEMA), opts)
    p = df.select(*keep, parsed.alias("_e"))
    bad = F.col(f"_e.{CORRUPT}").isNotNull() | F.col("_e").isNull()
    return p.select(
        *keep,
        F.when(bad, F.lit(None)).otherwise(F.col("_e.deviceId")).alias("device_id"),
        F.coalesce(F.col("_e.timestamp"), F.lit(0)).cast("long").alias("timestamp"),
        F.coalesce(F.col("_e.cpuUsage"), F.lit(0.0)).cast("double").alias("cpu_usage"),
        F.when(bad, F.coalesce(F.col(f"_e.{CORRUPT}"), F.col("_e").cast("string")))
         .alias(CORRUPT))


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, quarantined raw records)."""
    good = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"))
    return good, bad


def encode_events(df: DataFrame) -> DataFrame:
    """device_id, timestamp, cpu_usage -> value (JSON text, wire names);
    null fields are left out."""
    return df.select(F.to_json(F.struct(F.col("device_id").alias("deviceId"),
                                        F.col("timestamp").alias("timestamp"),
                                        F.col("cpu_usage").alias("cpuUsage"))).alias("value"))


def encode_results(df: DataFrame, keep=()) -> DataFrame:
    """O-06: result rows -> value with the six wire properties."""
    return df.select(*keep, F.to_json(F.struct(
        F.col("id").alias("id"), F.col("device_id").alias("deviceId"),
        F.col("window_start").alias("windowStart"), F.col("window_end").alias("windowEnd"),
        F.col("percentile_95").alias("percentile95"),
        F.col("last_updated").alias("lastUpdated"))).alias("value"))


def decode_results(df: DataFrame, value_col: str = "value", keep=(), record: bool = False) -> DataFrame:
    """O-03: result JSON -> result rows (for the writer's stream). Missing
    numbers read 0, as the consumer's primitive fields do; a record that is
    not JSON at all reads null throughout (rejected as a null metric).
    ``record`` adds the text of every record that could not be decoded (null
    for the others), so that it can be kept apart with its content."""
    from ..schema import RESULT_JSON_SCHEMA

    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col(value_col).cast("string")
    r = df.select(*keep, text.alias("_v"), F.from_json(text, _with_corrupt(RESULT_JSON_SCHEMA), opts).alias("_r"))
    empty = F.col("_r.id").isNull() & F.col("_r.deviceId").isNull()
    for c in ("windowStart", "windowEnd", "percentile95", "lastUpdated"):
        empty = empty & F.col(f"_r.{c}").isNull()
    number = lambda c, zero: F.when(~empty, F.coalesce(F.col(f"_r.{c}"), F.lit(zero)))
    broken = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    extra = [F.when(broken, F.coalesce("_v", F.lit(""))).alias("record")] if record else []
    return r.select(F.col("_r.id").alias("id"), F.col("_r.deviceId").alias("device_id"),
                    number("windowStart", 0).cast("long").alias("window_start"),
                    number("windowEnd", 0).cast("long").alias("window_end"),
                    number("percentile95", 0.0).alias("percentile_95"),
                    number("lastUpdated", 0).cast("long").alias("last_updated"), *keep, *extra)
