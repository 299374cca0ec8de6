"""High-usage flag and usage bands (O-33, O-34)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The documented alert threshold and the two band sets
# (generator bands and test-data bands), as cut points in percent.
HIGH_USAGE_THRESHOLD = 80.0
GENERATOR_BANDS = [0.0, 40.0, 80.0, 100.0]
TEST_BANDS = [5.0, 30.0, 70.0, 95.0, 100.0]


def flag_high_usage(df: DataFrame, threshold: float = HIGH_USAGE_THRESHOLD,
                    col: str = "percentile_95") -> DataFrame:
    """O-33: ``high_usage`` = value >= threshold."""
    return df.withColumn("high_usage", F.col(col) >= F.lit(float(threshold)))


def band_label(col, cuts: Sequence[float]):
    """Half-open bands [c_i, c_{i+1}); the last band is closed at its top.
    Values outside read 'below' / 'above'."""
    v = F.col(col) if isinstance(col, str) else col
    expr = F.when(v < F.lit(cuts[0]), F.lit("below"))
    for lo, hi in zip(cuts[:-2], cuts[1:-1]):
        expr = expr.when(v < F.lit(hi), F.lit(f"{lo:g}-{hi:g}"))
    expr = expr.when(v <= F.lit(cuts[-1]), F.lit(f"{cuts[-2]:g}-{cuts[-1]:g}"))
    return expr.otherwise(F.lit("above"))


def usage_bands(df: DataFrame, cuts: Sequence[float] = GENERATOR_BANDS,
                col: str = "cpu_usage") -> DataFrame:
    """O-34: band, rows, min and max per band (one aggregate, map-side
    combined)."""
    return (df.filter(F.col(col).isNotNull() & ~F.isnan(col))
            .groupBy(band_label(col, cuts).alias("band"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("min_value"),
                 F.max(col).alias("max_value")))
