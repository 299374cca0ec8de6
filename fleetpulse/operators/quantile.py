"""Exact order statistics per group without holding a group in one task.

The percentile of a group needs the values at two ranks. Collecting a
group's values into one array (or one window partition) does not survive a
hot key: one device, or one event type, may hold a third of all rows. The
bucket plan here works on a *value histogram* and holds no list at all:

1. Histogram: (keys, v) -> count, a plain aggregate with map-side partial
   combining. Repeated values collapse before the shuffle, and that shuffle
   is hashed on the value too, so a hot group is spread over all tasks.
2. Each distinct value gets a coarse bucket ``b``, a monotone function of
   the value (sign and 1/64 of a binary order of magnitude: at most ~2^18
   buckets per group). The histogram is partitioned by (keys, b) once.
3. Bucket counts (no shuffle) -> a running sum over the buckets of a group
   (a window over at most ~2^18 small rows) gives the count below each
   bucket and the group size; the buckets holding the wanted ranks (at most
   two per group) are joined back to the histogram rows on the same
   partitioning, and a window sorted by value inside just those buckets
   (spillable, like any sort) gives exact ranks.

4. Where a group may hold a large part of all rows (``sliced``), a bucket is
   cut into ``SLICES`` slices in the same manner and the histogram is dealt by
   slice: what one task holds and sorts is a slice, 1/4096 of a bucket.

Exactness: buckets are contiguous value ranges because ``b`` is monotone
(log2 is semi-monotone; scaling by a positive constant and floor keep it).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.percentile import (P95, legacy_combine, legacy_ranks, max_rule_limit,
                                   percentile_of_weighted)

# Coarse-bucket resolution (buckets per binary order of
# magnitude), the clamp that keeps infinities in their own end buckets, and
# the shift that keeps positive buckets above zero.
BUCKETS_PER_OCTAVE = 64
LOG2_CLAMP = 1100.0
BUCKET_SHIFT = 80000

BUCKET = "_b"

# Slices of a coarse bucket, for groups that may hold a large part of all rows.
SLICES = 4096
SLICE = "_s"


def usable(v: Column) -> Column:
    """Values that take part in a percentile (null and NaN are dropped)."""
    return v.isNotNull() & ~F.isnan(v)


def coarse_bucket(v: Column) -> Column:
    """Monotone non-decreasing long bucket of a double; null for NaN/null."""
    mag = F.floor(F.least(F.greatest(F.log2(F.abs(v)), F.lit(-LOG2_CLAMP)),
                          F.lit(LOG2_CLAMP)) * F.lit(float(BUCKETS_PER_OCTAVE)))
    pos = mag.cast("long") + F.lit(BUCKET_SHIFT)
    return (F.when(~usable(v), F.lit(None))
            .when(v > 0, pos).when(v < 0, -pos).otherwise(F.lit(0))).cast("long")


def slice_of_bucket(v: Column) -> Column:
    """Slice of a value within its coarse bucket, monotone like the bucket
    (the same logarithm, scaled, less its floor)."""
    x = F.least(F.greatest(F.log2(F.abs(v)), F.lit(-LOG2_CLAMP)), F.lit(LOG2_CLAMP)) * F.lit(float(BUCKETS_PER_OCTAVE))
    at = F.floor((x - F.floor(x)) * F.lit(float(SLICES)))
    return F.when(v > 0, at).when(v < 0, -at).otherwise(F.lit(0)).cast("long")


def bucketed_histogram(hist: DataFrame, keys: Sequence[str], value: str,
                       count_col: str = "c", sliced: bool = False) -> DataFrame:
    """(keys, value, count) rows -> one row per distinct usable value:
    (keys, bucket, value, c), hash-partitioned by (keys, bucket).
    ``sliced`` adds each value's slice of its bucket and partitions by that
    too, for groups that may hold a large part of all rows: ``select_ranks``
    then looks into the wanted buckets slice by slice.

    Rows may repeat a value (they are summed). Both branches of the
    selection read this one exchange: the bucket counts need no further
    shuffle, and the wanted buckets are joined back without moving it."""
    v = F.col(value)
    # The explicit not-null filter equals what the join below would infer
    # for one branch only; stated here, both branches stay identical and
    # Spark reuses the exchange.
    hist = hist.filter(usable(v)).withColumn(BUCKET, coarse_bucket(v)).filter(F.col(BUCKET).isNotNull())
    parts = [*keys, BUCKET]
    if sliced:
        hist, parts = hist.withColumn(SLICE, slice_of_bucket(v)), [*parts, SLICE]
    return hist.repartition(*parts).groupBy(*parts, value).agg(F.sum(count_col).alias("c"))


def _wanted(counts: DataFrame, keys: Sequence[str], part: str, below: Column, ranks: Sequence[str]) -> DataFrame:
    """Of counts (keys, part, _bc, ...) in order of ``part`` the parts that
    hold a wanted rank, with ``_prev``, the rows below each (``below`` rows lie
    below all parts of a group)."""
    running = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_cum", below + F.sum("_bc").over(running)) \
        .withColumn("_prev", F.col("_cum") - F.col("_bc"))
    hit_any = F.lit(False)
    for r in ranks:
        hit_any = hit_any | ((F.col("_prev") < F.col(r)) & (F.col(r) <= F.col("_cum")))
    return counts.filter(hit_any).drop("_cum", "_bc")


def _picked(cand: DataFrame, keys: Sequence[str], parts: Sequence[str], value: str,
            ranks: dict[str, str]) -> DataFrame:
    """The values at the wanted ranks among the rows of the wanted parts, each
    sorted by value (with spilling)."""
    within = Window.partitionBy(*keys, *parts).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cand = cand.withColumn("_vcum", F.col("_prev") + F.sum("c").over(within))
    picks = []
    for name, rank in ranks.items():
        r = F.col(rank)
        hit = ((F.col("_vcum") - F.col("c")) < r) & (r <= F.col("_vcum"))
        picks.append(F.max(F.when(hit, F.col(value))).alias(name))
    return cand.groupBy(*keys).agg(F.max("n").alias("n"), *picks)


def select_ranks(bh: DataFrame, keys: Sequence[str], value: str,
                 rank_fns: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Values at given 1-based ranks per group of a ``bucketed_histogram``.

    ``rank_fns``: output name -> function of n (the group's usable count)
    -> rank. Returns keys, n and one column per rank (groups without a
    usable value do not appear).
    """
    keys = list(keys)
    ranks = {name: f"_r{name}" for name in rank_fns}
    # Bucket counts only: at most ~2^18 small rows per group.
    counts = bh.groupBy(*keys, BUCKET).agg(F.sum("c").alias("_bc")) \
        .withColumn("n", F.sum("_bc").over(Window.partitionBy(*keys)))
    for name, fn in rank_fns.items():
        counts = counts.withColumn(ranks[name], fn(F.col("n")))
    targets = _wanted(counts, keys, BUCKET, F.lit(0), list(ranks.values()))
    # Only the rows of the (at most two) wanted buckets per group go on; the
    # histogram side is not moved.
    if SLICE not in bh.columns:
        return _picked(bh.join(targets, on=keys + [BUCKET]), keys, [BUCKET], value, ranks)
    cand = bh.join(targets.withColumnRenamed("_prev", "_low"), on=keys + [BUCKET])
    slices = cand.groupBy(*keys, BUCKET, SLICE).agg(
        F.sum("c").alias("_bc"), *[F.first(x).alias(x) for x in ("_low", "n", *ranks.values())])
    inner = _wanted(slices, [*keys, BUCKET], SLICE, F.col("_low"), list(ranks.values()))
    return _picked(bh.join(inner, on=[*keys, BUCKET, SLICE]), keys, [BUCKET, SLICE], value, ranks)


def percentile_by_buckets(bh: DataFrame, keys: Sequence[str], value: str, p: float = P95,
                          out: str = "percentile_95") -> DataFrame:
    """keys, n, <out>: legacy percentile per group of a bucketed histogram."""
    sel = select_ranks(bh, keys, value, {
        "_x_lo": lambda n: legacy_ranks(n, p)[1],
        "_x_hi": lambda n: legacy_ranks(n, p)[2],
    })
    return sel.select(*keys, "n", legacy_combine(F.col("_x_lo"), F.col("_x_hi"), F.col("n"), p)
                      .alias(out))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str,
                     p: float = P95, out: str = "percentile_95") -> DataFrame:
    """Grouped exact legacy percentile of ``value``: keys, n, <out>.

    NaN and null values are dropped; a group without any usable value does
    not appear (callers apply their own empty/NaN rules). Repeated values
    are counted map-side before the first shuffle. Groups may be as large as
    the table: buckets are cut into slices, so no task holds a bucket.
    """
    keys = list(keys)
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    return percentile_by_buckets(bucketed_histogram(hist, keys, value, "c", sliced=True), keys, value, p, out)


def histogram_windows(hist: DataFrame, keys: Sequence[str], value: str = "cpu_usage",
                      count_col: str = "c", first: str = "mn", last: str = "mx",
                      p: float = P95, method: str = "auto",
                      out: str = "percentile_95", touched: str | None = None) -> DataFrame:
    """Per group of a histogram with time bounds (keys, value, c, mn, mx):
    event_count, window_start, window_end, n (usable) and the percentile
    (NaN when no usable value).

    "list": one aggregate holding each group's sorted (value, count) list;
    "buckets": the two-level selection; "max": the largest usable value,
    valid only for groups small enough that the rule returns the maximum;
    "auto": each group by its own size, its maximum up to what the rule
    allows and the two-level selection beyond, in one plan. With "max",
    ``touched`` names a boolean column: whether a row of the group has it.
    """
    keys = list(keys)
    v = F.col(value)
    ok = usable(v)
    if method == "auto":
        every = histogram_windows(hist, keys, value, count_col, first, last, p, "max", out)
        large = every.filter(F.col("n") > F.lit(max_rule_limit(p))).select(*keys)
        pct = percentile_by_buckets(
            bucketed_histogram(hist.join(large, on=keys, how="left_semi"), keys, value, count_col),
            keys, value, p, "_p").select(*keys, "_p")
        return (every.join(pct, on=keys, how="left").withColumn(out, F.coalesce("_p", out))
                .select(*every.columns))
    if method == "max":
        g = hist.groupBy(*keys).agg(
            F.sum(count_col).alias("event_count"), F.min(first).alias("window_start"),
            F.max(last).alias("window_end"),
            F.sum(F.when(ok, F.col(count_col)).otherwise(F.lit(0))).alias("n"),
            F.max(F.when(ok, v)).alias("_top"), *([F.max(touched).alias(touched)] if touched else []))
        return g.select(*keys, "event_count", "window_start", "window_end", "n",
                        F.coalesce(F.col("_top"), F.lit(float("nan"))).alias(out), *([touched] if touched else []))
    if method == "list":
        g = hist.groupBy(*keys).agg(
            F.sum(count_col).alias("event_count"), F.min(first).alias("window_start"),
            F.max(last).alias("window_end"),
            F.sum(F.when(ok, F.col(count_col)).otherwise(F.lit(0))).alias("n"),
            F.sort_array(F.collect_list(F.when(ok, F.struct(v.alias("v"),
                                                           F.col(count_col).alias("c")))))
            .alias("_vals"))
        pct = percentile_of_weighted(F.col("_vals"), F.col("n"), p)
        return g.select(*keys, "event_count", "window_start", "window_end", "n",
                        F.coalesce(pct, F.lit(float("nan"))).alias(out))
    if method != "buckets":
        raise ValueError(f"unknown method {method!r}")
    stats = hist.groupBy(*keys).agg(F.sum(count_col).alias("event_count"),
                                    F.min(first).alias("window_start"),
                                    F.max(last).alias("window_end"))
    pct = percentile_by_buckets(bucketed_histogram(hist, keys, value, count_col), keys, value,
                                p, "_p")
    res = stats.join(pct, on=keys, how="left")
    return res.select(*keys, "event_count", "window_start", "window_end",
                      F.coalesce("n", F.lit(0)).alias("n"),
                      F.when(F.col("n") > 0, F.col("_p")).otherwise(F.lit(float("nan")))
                      .alias(out))
