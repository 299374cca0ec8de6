"""O-14: the exact 95th percentile with "legacy" interpolation.

Values sorted ascending x1..xn (NaN removed), p = 0.95:

    pos = p * (n + 1)
    pos < 1   -> x1
    pos >= n  -> xn
    otherwise -> x[f] + (pos - f) * (x[f+1] - x[f]),  f = floor(pos)

A group of exactly one value returns that value as is (even NaN); an empty
group returns 0.0. The multiplication order ``p * (n + 1)`` matters for the
last bits of the result. Any group of n <= 19 returns its maximum.

This module only holds column expressions. The distributed selection of the
two order statistics lives in ``fleetpulse.operators.quantile``; the form
over a sorted array here is for small, bounded groups (streaming state,
single windows, tests).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The percentile the metrics are defined by.
P95 = 0.95


def max_rule_holds(bound: int, p: float = P95) -> bool:
    """True when every group of at most ``bound`` values returns its
    maximum (pos >= n for all n <= bound), checked in the same double
    arithmetic the expressions use. For p = 0.95 this is n <= 19."""
    return all(p * (n + 1) >= n for n in range(1, int(bound) + 1))


def max_rule_limit(p: float = P95) -> int:
    """The largest size up to which every group returns its maximum."""
    n = 0
    while n < 1000 and p * (n + 2) >= n + 1:
        n += 1
    return n


def legacy_position(n: Column, p: float = P95) -> Column:
    """pos = p * (n + 1), in double arithmetic."""
    return F.lit(float(p)) * (n + F.lit(1)).cast("double")


def legacy_ranks(n: Column, p: float = P95) -> tuple[Column, Column, Column]:
    """(pos, r_lo, r_hi): the 1-based ranks whose values the result needs.

    For pos < 1 both ranks are 1, for pos >= n both are n, otherwise
    floor(pos) and floor(pos) + 1.
    """
    pos = legacy_position(n, p)
    f = F.floor(pos).cast("long")
    r_lo = F.when(pos < 1, F.lit(1)).when(pos >= n, n).otherwise(f).cast("long")
    r_hi = F.when(pos < 1, F.lit(1)).when(pos >= n, n).otherwise(f + 1).cast("long")
    return pos, r_lo, r_hi


def legacy_combine(x_lo: Column, x_hi: Column, n: Column, p: float = P95) -> Column:
    """Combine the two order statistics into the percentile."""
    pos = legacy_position(n, p)
    inner = x_lo + (pos - F.floor(pos)) * (x_hi - x_lo)
    return (F.when(n <= 0, F.lit(0.0))
            .when((pos < 1) | (pos >= n), x_lo)
            .otherwise(inner))


def percentile_of_sorted(arr: Column, p: float = P95) -> Column:
    """Legacy percentile over an ascending array without NaN (1-based
    element_at). Empty -> 0.0."""
    n = F.size(arr).cast("long")
    _, r_lo, r_hi = legacy_ranks(n, p)
    safe_lo = F.when(n > 0, r_lo).otherwise(F.lit(1))
    safe_hi = F.when(n > 0, r_hi).otherwise(F.lit(1))
    return legacy_combine(F.try_element_at(arr, safe_lo.cast("int")),
                          F.try_element_at(arr, safe_hi.cast("int")), n, p)


def p95_of_values(values: Column, p: float = P95) -> Column:
    """Legacy percentile of an unsorted array that may hold NaN.

    A single-element array returns its element as is; otherwise NaN is
    dropped before the percentile, and an all-NaN array gives NaN.
    """
    clean = F.sort_array(F.filter(values, lambda x: ~F.isnan(x)))
    size_all = F.size(values)
    return (F.when(size_all == 1, F.try_element_at(values, F.lit(1)))
            .when((size_all > 1) & (F.size(clean) == 0), F.lit(float("nan")))
            .otherwise(percentile_of_sorted(clean, p)))


def weighted_value_at(vals: Column, below: Column, rank: Column) -> Column:
    """First value of an ascending list of (v, c) structs whose running
    count, started at ``below``, reaches ``rank`` (null if never)."""
    init = F.struct(below.cast("long").alias("acc"), F.lit(None).cast("double").alias("x"))

    def step(s, e):
        acc = s["acc"] + e["c"]
        x = F.when(s["x"].isNull() & (acc >= rank), e["v"]).otherwise(s["x"])
        return F.struct(acc.alias("acc"), x.alias("x"))

    return F.aggregate(vals, init, step, lambda s: s["x"])


def percentile_of_weighted(vals: Column, n: Column, p: float = P95) -> Column:
    """Legacy percentile of an ascending (v, c) list holding n usable
    values; null when n = 0."""
    _, r_lo, r_hi = legacy_ranks(n, p)
    zero = F.lit(0).cast("long")
    return F.when(n > 0, legacy_combine(weighted_value_at(vals, zero, r_lo),
                                        weighted_value_at(vals, zero, r_hi), n, p))
