"""Exact median per group without holding a group in one task.

``median(x)`` (Spark's exact percentile) keeps every distinct value of a
group in one aggregation buffer, merged in one task; a hot group (one epoch's
whole vote-latency distribution) then sits in one executor's memory.

Here the group is reduced to a histogram with cumulative counts
(:func:`cumulative_histogram`), and the two middle ranks are picked with
ordinary aggregates: for n values at 0-based position ``p = (n - 1) / 2`` the
median is ``v[floor p] + (v[ceil p] - v[floor p]) * (p - floor p)``, the same
interpolation ``median`` uses (identical results for integer inputs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotlens.operators.ordered import cumulative_histogram


def count_and_median(df: DataFrame, keys, value, count: str = "count", out: str = "median") -> DataFrame:
    """One row per ``keys``: ``count`` rows, NULL values included, and ``out``,
    the exact median of the whole-number ``value`` (NULLs ignored; NULL where
    there is none). The input is read once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    v = value if not isinstance(value, str) else F.col(value)
    # a flag in the key keeps NULL values out of the counts of the others
    h = cumulative_histogram(df.select(*keys, v.alias("__v"), v.isNull().alias("__null")), [*keys, "__null"], "__v")
    pos = (F.col("n_all") - 1) / F.lit(2.0)
    upto = F.col("n_before") + F.col("n")
    seen = ~F.col("__null")
    picked = h.groupBy(*keys).agg(
        F.sum("n").alias(count),
        F.min(F.when(seen & (upto >= F.floor(pos) + 1), F.col("__v"))).cast("double").alias("__lo"),
        F.min(F.when(seen & (upto >= F.ceil(pos) + 1), F.col("__v"))).cast("double").alias("__hi"),
        F.max(F.when(seen, pos - F.floor(pos))).alias("__frac"))
    return picked.select(*keys, count, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__frac")).alias(out))


def exact_median(df: DataFrame, keys, value, out: str = "median") -> DataFrame:
    """One row per ``keys`` with ``out`` = exact median of ``value`` (NULLs
    ignored; groups with no values are absent)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return count_and_median(df, keys, value, "__count", out).filter(F.col(out).isNotNull()).select(*keys, out)
