"""Joins and running totals that do not gather a hot key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEAVY = 4096        # a group is heavy from this fraction of all rows on, so there are no more heavy groups than this


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """``rows`` inner joined with ``groups`` (one row per ``keys``, none of them
    NULL), where ``size`` is at least a group's share of ``rows`` and the sizes add up
    to at most ``total``. Groups of ``total / HEAVY`` rows and more are at most HEAVY,
    so they are broadcast and their rows stay where they are; the others are
    shuffled, no key of which has more rows than that. Both frames are read
    twice: pass stored ones."""
    keys = list(keys)
    heavy = groups.filter(F.col(size) * HEAVY >= total)
    light = groups.filter(F.col(size) * HEAVY < total)
    stay = rows.join(F.broadcast(heavy), keys)
    move = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys)
    return stay.unionByName(move)


def before_in_order(rows: DataFrame, key: str, order: str, span: int, sums: dict[str, str], xors: dict[str, str]) -> DataFrame:
    """``rows`` plus, per row, the sums and bitwise xors of columns (output name:
    column) over the rows of the same ``key`` with a smaller ``order`` (a whole
    number, unique in the key, not NULL). Keys are cut into ranges of ``span``:
    the window runs per range, and one row per range carries the ranges before."""
    part = "__part"
    cut = rows.withColumn(part, F.floor(F.col(order) / span))
    outs = {**{o: (F.sum, c) for o, c in sums.items()}, **{o: (F.bit_xor, c) for o, c in xors.items()}}
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = earlier(Window.partitionBy(key, part).orderBy(order))
    ranges = earlier(Window.partitionBy("__key").orderBy(part))
    totals = (cut.groupBy(F.col(key).alias("__key"), part).agg(*[f(c).alias(f"__t_{o}") for o, (f, c) in outs.items()])
              .select("__key", F.col(part).alias("__range"),
                      *[F.coalesce(f(f"__t_{o}").over(ranges), F.lit(0)).alias(f"__c_{o}") for o, (f, _) in outs.items()]))
    local = cut.select("*", *[F.coalesce(f(c).over(inside), F.lit(0)).alias(f"__l_{o}") for o, (f, c) in outs.items()])
    both = local.join(totals, (F.col(key) == F.col("__key")) & (F.col(part) == F.col("__range")))
    return both.select(*rows.columns, *[(F.col(f"__l_{o}") + F.col(f"__c_{o}")).alias(o) for o in sums],
                       *[F.col(f"__l_{o}").bitwiseXOR(F.col(f"__c_{o}")).alias(o) for o in xors])
