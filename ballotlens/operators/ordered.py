"""Ordered operators that do not gather a hot key into one task.

``lag(x) OVER (PARTITION BY key ORDER BY o)`` and running sums within a key put
every row of a key in one task. Here a key is always cut into *ranges* of its
order column by a fixed rule (a span of slots, or leading digits of a value),
the window runs per ``(key, range)``, and a summary with one row per range
carries the rest across: the last row before the range for ``lag``, counts and
sums of smaller values for running totals. There is one path for every size:
no count decides anything, no Spark job runs while a plan is built, keys and
order values may be NULL, and joins are left to AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_SPAN = 432_000         # slots of an epoch: bounds the events of a key in one range
SUM_SPAN = 4_320            # slots of a hundredth of an epoch
DIGITS = 5                  # leading digits that tell ranges of values apart: 90,000 ranges per power of ten

RANGE = "__range"


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _null_last(order: Sequence[str]) -> list[Column]:
    """Order fields of ``order`` ascending, NULLs last; as a struct they rank
    rows in the same way as a window does that orders by them."""
    return [c for o in order for c in (F.col(o).isNull(), F.col(o))]


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` where NULL equals NULL; ``right``'s keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, same, "left").drop(*[f"__r_{k}" for k in keys])


def value_range(value: Column) -> Column:
    """Range number of a whole number: sign, digit count, first DIGITS digits.
    Monotone in the value. The ranges of a key are bounded by its digits alone,
    however many rows or distinct values it has."""
    digits = F.abs(value.cast("decimal(38,0)")).cast("string")
    size = F.length(digits) * 10 ** DIGITS + F.substring(F.rpad(digits, DIGITS, "0"), 1, DIGITS).cast("int")
    return F.when(value.isNotNull(), F.when(value < 0, -size).otherwise(size))


def lag_within(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str], prefix: str = "prev_",
               span: int = SLOT_SPAN) -> DataFrame:
    """``df`` plus ``prev_<c> = lag(c) OVER (PARTITION BY keys ORDER BY order)``
    (ascending, NULLs last) for each ``c`` in ``cols``. ``order`` must be a
    total order within a key; its first column, a number, is cut into ranges
    of ``span``."""
    keys, order, cols = _list(keys), _list(order), _list(cols)
    x = df.withColumn(RANGE, F.floor(F.col(order[0]) / F.lit(span)))
    kept = F.struct(*[F.col(c) for c in cols])
    inside = Window.partitionBy(*keys, RANGE).orderBy(*_null_last(order))
    x = x.withColumn("__prev", F.lag(kept).over(inside))
    last = x.groupBy(*keys, RANGE).agg(F.max_by(kept, F.struct(*_null_last(order))).alias("__last"))
    ranges = Window.partitionBy(*keys).orderBy(*_null_last([RANGE]))
    carry = last.select(*keys, RANGE, F.lag("__last").over(ranges).alias("__carry"))
    out = _join_null_safe(x, carry, [*keys, RANGE])
    prev = F.coalesce("__prev", "__carry")              # __prev is NULL on the first row of a range only
    return out.select(*df.columns, *[prev[c].alias(prefix + c) for c in cols])


def sum_after(events: DataFrame, probes: DataFrame, keys, order: str, sums: Sequence[str], span: int = SUM_SPAN) -> DataFrame:
    """``probes`` plus, per column of ``sums``, the sum over the ``events`` of the
    same ``keys`` (NULL equals NULL) whose ``order``, a whole number, is larger;
    NULL where there are none. No pairs of probes and events are formed: both are
    laid in one order, cut into ranges of ``span`` per key, summed inside the range, and
    a summary with one row per range carries the sums of the later ranges."""
    keys, sums = _list(keys), _list(sums)
    probe = F.struct(*[F.col(c) for c in probes.columns])
    rows = probes.select(*keys, order, probe.alias("__probe")).unionByName(
        events.filter(F.col(order).isNotNull()).select(*keys, order, *sums), allowMissingColumns=True)
    # every row counts twice: by its place in its range, and by its range in the key
    cut = F.floor(F.col(order) / F.lit(span))
    level = lambda n, part, place: F.struct(F.lit(n).alias("level"), part.cast("long").alias("part"), place.cast("long").alias("place"))
    rows = rows.withColumn("__at", F.explode(F.array(level(0, cut, F.col(order)), level(1, F.lit(None), cut))))
    # events of one range are one row of the key's level before they are shuffled
    rows = rows.groupBy(*keys, "__at", "__probe").agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("__copies"))
    later = (Window.partitionBy(*keys, "__at.level", "__at.part").orderBy(F.desc("__at.place"))
             .rangeBetween(Window.unboundedPreceding, -1))
    seen = rows.select("__probe", "__copies", *[F.sum(c).over(later).alias(f"__s_{c}") for c in sums]).filter("__probe is not null")
    both = seen.groupBy("__probe").agg(*[F.sum(f"__s_{c}").alias(f"__s_{c}") for c in sums], F.max("__copies").alias("__copies"))
    each = both.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    known = F.col(f"__probe.{order}").isNotNull()
    return each.select("__probe.*", *[F.when(known, F.col(f"__s_{c}")).alias(c) for c in sums])


def cumulative_histogram(df: DataFrame, keys, value: str) -> DataFrame:
    """One row per ``keys`` and distinct ``value`` (a whole number, NULLs last):

    * ``n``: rows with that value, ``n_before``: rows with a smaller one;
    * ``sum_before``: exact sum of the smaller values, row by row;
    * ``n_all``, ``sum_all``: the same over the whole key.

    Tied rows are one row after the partial aggregation, so ranks, running
    sums and quantiles over ties need no window over them."""
    keys = _list(keys)
    hist = (df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
            .withColumn(RANGE, value_range(F.col(value))))
    amount = F.coalesce(F.col(value).cast("decimal(38,0)") * F.col("n"), F.lit(0)).cast("decimal(38,0)")
    hist = hist.withColumn("__s", amount)
    zero = lambda c: F.coalesce(c, F.lit(0))
    smaller = (Window.partitionBy(*keys).orderBy(*_null_last([RANGE]))
               .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*keys)
    ranges = (hist.groupBy(*keys, RANGE).agg(F.sum("n").alias("__n"), F.sum("__s").alias("__t"))
              .select(*keys, RANGE, zero(F.sum("__n").over(smaller)).alias("__n0"), zero(F.sum("__t").over(smaller)).alias("__s0"),
                      F.sum("__n").over(whole).alias("n_all"), F.sum("__t").over(whole).alias("sum_all")))
    inside = (Window.partitionBy(*keys, RANGE).orderBy(*_null_last([value]))
              .rowsBetween(Window.unboundedPreceding, -1))
    local = hist.select("*", zero(F.sum("n").over(inside)).alias("__n1"), zero(F.sum("__s").over(inside)).alias("__s1"))
    return _join_null_safe(local, ranges, [*keys, RANGE]).select(
        *keys, value, "n", (F.col("__n0") + F.col("__n1")).alias("n_before"),
        (F.col("__s0") + F.col("__s1")).cast("decimal(38,0)").alias("sum_before"), "n_all",
        F.col("sum_all").cast("decimal(38,0)").alias("sum_all"))
