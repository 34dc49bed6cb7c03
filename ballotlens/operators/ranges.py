"""Interval membership counted per epoch without a theta join.

"member active in epoch e iff start <= e and (end IS NULL or end > e)" is a
range join. Epochs are a small discrete domain, so each interval is expanded
into the epochs it covers (clamped to the epochs asked for) and counted with a
plain equi-aggregation: no BroadcastNestedLoopJoin, and the work is linear in
the covered (member, epoch) pairs however large the member table grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_active_per_epoch(intervals: DataFrame, epochs, start: str, end: str,
                           counted: str, out: str, epoch: str = "epoch") -> DataFrame:
    """``epochs`` (a list, or a frame with column ``epoch``) with the number
    of non-NULL ``counted`` values whose interval ``[start, end)`` covers each
    (``end`` NULL = open). Epochs no interval covers get 0."""
    if isinstance(epochs, DataFrame):
        lo = epochs.select(F.min(epoch)).scalar()
        hi = epochs.select(F.max(epoch)).scalar()
    else:
        lo, hi = F.lit(min(epochs)), F.lit(max(epochs))
        epochs = intervals.sparkSession.createDataFrame([(int(e),) for e in epochs], f"{epoch} int")
    first = F.greatest(F.col(start), lo)
    last = F.least(F.coalesce(F.col(end) - 1, hi), hi)
    covered = (intervals.filter(F.col(counted).isNotNull())
               .select(first.alias("__a"), last.alias("__b"))
               .filter(F.col("__a") <= F.col("__b"))
               .select(F.explode(F.sequence("__a", "__b")).alias(epoch))
               .groupBy(epoch).agg(F.count(F.lit(1)).cast("int").alias(out)))
    return (epochs.join(covered, epoch, "left")
                  .select(epoch, F.coalesce(F.col(out), F.lit(0)).alias(out)))
