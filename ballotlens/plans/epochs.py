"""Epoch planning (META1-4): which epochs a run computes.

All four are tiny aggregates over ``adapot`` / ``drep_dist``; the lists they
return are bounded by the number of epochs (one row per epoch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballotlens.sources.tables import Tables


def settled_epochs(t: Tables) -> DataFrame:
    """META1: distinct epochs of ``adapot`` (the settled ones)."""
    return t.adapot.select(F.col("epoch").cast("int").alias("epoch")).distinct()


def max_epoch(t: Tables) -> Column:
    """META2: highest ``adapot`` epoch, as a scalar subquery; errors on an
    empty table instead of returning NULL."""
    m = F.max("epoch")
    return t.adapot.select(
        F.when(m.isNull(), F.raise_error(F.lit("adapot is empty: no epochs to plan")))
         .otherwise(m).cast("int")).scalar()


def governance_start(t: Tables) -> Column:
    """META3: first epoch with a ``drep_dist`` row; 0 when there is none."""
    return t.drep_dist.select(F.coalesce(F.min("epoch"), F.lit(0)).cast("int")).scalar()


def target_epochs(t: Tables, settled_through: int | None = None) -> DataFrame:
    """META4: settled epochs from the governance start on, plus the newest
    epoch when it is not among them (it is rewritten each run).

    ``settled_through`` lets a caller declare the newest epochs unsettled
    explicitly; by default every ``adapot`` epoch counts as settled.
    """
    settled = settled_epochs(t)
    if settled_through is not None:
        settled = settled.filter(F.col("epoch") <= settled_through)
    start = governance_start(t)
    keep = settled.filter(F.col("epoch") >= start)
    m = F.max("epoch")
    newest = t.adapot.agg(
        F.when(m.isNull(), F.raise_error(F.lit("adapot is empty: no epochs to plan")))
         .otherwise(m).cast("int").alias("epoch"))
    unsettled = newest.join(keep, "epoch", "left_anti")
    return keep.unionByName(unsettled)


def plan_run(t: Tables, settled_through: int | None = None) -> tuple[list[int], list[int]]:
    """META4 materialised once per set of tables: ``(target epochs, unsettled
    epochs)``.

    Same rule as :func:`target_epochs`. Where the snapshot tables are folders
    partitioned by epoch, the folder names answer and nothing is read; else one
    aggregate job does. The lists are bounded by the number of epochs, so they
    are collected; plans then filter with a literal ``epoch IN (...)``, which
    reaches the parquet scan (and prunes ``epoch=N/`` partitions) instead of a
    semi-join subplan.
    """
    if settled_through not in t.plans:
        t.plans[settled_through] = _plan(t, settled_through)
    targets, unsettled = t.plans[settled_through]
    return list(targets), list(unsettled)


def _plan(t: Tables, settled_through: int | None) -> tuple[list[int], list[int]]:
    settled, started = t.partition_epochs("adapot"), t.partition_epochs("drep_dist")
    parts = []
    if settled is None:
        parts.append(t.adapot.select(F.col("epoch").cast("int").alias("e"), F.lit(True).alias("a")))
    if started is None:
        parts.append(t.drep_dist.select(F.col("epoch").cast("int").alias("e"), F.lit(False).alias("a")))
    if parts:
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        row = rows.agg(F.collect_set(F.when(F.col("a"), F.col("e"))).alias("settled"),
                       F.min(F.when(~F.col("a"), F.col("e"))).alias("start")).collect()[0]
        settled = row.settled if settled is None else settled
        started = [row.start] if started is None and row.start is not None else started
    if not settled:
        raise ValueError("adapot is empty: no epochs to plan")
    start, newest = min(started or [0]), max(settled)
    keep = {e for e in settled if (settled_through is None or e <= settled_through) and e >= start}
    unsettled = [] if newest in keep else [newest]
    return sorted(keep | set(unsettled)), unsettled


def plan_epochs(t: Tables, settled_through: int | None = None) -> list[int]:
    """The target epochs of :func:`plan_run`."""
    return plan_run(t, settled_through)[0]


def epoch_flag(df: DataFrame, epochs, on: str = "epoch",
               flag: str = "__in_epochs") -> DataFrame:
    """``df`` with a boolean ``flag``: is ``df[on]`` one of ``epochs``?"""
    if not isinstance(epochs, DataFrame):
        return df.withColumn(flag, F.coalesce(F.col(on).isin(list(epochs)), F.lit(False)))
    marks = epochs.select(F.col("epoch").alias(on)).distinct().withColumn(flag, F.lit(True))
    # one row per epoch: bounded broadcast
    return (df.join(F.broadcast(marks), on, "left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def in_epochs(df: DataFrame, epochs, on: str = "epoch") -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``epochs`` (a list: pushed-down IN
    filter; a frame: broadcast semi join, bounded by the epoch count)."""
    if not isinstance(epochs, DataFrame):
        return df.filter(F.col(on).isin(list(epochs)))
    return df.join(F.broadcast(epochs.select(F.col("epoch").alias(on))), on, "left_semi")
