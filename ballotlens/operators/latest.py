"""Latest-row and as-of lookups.

``latest_by`` is a plain ``groupBy().agg(max_by(...))``: Spark aggregates it
partially on the map side, so a key holding a third of all rows is reduced
before the shuffle (a ``row_number()`` window would sort every row of that key
in one task).

``asof_latest`` answers "latest event with ``epoch <= N``" for every snapshot
row in one pass, instead of one query per epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the ``values`` of the row with the greatest
    ``order`` tuple (NULL order fields rank lowest, like ``DESC NULLS LAST``).
    Extend ``order`` with tie-breakers so the winner is deterministic."""
    packed = F.struct(*[F.col(v) for v in values])
    rank = F.struct(*[F.col(o) for o in order])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, rank).alias("__latest"))
              .select(*keys, *[F.col(f"__latest.{v}").alias(v) for v in values]))


def asof_latest(snapshots: DataFrame, events: DataFrame, key: str, epoch: str,
                order: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Attach to every snapshot row the ``value`` of the latest event (by
    ``order``) of the same ``key`` with ``events.epoch <= snapshots.epoch``.

    Snapshots and events are unioned and one running ``max(struct)`` per key
    over the epoch order does the lookup: one scan of each input, a single
    shuffle on ``key``, linear per key, exact even when ``order`` is not
    monotone in epoch, and a NULL ``value`` on the winning event stays NULL.
    A key holds at most one snapshot row per epoch plus its own events, so no
    window group grows with the data volume.

    Events with a NULL key or epoch match nothing. Snapshot rows with a NULL
    key have the value NULL and go round the window.
    """
    out = out or value
    snap_cols = snapshots.columns
    ev_struct = F.struct(*[F.col(o) for o in order], F.col(value).alias("__v"))
    ev = (events.filter(F.col(key).isNotNull() & F.col(epoch).isNotNull())
          .select(F.col(key), F.col(epoch), ev_struct.alias("__ev")))
    ev_type = ev.schema["__ev"].dataType
    snap_side = snapshots.filter(F.col(key).isNotNull()).select(
        *[F.col(c) for c in snap_cols], F.lit(None).cast(ev_type).alias("__ev"), F.lit(True).alias("__snap"))
    ev_side = ev.select(*[(F.col(c) if c in (key, epoch) else
                           F.lit(None).cast(snapshots.schema[c].dataType)).alias(c)
                          for c in snap_cols], F.col("__ev"), F.lit(False).alias("__snap"))
    w = (Window.partitionBy(key).orderBy(F.col(epoch))
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = (snap_side.unionByName(ev_side)
             .withColumn("__best", F.max("__ev").over(w))
             .filter(F.col("__snap"))
             .select(*snap_cols, F.col("__best.__v").alias(out)))
    keyless = snapshots.filter(F.col(key).isNull()).select(
        *snap_cols, F.lit(None).cast(events.schema[value].dataType).alias(out))
    return found.unionByName(keyless)
