"""Dataset sinks: epoch-partitioned parquet with incremental maintenance, stored
as versioned snapshots (see :mod:`ballotlens.sources.snapshots`).

* SNK1/SNK3: ``write_epochs`` replaces exactly the epochs present in the new
  rows; epochs with zero rows write nothing and keep what they had.
* SNK2/SNK4: ``written_epochs`` reads the manifest (no data scan).
* SNK5: ``upsert_by_key`` replaces rows by key and rewrites only the epochs that
  hold a replaced or a new row.
* DS3c/DS6b: ``write_ordered`` writes files that follow each other in a global
  order, with the first and last key of each in the manifest.

Every write becomes visible with one manifest: a reader sees all of it or none.

Layout: rows are rebalanced on ``epoch`` before writing (AQE splits a large
epoch over many tasks and coalesces small ones), so each task writes few,
right-sized files; files are sorted within by the dataset's sort keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlens.sources import snapshots


def layout(df: DataFrame, sort_keys: Sequence[str], partitions: int | None = None,
           epoch: str = "epoch") -> DataFrame:
    """Shuffle by epoch with the REBALANCE hint, then sort within partitions.

    Rebalancing is a hash shuffle on ``epoch`` that AQE post-processes: an
    oversized (hot) epoch is split into advisory-size partitions and small
    ones are coalesced, so each task writes a few right-sized files and no
    sampling pass over the data is needed (range partitioning would run the
    whole plan once more just to sample it)."""
    keys = [F.col(epoch).asc_nulls_last()] + [F.col(k).asc_nulls_last() for k in sort_keys]
    hint_args = ([partitions] if partitions else []) + [epoch]
    return df.hint("rebalance", *hint_args).sortWithinPartitions(*keys)


def _marks(old: Sequence[int], computed: Sequence[int], unsettled: Sequence[int]) -> list[int]:
    return sorted((set(old) - set(computed)) | (set(unsettled) & set(computed)))


def write_epochs(df: DataFrame, path: str, sort_keys: Sequence[str] = (), full: bool = False,
                 partitions: int | None = None, computed: Sequence[int] = (), unsettled: Sequence[int] = (),
                 state: dict | None = None) -> None:
    """Write ``df`` by ``epoch``. Incremental (default): only the epochs present
    in ``df`` are replaced. ``full``: the dataset is replaced. Of the ``computed``
    epochs, ``unsettled`` ones are marked and the others' marks removed, in the
    same commit; ``state`` is merged into the manifest's."""
    spark = df.sparkSession
    base = snapshots.current(spark, path)
    parts = snapshots.stage(layout(df, sort_keys, partitions), path)

    def change(old: dict) -> dict:
        known = set() if full else set(old["state"].get("processed", []))
        return {"parts": parts if full else {**old["parts"], **parts},
                "unsettled": _marks([] if full else old["unsettled"], computed, unsettled),
                "state": {**old["state"], **(state or {}), "processed": sorted(known | set(computed))}}
    snapshots.commit(spark, path, df.schema, change, base)


def written_epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs with rows in the current snapshot."""
    manifest = snapshots.current(spark, path)
    return sorted(int(e) for e in manifest["parts"] if e.lstrip("-").isdigit()) if manifest else []


def processed_epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs that were computed, with or without rows."""
    manifest = snapshots.current(spark, path)
    return sorted(set(written_epochs(spark, path)) | set(manifest["state"].get("processed", []))) if manifest else []


def unsettled_marks(spark: SparkSession, path: str) -> list[int]:
    """Epochs written while still unsettled (to be recomputed next run)."""
    manifest = snapshots.current(spark, path)
    return sorted(manifest["unsettled"]) if manifest else []


def upsert_by_key(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str],
                  sort_keys: Sequence[str] = (), partitions: int | None = None,
                  delete_keys: DataFrame | None = None, state: dict | None = None) -> list[int]:
    """SNK5: stored rows whose key is not in ``new`` (nor in ``delete_keys``) are
    kept, ``new`` rows win. Epochs that hold neither a replaced nor a new row keep
    their folders and are only read for their keys. ``new`` and the deleted keys are read several
    times: pass stored frames. Returns the epochs rewritten."""
    keys = list(keys)
    base = snapshots.current(spark, path)
    if base is None:
        write_epochs(new, path, sort_keys, partitions=partitions, state=state)
        return written_epochs(spark, path)
    replaced = new.select(*keys)
    if delete_keys is not None:
        replaced = replaced.unionByName(delete_keys.select(*keys))
    replaced = replaced.distinct()
    stored = snapshots.read(spark, path, base)
    touched = (stored.select("epoch", *keys).join(replaced, keys, "left_semi").select("epoch")
               .unionByName(new.select("epoch")).distinct())
    names = {str(r.epoch) for r in touched.collect()}           # bounded by the number of epochs
    old = snapshots.read(spark, path, base, sorted(names)).select(*new.columns)
    merged = old.join(replaced, keys, "left_anti").unionByName(new)
    parts = snapshots.stage(layout(merged, sort_keys, partitions), path)

    def change(before: dict) -> dict:
        kept = {e: p for e, p in before["parts"].items() if e not in names}
        return {"parts": {**kept, **parts}, "unsettled": before["unsettled"], "state": {**before["state"], **(state or {})}}
    snapshots.commit(spark, path, new.schema, change, base)
    return sorted(int(e) for e in names if e.lstrip("-").isdigit())


# ------------------------------------------------------------ ordered files

def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [c for o in order for c in (F.col(o).isNull().alias(f"{o}__null"), F.col(o))]


def _key(order: Sequence[str]) -> Column:
    """A struct that compares like ORDER BY ``order`` ascending, NULLs last."""
    return F.struct(*_nulls_last(order))


def _with_place(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).parquet(path)
            .select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")))


def write_ordered(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> dict:
    """Write ``df`` to files that follow each other in ``order`` (ascending, NULLs
    last) and are sorted within, as a new version under ``path``. No sort of the
    whole: rows are range-partitioned, then sorted in their partitions. The
    manifest has each file's rows, first and last key; it is returned."""
    spark, order = df.sparkSession, list(order)
    ranges = [F.col(o).asc_nulls_last() for o in order]
    dealt = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    run = f"r{uuid.uuid4().hex[:16]}"
    dealt.sortWithinPartitions(*ranges).write.parquet(f"{path}/{snapshots.DATA}/{run}")
    key = _key(order)
    listed = (_with_place(spark, f"{path}/{snapshots.DATA}/{run}", df.schema).groupBy("__file")
              .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")).orderBy("first", "last")
              .select("__file", "rows", F.to_json("first").alias("first"), F.to_json("last").alias("last")).collect())
    manifest = {"run": run, "order": order, "schema": df.schema.jsonValue(),
                "files": [{"file": r["__file"], "rows": r["rows"], "first": json.loads(r["first"]), "last": json.loads(r["last"])}
                          for r in listed]}
    found = snapshots.newest(spark, f"{path}/{snapshots.MANIFESTS}", "o-")
    snapshots.publish_text(spark, f"{path}/{snapshots.MANIFESTS}", f"o-{(found[0] if found else 0) + 1:010d}.json", json.dumps(manifest))
    return manifest


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that ``write_ordered`` published, with the place of
    each row: ``__file`` (its number in the order) and ``__row``."""
    from pyspark.sql.types import StructType
    _, m = snapshots.newest(spark, f"{path}/{snapshots.MANIFESTS}", "o-")
    number = F.create_map(*[F.lit(x) for i, f in enumerate(m["files"]) for x in (f["file"], i)]) if m["files"] else None
    rows = _with_place(spark, f"{path}/{snapshots.DATA}/{m['run']}", StructType.fromJson(m["schema"]))
    return rows.withColumn("__file", number[F.col("__file")] if number is not None else F.lit(None).cast("int"))


def order_faults(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Per value of ``by`` (or over all): ``rows``, ``misplaced`` rows (smaller than the row
    before them in their file) and ``overlaps`` (files whose first key is smaller
    than the last key of the file before). Both are 0 for a right order. The
    check reads files row by row in their order and compares file borders; it
    never sorts the whole."""
    _, m = snapshots.newest(spark, f"{path}/{snapshots.MANIFESTS}", "o-")
    rows, order = read_ordered(spark, path), m["order"]
    inside = Window.partitionBy("__file").orderBy("__row")
    key = _key(order)
    seen = rows.withColumn("__key", key).withColumn("__before", F.lag("__key").over(inside))
    borders = seen.groupBy("__file").agg(F.min_by("__key", "__row").alias("first"), F.max_by("__key", "__row").alias("last"))
    nexts = borders.select((F.col("__file") + 1).alias("__file"), F.col("last").alias("__last"))      # one row a file
    late = borders.join(nexts, "__file").filter(F.col("first") < F.col("__last")).select("__file", F.lit(1).alias("__late"))
    marked = seen.join(late, "__file", "left")
    wrong = [F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("__key") < F.col("__before"), 1)).alias("misplaced"),
             F.count_distinct(F.when(F.col("__late") == 1, F.col("__file"))).alias("overlaps")]
    return marked.groupBy(*by).agg(*wrong)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
