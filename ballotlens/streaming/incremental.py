"""Incremental epoch maintenance driven by Structured Streaming.

New export files of a *trigger* table (e.g. ``delegation_vote/epoch=N/``)
arrive over time. A file stream over that folder, run with
``trigger(availableNow=True)``, hands each micro-batch of new rows to
``foreachBatch``, which

1. takes the distinct epochs in the batch (bounded by the epoch count),
2. recomputes the chosen datasets for those epochs from the *whole* source
   tables (partition-pruned reads), and
3. stores them by the rules of the extraction job (``job.maintain``): epoch
   partitions are replaced, the action lifecycle is merged by key, and epochs
   whose withdrawals were enacted are summed again.

Step 2 reads the full epoch, not just the batch, so files of one epoch
arriving in several batches still give the complete epoch; and a batch that
is replayed after a failure recomputes the same partitions with the same
result (idempotent output), while the stream checkpoint in the shared
checkpoint folder records which files were consumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ballotlens.plans import datasets as D
from ballotlens.plans.epochs import plan_run
from ballotlens.plans.job import maintain
from ballotlens.session import scratch_dir
from ballotlens.sources import sinks
from ballotlens.sources.catalog import source_schema
from ballotlens.sources.tables import Tables


def refresh_epochs(spark: SparkSession, tables: Tables, out_dir: str, names: Sequence[str],
                   epochs: Sequence[int]) -> None:
    """Bring ``names`` up to date for ``epochs``, by the same rules as a run
    of the extraction job. More files of these epochs may follow, so they are
    marked unsettled: the next run computes them once more."""
    epochs = sorted(set(int(e) for e in epochs))
    if not epochs:
        return
    # only these two depend on the run's target epochs
    targets = plan_run(tables)[0] if {"gov_action_lifecycle", "epoch_summary"} & set(names) else epochs
    for name in names:
        marked = sinks.unsettled_marks(spark, f"{out_dir}/{name}")
        maintain(spark, tables, out_dir, name, epochs, targets, unsettled=[*epochs, *marked], record=False)


def start_epoch_stream(spark: SparkSession, source_dir: str, trigger_table: str, out_dir: str,
                       names: Sequence[str], checkpoint: str | None = None,
                       tables: Tables | None = None, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``. ``checkpoint``
    defaults to ``<spark.checkpoint.dir>/stream-<trigger>-<out name>``."""
    unknown = sorted(set(names) - set(D.DATASETS))
    if unknown:
        raise ValueError(f"unknown dataset(s): {', '.join(unknown)}")
    path = f"{source_dir}/{trigger_table}"
    ckpt = checkpoint or f"{scratch_dir(spark)}/stream-{trigger_table}-{out_dir.rstrip('/').split('/')[-1]}"
    src = Tables.from_catalog(spark, source_dir) if tables is None else tables

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        epochs = [r.epoch for r in batch.select("epoch").distinct().collect()]
        refresh_epochs(spark, src, out_dir, names, epochs)

    stream = (spark.readStream.schema(source_schema(trigger_table))
              .option("basePath", path).parquet(path))
    writer = stream.select("epoch").writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
