"""File stream over an epoch-partitioned export drives incremental DS6."""

from pyspark.sql import functions as F

from ballotlens.plans import datasets as D
from ballotlens.plans.job import read_dataset
from ballotlens.sources.catalog import source_schema
from ballotlens.sources.tables import Tables
from ballotlens.streaming import start_epoch_stream
from conftest import rows


def test_stream_batches_equal_batch_computation(spark, tables, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    dv = tables.delegation_vote.select(*[c.split()[0] for c in source_schema("delegation_vote").split(", ")])
    half = F.col("tx_index") % 2 == 0          # epoch 515 arrives in two drops
    first_drop = (F.col("epoch") < 515) | ((F.col("epoch") == 515) & half)
    dv.filter(first_drop).write.partitionBy("epoch").parquet(f"{src}/delegation_vote")
    catalog = Tables.from_catalog(spark, src)
    q = start_epoch_stream(spark, src, "delegation_vote", out, ["delegation_events"], checkpoint=ckpt,
                           tables=catalog)
    q.awaitTermination()
    first = rows(read_dataset(spark, out, "delegation_events"))
    # second drop: the later epochs and the other half of epoch 515
    dv.filter(~first_drop).write.mode("append").partitionBy("epoch").parquet(f"{src}/delegation_vote")
    q = start_epoch_stream(spark, src, "delegation_vote", out, ["delegation_events"], checkpoint=ckpt,
                           tables=Tables.from_catalog(spark, src))
    q.awaitTermination()
    all_epochs = sorted(r.epoch for r in dv.select("epoch").distinct().collect())
    want = rows(D.delegation_events(tables, all_epochs))
    got = rows(read_dataset(spark, out, "delegation_events"))
    assert len(first) < len(got)
    assert got == want
