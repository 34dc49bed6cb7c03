"""What the tasks of a query hold, so that they do not grow with the tables."""

from pyspark.sql import functions as F

from ballotlens import registry
from ballotlens.plans import datasets as D
from ballotlens.plans import kpis as K


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_outflow_never_broadcasts_stakes(tables):
    """p1_7: stakes are estimated by the rows before they are expanded by epoch."""
    plan = optimized(K.p1_7_post_vote_delegation_outflow(K.Datasets.from_tables(tables)))
    assert "rightHint=(strategy=merge)" in plan


def test_rejected_rows_parse_a_text_once(tables):
    """d4: one parse into fields and one test for malformed text per table, none in filters."""
    assert optimized(D.rejected_rows(tables)).count("from_json(") <= 6


def test_snapshot_tables_are_made_in_many_tasks(spark, tables):
    """ds5 and others: one row group of the driver table is not one task's snapshot table."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("drep_dist", "epoch_stake"):
        assert tables[name].rdd.getNumPartitions() >= parts


def test_a_large_epoch_is_exported_by_several_tasks(spark, tmp_path):
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7).cast("int").alias("epoch"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        registry.export({"t": rows}, str(tmp_path), ["t"])
    finally:
        spark.conf.set(key, before)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 40_000 and back.exceptAll(rows.select(*back.columns)).count() == 0
    assert len(list((tmp_path / "t" / "epoch=7").glob("*.parquet"))) > 1


def test_ordered_files_follow_the_size(spark, monkeypatch):
    """ds3c: no fixed number of files, each a task that sorts and checks it."""
    from ballotlens.sources import sinks
    seen, write = [], sinks.write_ordered

    def spy(df, path, order, files=None):
        seen.append(files)
        return write(df, path, order, files)
    monkeypatch.setattr(sinks, "write_ordered", spy)
    got = registry.QUERIES["ds6b_ordered_events"](spark, "/root/testdata/sf0.001").collect()
    assert seen == [None] and got and all(r.misplaced == 0 and r.overlaps == 0 for r in got)
