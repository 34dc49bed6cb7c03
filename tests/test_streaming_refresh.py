"""Refreshing single epochs equals a full rebuild, for every dataset, and
leaves the refreshed epochs to be computed again by the next run."""

import pytest

from ballotlens import session
from ballotlens.plans import datasets as D
from ballotlens.plans.epochs import plan_run
from ballotlens.plans.job import extract_all, read_dataset
from ballotlens.sources import sinks
from ballotlens.sources.catalog import register_source_tables
from ballotlens.sources.tables import Tables
from ballotlens.streaming.incremental import refresh_epochs
from conftest import rows


def test_refresh_equals_rebuild(spark, tables, tmp_path):
    names, out, want = ["gov_action_lifecycle", "epoch_summary", "gov_action_votes", "cc_vote_details"], str(tmp_path / "a"), {}
    extract_all(spark, tables, str(tmp_path / "full"), only=names, full=True)
    for n in names:
        want[n] = rows(read_dataset(spark, str(tmp_path / "full"), n))
    extract_all(spark, tables, out, only=names)
    epochs, _ = plan_run(tables)
    for e in (epochs[3], epochs[-1]):
        refresh_epochs(spark, tables, out, names, [e])
        for n in names:
            assert rows(read_dataset(spark, out, n)) == want[n], (n, e)
    assert sinks.unsettled_marks(spark, f"{out}/epoch_summary") == [epochs[3], epochs[-1]]
    done = extract_all(spark, tables, out, only=["epoch_summary"])
    assert set(done["epoch_summary"]) >= {epochs[3], epochs[-1]}
    assert sinks.unsettled_marks(spark, f"{out}/epoch_summary") == []
    assert rows(read_dataset(spark, out, "epoch_summary")) == want["epoch_summary"]


def test_epochs_of_partitioned_exports_come_from_folder_names(spark, tables, tmp_path):
    src = str(tmp_path / "src")
    tables.adapot.write.partitionBy("epoch").parquet(f"{src}/adapot")
    tables.drep_dist.write.partitionBy("epoch").parquet(f"{src}/drep_dist")
    t = Tables.from_catalog(spark, src)
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup()
    before = tracker.getJobIdsForGroup()
    planned = plan_run(t)
    assert tracker.getJobIdsForGroup() == before                # no job at all
    assert planned == plan_run(tables)
    frame = spark.createDataFrame([(700,)], "epoch int")
    assert plan_run(t.override(adapot=frame.selectExpr("epoch", "1 as treasury")))[0] == [700]


def test_source_views_keep_all_columns_and_report_missing_ones(spark, tables, tmp_path):
    src = str(tmp_path / "src")
    tables.committee.selectExpr("*", "1 as extra").write.parquet(f"{src}/committee")
    assert register_source_tables(spark, src, prefix="w_") == ["w_committee"]
    assert "extra" in spark.table("w_committee").columns
    tables.committee.drop("threshold").write.mode("overwrite").parquet(f"{src}/committee")
    with pytest.raises(ValueError, match="threshold"):
        register_source_tables(spark, src, prefix="w_")


def test_scratch_folder_is_asked_for_on_a_cluster():
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        conf = Conf({"spark.sql.warehouse.dir": "/w"})

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return "set"
    with pytest.raises(ValueError):
        session.scratch_dir(Session())
    Session.conf.set("spark.checkpoint.dir", "hdfs://x/y")
    assert session.scratch_dir(Session()) == "hdfs://x/y"
    Session.conf.set("spark.checkpoint.dir", "/mnt/y")
    with pytest.warns(UserWarning):
        assert session.scratch_dir(Session()) == "/mnt/y"
    Session.sparkContext.master = "local[2]"
    Session.conf.clear()
    Session.conf.set("spark.sql.warehouse.dir", "/w/")
    assert session.scratch_dir(Session()) == "/w/_scratch"


def test_every_dataset_has_a_sink_rule():
    from ballotlens.plans.job import SORT_KEYS
    assert set(SORT_KEYS) == set(D.DATASETS)
