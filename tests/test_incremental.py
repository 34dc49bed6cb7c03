"""Runs driven by changed source files: equal to a rebuild, and no more work than
the changes ask for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ballotlens.plans import datasets as D
from ballotlens.plans.dependencies import ALL, DEPENDS, pending_by_change
from ballotlens.plans.job import _kept, affected_actions, extract_all, lifecycle_of, read_dataset, with_proposals
from ballotlens.sources import snapshots
from ballotlens.sources.catalog import open_catalog, save_catalog
from ballotlens.sources.tables import Tables
from conftest import rows
from test_edge_cases import frame

T0 = dt.datetime(2024, 1, 1)


def proposal(i, epoch):
    return dict(tx_hash=f"g{i}", idx=0, type="INFO_ACTION", deposit=1, epoch=epoch, block_time=T0)


def status(i, state, epoch, stats='{"cc_yes": 1}'):
    return dict(gov_action_tx_hash=f"g{i}", gov_action_index=0, type="INFO_ACTION", status=state, voting_stats=stats, epoch=epoch)


def deliver(spark, src, table, data, mode="append"):
    frame(spark, table, data).write.mode(mode).partitionBy("epoch").parquet(f"{src}/{table}")


@pytest.fixture()
def exports(spark, tmp_path):
    src = str(tmp_path / "src")
    deliver(spark, src, "gov_action_proposal", [proposal(i, 10 + i % 5) for i in range(20)])
    deliver(spark, src, "gov_action_proposal_status",
            [status(i, "ACTIVE", 10 + i % 5) for i in range(20)] + [status(i, "EXPIRED", 13 + i % 5) for i in range(0, 14)]
            + [status(90, "EXPIRED", 16)])                                  # names no proposal
    deliver(spark, src, "adapot", [dict(epoch=e, treasury=1, reserves=1, circulation=1, utxo=1, fees=1) for e in range(10, 18)])
    deliver(spark, src, "drep_dist", [dict(drep_hash="d", drep_type="ADDR_KEYHASH", drep_id="d", amount=1, epoch=10)])
    return src


def run(spark, src, out, **kw):
    return extract_all(spark, Tables.from_catalog(spark, src), out, only=["gov_action_lifecycle"], **kw)


def test_lifecycle_follows_changes_and_leaves_the_rest_alone(spark, exports, tmp_path):
    out, full = str(tmp_path / "out"), str(tmp_path / "full")
    path = f"{out}/gov_action_lifecycle"
    run(spark, exports, out)
    before = snapshots.current(spark, path)
    run(spark, exports, out)
    assert snapshots.current(spark, path)["version"] == before["version"]           # nothing changed: nothing done
    # a new epoch: two actions are decided, one is proposed, one gets a status row; an orphan status too
    deliver(spark, exports, "adapot", [dict(epoch=18, treasury=1, reserves=1, circulation=1, utxo=1, fees=1)])
    deliver(spark, exports, "gov_action_proposal", [proposal(50, 18)])
    deliver(spark, exports, "gov_action_proposal_status", [status(15, "RATIFIED", 18), status(16, "DROPPED", 18), status(17, "ACTIVE", 18),
                                                           status(91, "ACTIVE", 18), status(3, "ENACTED", 18)])
    t = Tables.from_catalog(spark, exports)
    hit = affected_actions(t, snapshots.read(spark, path), [18])
    named = {r.gov_action_tx_hash for r in hit.collect()}
    assert named == {f"g{i}" for i in (3, 50, 91, *range(14, 20))}                  # the open ones and those with rows in 18
    part = with_proposals(t, _kept(hit, "hit"))
    assert {r.gov_action_tx_hash for r in part.collect()} == named - {"g91"}
    run(spark, exports, out)
    run(spark, exports, full, full=True)
    assert rows(read_dataset(spark, out, "gov_action_lifecycle")) == rows(read_dataset(spark, full, "gov_action_lifecycle"))
    after = snapshots.current(spark, path)
    moved = {e for e in {*before["parts"], *after["parts"]} if before["parts"].get(e) != after["parts"].get(e)}
    closed = {str(13 + i % 5) for i in range(14) if i != 3}
    assert "18" in moved and closed - moved, moved                                  # epochs of untouched actions keep their folders


def test_corrected_and_withdrawn_source_rows(spark, exports, tmp_path):
    out, full = str(tmp_path / "out"), str(tmp_path / "full")
    run(spark, exports, out)
    src = spark.read.parquet(f"{exports}/gov_action_proposal_status")
    kept = src.filter("epoch = 15 and gov_action_tx_hash <> 'g2'").drop("epoch").collect()      # the row that closed g2 is withdrawn
    fields = src.drop("epoch").schema
    spark.createDataFrame(kept, fields).write.mode("overwrite").parquet(f"{exports}/gov_action_proposal_status/epoch=15")
    gone = spark.read.parquet(f"{exports}/gov_action_proposal").filter("epoch = 11 and tx_hash <> 'g6'").drop("epoch")
    spark.createDataFrame(gone.collect(), gone.schema).write.mode("overwrite").parquet(f"{exports}/gov_action_proposal/epoch=11")
    run(spark, exports, out)
    run(spark, exports, full, full=True)
    got = read_dataset(spark, out, "gov_action_lifecycle")
    assert rows(got) == rows(read_dataset(spark, full, "gov_action_lifecycle"))
    state = {r.gov_action_tx_hash: r.status for r in got.collect()}
    assert state["g2"] == "ACTIVE" and "g6" not in state


def test_statuses_are_read_from_the_first_proposal_on(spark, exports, tmp_path):
    t = Tables.from_catalog(spark, exports)
    actions = _kept(spark.createDataFrame([("g4", 0, 14)], "gov_action_tx_hash string, gov_action_index int, since int"), "one")
    one = lifecycle_of(t, actions, list(range(10, 18)))
    assert [(r.gov_action_tx_hash, r.epoch) for r in one.collect()] == [("g4", 17)]
    read = {p.split("epoch=")[1][:2] for p in t.override().gov_action_proposal_status.filter(F.col("epoch") >= 14).inputFiles()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan and read


def test_epochs_that_follow_from_changed_files():
    old = {"drep_dist": {"5": "a", "6": "b"}, "voting_procedure": {"5": "a", "6": "b"}, "drep": {"1": "a"}, "drep_registration": {"1": "a"}}
    targets = range(4, 9)
    change = lambda **kw: pending_by_change("drep_epoch_stats", old, {**old, **kw}, targets)
    assert change() == set()
    assert change(voting_procedure={"5": "a", "6": "c", "7": "d", "99": "e"}) == {6, 7}
    assert change(drep_dist={"6": "b"}) == {5}                                       # a folder that went
    assert change(drep={"1": "a", "7": "x"}) == {7, 8}                               # as-of lookups: from then on
    assert change(drep={"1": "a", "": "x"}) == set(targets)                          # a file outside an epoch folder
    assert change(drep_registration={"2": "z"}) == set()                             # all-time facts: only if asked for
    assert pending_by_change("drep_epoch_stats", old, {**old, "drep_registration": {"2": "z"}}, targets, all_time=True) == set(targets)
    assert set(DEPENDS) == set(D.DATASETS) and ALL in DEPENDS["epoch_summary"].values()


def test_fingerprints_tell_changed_folders(spark, exports):
    one = Tables.from_catalog(spark, exports)
    prints = one.fingerprints("gov_action_proposal")
    assert set(prints) == {str(e) for e in range(10, 15)}
    deliver(spark, exports, "gov_action_proposal", [proposal(60, 12)])
    assert one.fingerprints("gov_action_proposal") == prints                         # of the run's start
    two = Tables.from_catalog(spark, exports).fingerprints("gov_action_proposal")
    assert {e for e in two if two[e] != prints.get(e)} == {"12"}
    assert one.override(gov_action_proposal=None).fingerprints("gov_action_proposal") is None


def test_missing_column_of_an_export_is_an_error(spark, exports):
    spark.read.parquet(f"{exports}/gov_action_proposal").drop("deposit").write.partitionBy("epoch").parquet(f"{exports}/pool")
    with pytest.raises(ValueError, match="lacks the column"):
        _ = Tables.from_catalog(spark, exports)["pool"]


def test_catalog_outlives_the_session(spark, exports, tmp_path):
    out = str(tmp_path / "out")
    run(spark, exports, out)
    saved = save_catalog(spark, out, exports, prefix="src_")
    other = spark.newSession()
    names = open_catalog(other, out)
    assert names[:1] == ["src_adapot"] and "gov_action_lifecycle" in names and saved["kpi_views"] == []
    assert other.table("gov_action_lifecycle").count() == 20 and other.table("src_adapot").count() == 8
    with pytest.raises(Exception):
        spark.newSession().table("src_adapot").count()
    with pytest.raises(FileNotFoundError):
        open_catalog(other, str(tmp_path / "none"))
