"""Sinks and the extraction job: metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from ballotlens.plans import datasets as D
from ballotlens.plans.job import extract_all, read_dataset
from ballotlens.sources import sinks
from ballotlens.sources.catalog import register_kpi_views, register_outputs
from conftest import rows

NAMES = list(D.DATASETS)


def _snapshot(spark, out):
    return {n: rows(read_dataset(spark, out, n)) for n in NAMES}


@pytest.fixture(scope="module")
def full_run(spark, tables, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("full"))
    extract_all(spark, tables, out, full=True)
    return out, _snapshot(spark, out)


def test_full_run_equals_datasets(spark, tables, full_run):
    out, snap = full_run
    for n in NAMES:
        assert snap[n] == rows(D.DATASETS[n](tables)), n


def test_two_incremental_batches_equal_full_run(spark, tables, full_run, tmp_path):
    out = str(tmp_path / "inc")
    first = extract_all(spark, tables, out, settled_through=510)
    assert max(first["drep_epoch_stats"]) == 526            # newest epoch written as unsettled
    assert sinks.unsettled_marks(spark, f"{out}/drep_epoch_stats") == [526]
    second = extract_all(spark, tables, out)
    assert 510 not in second["drep_epoch_stats"] and 511 in second["drep_epoch_stats"]
    assert _snapshot(spark, out) == full_run[1]
    third = extract_all(spark, tables, out)                  # nothing new: nothing rewritten
    assert all(third[n] == [] for n in NAMES if n != "gov_action_lifecycle")
    assert _snapshot(spark, out) == full_run[1]


def test_lifecycle_upsert_moves_stored_open_action_to_terminal(spark, tables, full_run, tmp_path):
    out = str(tmp_path / "life")
    status = tables.gov_action_proposal_status
    early = tables.override(gov_action_proposal_status=status.filter(F.col("status") == "ACTIVE"))
    extract_all(spark, early, out, only=["gov_action_lifecycle"])
    stored = read_dataset(spark, out, "gov_action_lifecycle")
    assert stored.filter(F.col("status").isin("RATIFIED", "ENACTED", "EXPIRED", "DROPPED")).count() == 0
    extract_all(spark, tables, out, only=["gov_action_lifecycle"])
    assert rows(read_dataset(spark, out, "gov_action_lifecycle")) == full_run[1]["gov_action_lifecycle"]


def test_unknown_dataset_name_raises(spark, tables, tmp_path):
    with pytest.raises(ValueError):
        extract_all(spark, tables, str(tmp_path), only=["no_such_dataset"])


def test_output_keys_unique(spark, full_run):
    out, _ = full_run
    keys = {"drep_epoch_stats": ["epoch", "drep_id"], "pool_epoch_stats": ["epoch", "pool_id"],
            "gov_action_lifecycle": ["gov_action_tx_hash", "gov_action_index"], "epoch_summary": ["epoch"],
            "governance_params": ["epoch"]}
    for n, k in keys.items():
        df = read_dataset(spark, out, n)
        assert df.count() == df.select(*k).distinct().count(), n


def test_views_over_written_outputs(spark, full_run, tables):
    out, _ = full_run
    names = register_outputs(spark, out)
    assert set(NAMES) <= set(names)
    views = register_kpi_views(spark)
    assert "kpi_1_1_voting_turnout" in views
    from ballotlens.plans.kpis import Datasets, k1_1_voting_turnout
    want = rows(k1_1_voting_turnout(Datasets.from_tables(tables)))
    assert rows(spark.table("kpi_1_1_voting_turnout")) == want


def test_shuffle_partition_invariance(spark, tables):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = rows(D.epoch_summary(tables)) + rows(D.drep_epoch_stats(tables))
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = rows(D.epoch_summary(tables)) + rows(D.drep_epoch_stats(tables))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == eight


def test_kpis_over_persisted_outputs(spark, tables, full_run):
    from ballotlens.plans.kpis import KPI_FUNCS, Datasets
    out, _ = full_run
    persisted, live = Datasets.from_outputs(spark, out, tables), Datasets.from_tables(tables)
    for name in ("k1_1_voting_turnout", "k1_5_delegation_churn", "p2_1_drep_stake_gini", "p3_1_spo_turnout",
                 "p4_9_min_attack_vector", "p5_4_cc_non_unanimous"):
        assert rows(KPI_FUNCS[name](persisted)) == rows(KPI_FUNCS[name](live)), name
