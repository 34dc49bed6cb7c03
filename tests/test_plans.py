"""Physical-plan properties on real export folders (no fixture derivation)."""

import contextlib
import io
import re

import pytest

from ballotlens.plans import datasets as D
from ballotlens.plans import kpis as K
from ballotlens.sources.fixtures import DERIVATIONS
from ballotlens.sources.tables import Tables


@pytest.fixture(scope="module")
def exports(spark, tables, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("exports"))
    for name in DERIVATIONS:
        tables[name].write.partitionBy("epoch").parquet(f"{src}/{name}")
    return Tables.from_catalog(spark, src)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    return p.split("\n\n\n")[0]


def test_ds1_prunes_partitions_and_shuffles_the_snapshot_once(exports):
    p = plan(D.drep_epoch_stats(exports))
    t = tree(p)
    assert re.search(r"drep_dist\]\nPartitionFilters: \[epoch#\d+ INSET", p)
    assert "PushedFilters: [In(voter_type, [DREP_KEY_HASH,DREP_SCRIPT_HASH])" in p
    assert "Join" not in t                                          # lookups are windows, not joins
    # one exchange + one sort feed all three windows (as-of, votes, registration)
    assert re.search(r"Window \(\d+\)\n[\s:]+\+- Sort \(\d+\)\n[\s:]+\+- Exchange \(\d+\)\n[\s:]+\+- Union", t)
    assert len(re.findall(r"\bSort \(", t)) == 3                    # that one + two inside partial aggs
    assert "c_custkey" not in p                                     # no fixture in the plan


def test_ds5_joins_are_broadcast_only(exports):
    t = tree(plan(D.epoch_summary(exports)))
    assert "SortMergeJoin" not in t and "BroadcastNestedLoopJoin" not in t
    assert "Window" not in t


def test_ds3_reads_only_needed_columns(exports):
    p = plan(D.gov_action_votes(exports))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert schemas and not any("tx_index" in s for s in schemas)    # unused column pruned at the scan


def test_churn_windows_per_range_and_carries_edges(exports):
    t = tree(plan(K.k1_5_delegation_churn(K.Datasets.from_tables(exports))))
    assert len(re.findall(r"\bWindow \(", t)) == 2                  # within ranges, and over the range summaries
    assert "NestedLoop" not in t and "Cartesian" not in t            # NULL-safe keys still join by equality


def test_plans_of_ds6_and_ds8_leave_the_stake_snapshot_alone(exports):
    for df in (D.delegation_events(exports), D.governance_params(exports)):
        assert "drep_dist" not in plan(df)
