"""KPIs on the ranged window operators: the width of the ranges, the number
of input partitions and the order of rows must not change any result."""

import pytest
from pyspark.sql import functions as F

from ballotlens.operators import ordered
from ballotlens.plans import kpis as K
from conftest import rows

CASES = [
    ("k1_5_delegation_churn", K.k1_5_delegation_churn),
    ("doc2_gini_sample", K.doc2_gini_sample),
    ("p1_7_post_vote_delegation_outflow", K.p1_7_post_vote_delegation_outflow),
    ("p2_1_drep_stake_gini", K.p2_1_drep_stake_gini),
    ("p2_7_drep_vote_changes", K.p2_7_drep_vote_changes),
    ("p3_5_stake_concentration", K.p3_5_stake_concentration),
    ("p3_6_spo_vote_changes", K.p3_6_spo_vote_changes),
    ("p4_9_min_attack_vector", K.p4_9_min_attack_vector),
    ("p2_4_drep_time_to_vote", K.p2_4_drep_time_to_vote),
    ("p3_4_spo_vote_latency", K.p3_4_spo_vote_latency),
]


@pytest.fixture(scope="module")
def ds(tables):
    return K.Datasets.from_tables(tables)


@pytest.mark.parametrize("name,fn", CASES, ids=[c[0] for c in CASES])
def test_range_width_changes_nothing(ds, name, fn, monkeypatch):
    plain = rows(fn(ds))
    lag = ordered.lag_within
    monkeypatch.setattr(K, "lag_within", lambda *a, **k: lag(*a, **{**k, "span": 3}))
    monkeypatch.setattr(ordered, "value_range", lambda v: F.floor(v / F.lit(1_000_000)))
    assert rows(fn(ds)) == plain


def test_slot_ties_do_not_depend_on_row_order(spark):
    data = [("a", f"d{i % 3}", "ADDR_KEYHASH", 5, i // 4) for i in range(40)]
    schema = "address string, drep_hash string, drep_type string, epoch int, slot long"
    got = set()
    for events in (data, data[::-1]):
        for parts in (1, 8):
            frame = spark.createDataFrame(events, schema).repartition(parts)
            got.add(tuple(rows(K.k1_5_delegation_churn(K.Datasets(lambda n, f=frame: f)))))
    assert len(got) == 1


def test_spo_turnout_counts_live_pools(spark):
    from ballotlens.sources.tables import Tables
    frames = {
        "epoch_stake": spark.createDataFrame([(5, "s1", 100, "p1"), (5, "s2", 900, "p2"), (5, "s3", 50, "gone")],
                                             "epoch int, address string, amount long, pool_id string"),
        "pool": spark.createDataFrame([("p1", "REGISTRATION", 5, 1), ("p1", "UPDATE", 5, 2), ("gone", "RETIRED", 4, 1)],
                                      "pool_id string, status string, epoch int, slot long")
        .withColumns({"tx_index": F.lit(0), "cert_index": F.lit(0)}),
        "voting_procedure": spark.createDataFrame([("STAKING_POOL_KEY_HASH", "p1", 5)], "voter_type string, voter_hash string, epoch int"),
    }
    d = K.Datasets(lambda n: None, Tables.from_frames(spark, frames), [5])
    r = K.p3_1_spo_turnout(d).first()
    assert (r.active_pools, r.voting_pools, r.active_stake, r.voting_stake, r.turnout_pct) == (2, 1, 1000, 100, 50.0)
    assert K.p3_2_spo_silent_stake(d).first().silent_stake == 900
