"""Literal edge cases (FIXTURES §3) on tiny hand-made tables."""

import datetime as dt
import decimal

from ballotlens.plans import datasets as D
from ballotlens.plans import kpis as K
from ballotlens.sources.fixtures import DERIVATIONS
from ballotlens.sources.tables import Tables

T0 = dt.datetime(2024, 1, 1)


def frame(spark, table, data):
    spec = DERIVATIONS[table].columns
    ddl = ", ".join(f"{n} {t}" for n, t, _ in spec)

    def conv(v, t):
        return decimal.Decimal(v) if v is not None and t.startswith("decimal") else v
    full = [tuple(conv(r.get(n), t) for n, t, _ in spec) for r in data]
    return spark.createDataFrame(full, ddl)


def tables(spark, **data):
    return Tables.from_frames(spark, {k: frame(spark, k, v) for k, v in data.items()})


def ds(get_frames):
    return K.Datasets(lambda n: get_frames[n])


def test_ds1_metadata_tie_null_hash_and_two_types(spark):
    t = tables(
        spark,
        drep_dist=[dict(drep_hash="d1", drep_type="ADDR_KEYHASH", drep_id="a", amount=10, epoch=5),
                   dict(drep_hash="d1", drep_type="SCRIPTHASH", drep_id="b", amount=20, epoch=5),
                   dict(drep_hash=None, drep_type="ABSTAIN", drep_id="c", amount=30, epoch=5)],
        drep=[dict(drep_hash="d1", status="REGISTERED", epoch=4, slot=1, tx_index=0, cert_index=0)],
        drep_registration=[dict(type="REG_DREP_CERT", drep_hash="d1", anchor_url=None, epoch=3, slot=9),
                           dict(type="UPDATE_DREP_CERT", drep_hash="d1", anchor_url="m", epoch=4, slot=9)],
        voting_procedure=[dict(voter_type="DREP_KEY_HASH", voter_hash="d1", epoch=5, anchor_url="x"),
                          dict(voter_type="DREP_KEY_HASH", voter_hash="d1", epoch=5)])
    out = {r.drep_id: r for r in D.drep_epoch_stats(t, [5]).collect()}
    assert out["a"].has_metadata is True and out["a"].registration_epoch == 3
    assert out["a"].votes_cast == 2 and out["b"].votes_cast == 2 and out["a"].votes_with_rationale == 1
    assert out["c"].status is None and out["c"].votes_cast == 0 and out["c"].has_metadata is None


def test_ds2_stances(spark):
    t = tables(
        spark,
        pool=[dict(pool_id=p, status="REGISTRATION", amount=1, epoch=5) for p in ("p1", "p2", "p3")],
        voting_procedure=[],
        pool_registration=[dict(pool_id="p1", pool_owners='["c1", "c2"]', epoch=1, slot=1, tx_index=0, cert_index=0),
                           dict(pool_id="p2", pool_owners="[]", epoch=1, slot=1, tx_index=0, cert_index=0),
                           dict(pool_id="p3", pool_owners='["c3"]', epoch=1, slot=1, tx_index=0, cert_index=0)],
        delegation_vote=[dict(credential="c1", drep_type="NO_CONFIDENCE", slot=1, tx_index=0, cert_index=0),
                         dict(credential="c2", drep_type="ABSTAIN", slot=2, tx_index=0, cert_index=0),
                         dict(credential="c3", drep_type="ABSTAIN", slot=1, tx_index=0, cert_index=0),
                         dict(credential="c3", drep_type="ADDR_KEYHASH", slot=5, tx_index=0, cert_index=0)])
    out = {r.pool_id: r.default_stance for r in D.pool_epoch_stats(t, [5]).collect()}
    assert out == {"p1": "ABSTAIN", "p2": None, "p3": "ABSTAIN"}


def test_ds4_status_rules(spark):
    props = [dict(tx_hash=f"g{i}", idx=0, type="INFO_ACTION", deposit=1, epoch=10, block_time=T0) for i in range(6)]
    st = [dict(gov_action_tx_hash="g1", gov_action_index=0, status="ACTIVE", epoch=11)]
    st += [dict(gov_action_tx_hash=f"g{i}", gov_action_index=0, status=s, epoch=12)
           for i, s in zip(range(2, 6), ("RATIFIED", "EXPIRED", "ENACTED", "DROPPED"))]
    t = tables(spark, gov_action_proposal=props, gov_action_proposal_status=st)
    out = {r.gov_action_tx_hash: (r.status, r.epoch_resolved, r.epoch)
           for r in D.gov_action_lifecycle(t, [10]).collect()}
    assert out["g0"] == (None, None, 10) and out["g1"] == ("ACTIVE", None, 10)
    assert all(out[f"g{i}"][1:] == (12, 12) for i in range(2, 6))
    # proposal epoch not requested: only open actions stay
    assert {r.gov_action_tx_hash for r in D.gov_action_lifecycle(t, [99]).collect()} == {"g0", "g1"}


def test_ds5_null_vs_zero_no_committee_and_withdrawal_epoch(spark):
    t = tables(
        spark,
        adapot=[dict(epoch=e, treasury=100, reserves=1, circulation=10, utxo=1, fees=1) for e in (5, 6)],
        block=[], transaction=[], epoch_stake=[], pool=[], committee_member=[], committee=[],
        drep_registration=[],
        drep_dist=[dict(drep_hash="d1", drep_type="ADDR_KEYHASH", amount=7, epoch=5)],
        gov_action_proposal=[dict(tx_hash="w", idx=0, type="TREASURY_WITHDRAWALS_ACTION", epoch=5)],
        gov_action_proposal_status=[dict(gov_action_tx_hash="w", gov_action_index=0, status="ENACTED", epoch=6)])
    out = {r.epoch: r for r in D.epoch_summary(t, [5, 6]).collect()}
    assert out[5].total_drep_delegated_no_confidence is None and out[5].total_drep_delegated == 7
    assert out[5].cc_threshold is None and out[5].cc_member_count == 0
    assert out[5].treasury_withdrawal_total == 1 and out[6].treasury_withdrawal_total == 0


def test_ds8_zero_denominator_and_missing_object(spark):
    params = ('{"drep_deposit": 5, "pool_voting_thresholds": {"pvt_motion_no_confidence": '
              '{"numerator": 51, "denominator": 0}}}')
    t = tables(spark, epoch_param=[dict(epoch=5, params=params)])
    r = D.governance_params(t, [5]).first()
    assert r.drep_deposit == 5 and r.pvt_motion_no_confidence is None and r.dvt_committee_normal is None


def test_k1_1_null_abstain_and_zero_circulation(spark):
    life = spark.createDataFrame(
        [(5, 10, 1, None), (5, 20, 2, 3), (6, 1, 1, 1)],
        "epoch_proposed int, drep_yes_vote_stake long, drep_no_vote_stake long, drep_abstain_vote_stake long")
    summ = spark.createDataFrame([(5, 100), (6, 0)], "epoch int, circulation long")
    out = {r.epoch: r for r in K.k1_1_voting_turnout(ds({"gov_action_lifecycle": life,
                                                         "epoch_summary": summ})).collect()}
    assert out[5].actions_count == 2 and out[5].avg_participating_stake == 25.0
    assert out[5].turnout_pct == 25.0 and out[6].turnout_pct is None


def _events(spark, data):
    return spark.createDataFrame(data, "address string, drep_hash string, drep_type string, epoch int, slot long")


def test_k1_2_counts_addresses_once(spark):
    ev = _events(spark, [("a", "d1", "X", 5, 1), ("a", "d2", "X", 5, 2), ("a", "d1", "X", 7, 3)])
    out = {r.epoch: r for r in K.k1_2_active_stake_participation(ds({"delegation_events": ev})).collect()}
    assert (out[5].active_addresses, out[5].new_addresses, out[5].cumulative_unique_addresses) == (1, 1, 1)
    assert (out[7].active_addresses, out[7].new_addresses, out[7].cumulative_unique_addresses) == (1, 0, 1)


def test_k1_5_churn_three_valued_logic(spark):
    ev = _events(spark, [
        ("a", "d1", "ADDR_KEYHASH", 5, 1), ("a", None, "ABSTAIN", 5, 2),       # DRep -> ABSTAIN: 1
        ("b", None, "ABSTAIN", 5, 1), ("b", "d1", "ADDR_KEYHASH", 5, 2),       # ABSTAIN -> DRep: 0
        ("c", "d1", "ADDR_KEYHASH", 5, 1), ("c", "d1", "SCRIPTHASH", 5, 2),    # same hash, other type: 1
        ("e", "d1", "ADDR_KEYHASH", 5, 1), ("e", "d1", "ADDR_KEYHASH", 5, 2),  # unchanged: 0
    ])
    r = K.k1_5_delegation_churn(ds({"delegation_events": ev})).first()
    assert (r.delegation_changes, r.addresses_changed) == (2, 2)


def test_k1_8_inactive_rule(spark):
    s = spark.createDataFrame([(5, 1, "REGISTERED", None), (5, 2, "REGISTERED", 5), (5, 4, "REGISTERED", 4),
                               (5, 8, "RETIRED", 9)],
                              "epoch int, delegated_amount long, status string, active_until int")
    r = K.k1_8_inactive_delegated_ada(ds({"drep_epoch_stats": s})).first()
    assert (r.inactive_delegated_ada, r.inactive_drep_count) == (12, 2)


def test_gini_all_equal(spark):
    s = spark.createDataFrame([(5, f"d{i}", "ADDR_KEYHASH", 10, "REGISTERED", None) for i in range(4)],
                              "epoch int, drep_hash string, drep_type string, delegated_amount long, status string, active_until int")
    d = ds({"drep_epoch_stats": s})
    assert K.doc2_gini_sample(d).first().gini == -1.0
    assert abs(K.p2_1_drep_stake_gini(d).first().gini) < 1e-12
