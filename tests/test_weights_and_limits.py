"""Sums after a place, attack vectors over two bodies, dated limits, rejects."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ballotlens.operators import ordered
from ballotlens.plans import datasets as D
from ballotlens.plans import kpis as K
from conftest import rows
from test_edge_cases import tables


def test_sum_after_equals_pairs(spark):
    rnd = random.Random(2)
    key = lambda: "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
    events = [(key(), rnd.randint(-5, 60), rnd.choice([None, rnd.randint(1, 9)])) for _ in range(400)]
    probes = [(key(), rnd.choice([-1, 70, rnd.randint(-5, 60)]), i) for i in range(150)]
    events += [("a", None, 5)]
    probes += [("a", None, 900), ("b", 3, 901), ("b", 3, 901), (None, None, 902)]       # no place; a repeated probe
    ev = spark.createDataFrame(events, "k string, at long, x long").withColumn("one", F.lit(1))
    pr = spark.createDataFrame(probes, "k string, at long, id long")
    want = []
    for k, at, i in probes:
        later = [x for e, o, x in events if e == k and None not in (o, at) and o > at]
        known = [x for x in later if x is not None]
        want.append((i, sum(known) if known else None, len(later) or None))
    for span in (1, 7, 4320):
        for parts in (1, 8):
            got = ordered.sum_after(ev.repartition(parts), pr, "k", "at", ["x", "one"], span=span)
            assert rows(got, ["id", "x", "one"]) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_a_hot_key_is_spread_over_ranges(spark):
    ev = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("at"), F.lit(1).alias("one"))
    pr = spark.createDataFrame([("hot", -1, 0)], "k string, at long, id long")
    out = ordered.sum_after(ev, pr, "k", "at", ["one"])
    assert out.first().one == 100_000
    sizes = ev.groupBy(F.floor(F.col("at") / ordered.SUM_SPAN)).count().agg(F.max("count")).first()[0]
    assert sizes == ordered.SUM_SPAN


def test_ranges_of_values_are_bounded_by_digits(spark):
    n = spark.range(10 ** 6, 10 ** 6 + 300_000).select(ordered.value_range(F.col("id")).alias("r")).distinct().count()
    assert n == 3_000           # seven digits: the first five tell 90,000 ranges apart


def _bodies(spark, dreps, pools, dvt, pvt):
    t = tables(spark, epoch_stake=[dict(epoch=5, address=f"s{i}", amount=x, pool_id=f"p{i}") for i, x in enumerate(pools)], pool=[])
    snap = spark.createDataFrame([(5, f"d{i}", "ADDR_KEYHASH", x, "REGISTERED", None) for i, x in enumerate(dreps)],
                                 "epoch int, drep_hash string, drep_type string, delegated_amount long, status string, active_until int")
    names = [f"{p}_{m}" for m in K.JOINT_MOTIONS for p in ("dvt", "pvt")]
    params = spark.createDataFrame([(5, *[dvt if n.startswith("dvt") else pvt for n in names])],
                                   "epoch int, " + ", ".join(f"{n} double" for n in names))
    d = K.Datasets(lambda n: {"drep_epoch_stats": snap, "governance_params": params}[n], t, [5])
    d._written = True
    return d


def test_joint_attack_vector_equals_all_pairs(spark):
    rnd = random.Random(9)
    for _ in range(4):
        dreps = [rnd.choice([5, 5, 10, rnd.randint(0, 100)]) for _ in range(rnd.randint(1, 12))] + [1]
        pools = [rnd.choice([7, 7, rnd.randint(1, 100)]) for _ in range(rnd.randint(1, 9))]
        dvt, pvt = rnd.choice([0.0, 0.5, 0.67, 1.0]), rnd.choice([0.51, 0.9])
        a, b = sorted(dreps, reverse=True), sorted(pools, reverse=True)
        pairs = [(i + j, i, j) for i in range(1, len(a) + 1) for j in range(1, len(b) + 1)
                 if float(sum(a[:i])) >= dvt * float(sum(a)) and float(sum(b[:j])) >= pvt * float(sum(b))]
        got = K.p4_9_joint_attack_vector(_bodies(spark, dreps, pools, dvt, pvt)).collect()
        assert len(got) == len(K.JOINT_MOTIONS)
        assert {(r.min_actors, r.min_dreps, r.min_pools) for r in got} == {min(pairs)}
        assert {(r.drep_stake, r.pool_stake) for r in got} == {(sum(a), sum(b))}


def test_joint_attack_vector_without_one_body(spark):
    r = K.p4_9_joint_attack_vector(_bodies(spark, [3], [], 0.5, 0.5)).first()
    assert (r.min_dreps, r.min_pools, r.min_actors, r.pool_threshold) == (1, None, None, None)


def test_yearly_limits_are_apportioned_by_day(spark):
    day = dt.date
    limits = spark.createDataFrame([(day(2023, 1, 1), day(2024, 7, 1), 366), (day(2024, 7, 1), day(2025, 3, 1), 732),
                                    (day(2025, 3, 2), None, 1000), (day(2030, 1, 1), day(2030, 1, 1), 5)],
                                   "valid_from date, valid_to date, annual_limit long")
    got = {r.year: r.net_change_limit for r in K.yearly_limits(limits, F.lit(2027)).collect()}
    # 2024: 182 days at 366 and 184 at 732 of 366 days; 2025 lacks one day; 2026 and 2027 under the open one
    assert got == {2023: 366, 2024: (182 * 366 + 184 * 732) // 366, 2025: None, 2026: 1000, 2027: 1000}


def test_rejected_rows_name_field_and_reason(spark):
    good, empty = '{"cc_yes": 12.6, "drep_total_no_stake": 1.23E10, "cc_no": null}', ""
    stats = ['{"cc_yes": 1, broken', '{"cc_yes": "n/a", "cc_approval_ratio": "x"}', good, None, empty, '{"cc_no": 99999999999}']
    t = tables(spark, gov_action_proposal_status=[dict(gov_action_tx_hash=f"g{i}", gov_action_index=0, epoch=5, status="ACTIVE",
                                                       voting_stats=s) for i, s in enumerate(stats)],
               epoch_param=[dict(epoch=5, params='{"drep_activity": "many"}')],
               pool_registration=[dict(pool_id="p", pool_owners="no list", slot=1, cert_index=0), dict(pool_id="q", pool_owners="[]", slot=1)])
    got = {(r.source_table, r.field, r.row_key, r.reason) for r in D.rejected_rows(t).collect()}
    s = "gov_action_proposal_status"
    assert got == {(s, None, "g0/0/5", "malformed json"), (s, "cc_yes", "g1/0/5", "not a number"),
                   (s, "cc_approval_ratio", "g1/0/5", "not a number"), (s, None, "g4/0/5", "malformed json"),
                   (s, "cc_no", "g5/0/5", "not a number"), ("epoch_param", "drep_activity", "5", "not a number"),
                   ("pool_registration", None, "p/1/0", "not a list")}
    parsed = {r.gov_action_tx_hash: (r.cc_yes, r.drep_total_no_stake) for r in D.voting_stats_table(t).collect()}
    assert parsed["g2"] == (13, 12_300_000_000) and parsed["g1"] == (None, None)
