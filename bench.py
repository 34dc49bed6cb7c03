"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (full execution, no
driver collect). One warm-up pass over all queries, then the median of
$BENCH_REPS timed runs per query. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "ds1_drep_epoch_stats", "ds2_pool_epoch_stats", "ds3_gov_action_votes", "ds4_gov_action_lifecycle",
    "ds5_epoch_summary", "ds6_delegation_events", "ds7_cc_vote_details", "ds8_governance_params",
    "k1_1_voting_turnout", "k1_2_active_stake_participation", "k1_3_delegation_rate",
    "k1_5_delegation_churn", "k1_8_inactive_delegated_ada",
    "p2_1_drep_stake_gini", "p2_2_drep_activity_rate", "p4_9_min_attack_vector",
]


# the widest plans, timed beside the headline (not in its sum)
WIDE = ["p1_7_post_vote_delegation_outflow", "p2_4_drep_time_to_vote", "p2_9_drep_cc_latency",
        "p3_1_spo_turnout", "p3_5_stake_concentration", "p4_5_time_to_enactment", "p4_9_joint_attack_vector"]


def extras(spark, sf_dir: str) -> dict:
    """
    incremental run, KPI views from persisted datasets, and DS1 as one job vs
    the per-epoch loop of the original pipeline (for comparison only)."""
    import uuid

    from pyspark.sql import functions as F

    from ballotlens.plans import datasets as D
    from ballotlens.plans.job import extract_all
    from ballotlens.plans.kpis import KPI_VIEWS
    from ballotlens.registry import ALL_TIME_EXPORTS, PER_EPOCH_EXPORTS, export
    from ballotlens.session import scratch_dir
    from ballotlens.sources.catalog import register_outputs
    from ballotlens.sources.tables import Tables

    t = Tables.from_fixtures(spark, sf_dir)
    epochs = D.plan_epochs(t)
    out = f"{scratch_dir(spark)}/bench-{uuid.uuid4().hex[:8]}"
    # real exports: folders by epoch; the newest epoch arrives after the first run
    late = lambda name: F.col("epoch") >= epochs[-1]
    export(t, f"{out}-src", ALL_TIME_EXPORTS)
    export(t, f"{out}-src", PER_EPOCH_EXPORTS, lambda name: ~late(name))
    extract_all(spark, Tables.from_catalog(spark, f"{out}-src"), f"{out}-inc", full=True)
    export(t, f"{out}-src", PER_EPOCH_EXPORTS, late)
    t0 = time.perf_counter()
    extract_all(spark, Tables.from_catalog(spark, f"{out}-src"), out, full=True)
    full = time.perf_counter() - t0
    t0 = time.perf_counter()
    extract_all(spark, Tables.from_catalog(spark, f"{out}-src"), f"{out}-inc")           # one new epoch arrives
    inc = time.perf_counter() - t0
    t0 = time.perf_counter()
    extract_all(spark, Tables.from_catalog(spark, f"{out}-src"), f"{out}-inc")           # nothing new
    idle = time.perf_counter() - t0
    register_outputs(spark, out)
    t0 = time.perf_counter()
    for _, build in KPI_VIEWS:
        build(lambda n: spark.table(n)).write.format("noop").mode("overwrite").save()
    kpis = time.perf_counter() - t0
    t0 = time.perf_counter()
    D.drep_epoch_stats(t, epochs).write.format("noop").mode("overwrite").save()
    one_job = time.perf_counter() - t0
    t0 = time.perf_counter()
    for e in epochs:
        D.drep_epoch_stats(t, [e]).write.format("noop").mode("overwrite").save()
    loop = time.perf_counter() - t0
    return {"extract_full_sec": round(full, 3), "extract_one_new_epoch_sec": round(inc, 3),
            "extract_nothing_new_sec": round(idle, 3),
            "kpi_views_from_persisted_sec": round(kpis, 3),
            "ds1_single_job_sec": round(one_job, 3), "ds1_per_epoch_loop_sec": round(loop, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    which = os.environ.get("BENCH_QUERIES")
    names = which.split(",") if which else HEADLINE + WIDE
    summed = set(names) if which else set(HEADLINE)

    from ballotlens.registry import queries
    from ballotlens.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:          # warm-up: JIT, file listing, metadata caches
        run(name)
    timings = {name: round(statistics.median(run(name) for _ in range(reps)), 3) for name in names}
    extra = extras(spark, sf_dir) if os.environ.get("BENCH_EXTRA", "1") == "1" else {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of median seconds over headline queries (datasets DS1-8, K1.x, P2.1, P2.2, P4.9)",
        "value": round(sum(v for k, v in timings.items() if k in summed), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": cpus,
        "reps": reps,
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
