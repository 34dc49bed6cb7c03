"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Keys follow the inventory IDs (ds*, k*, doc*, p*, meta*). Every callable
derives the governance tables from the driver tables under ``sf_dir`` and runs
the full plan over all rows and all epochs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlens.plans import datasets as D
from ballotlens.plans import epochs as E
from ballotlens.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(fn: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables.from_fixtures(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _meta2(t: Tables) -> DataFrame:
    return t.spark.range(1).select(E.max_epoch(t).alias("max_epoch"))


def _meta3(t: Tables) -> DataFrame:
    return t.drep_dist.agg(F.coalesce(F.min("epoch"), F.lit(0)).cast("int").alias("start_epoch"))


QUERIES: dict[str, Query] = {
    "meta1_settled_epochs": _on_tables(E.settled_epochs),
    "meta2_max_epoch": _on_tables(_meta2),
    "meta3_governance_start": _on_tables(_meta3),
    "meta4_target_epochs": _on_tables(E.target_epochs),
    "ds1_drep_epoch_stats": _on_tables(D.drep_epoch_stats),
    "ds2_pool_epoch_stats": _on_tables(D.pool_epoch_stats),
    "ds3_gov_action_votes": _on_tables(D.gov_action_votes),
    "ds4_gov_action_lifecycle": _on_tables(D.gov_action_lifecycle),
    "ds5_epoch_summary": _on_tables(D.epoch_summary),
    "ds6_delegation_events": _on_tables(D.delegation_events),
    "ds7_cc_vote_details": _on_tables(D.cc_vote_details),
    "ds8_governance_params": _on_tables(D.governance_params),
    "ds1a_asof_status": _on_tables(
        lambda t: D.drep_asof_status(t).select("drep_hash", F.col("epoch").cast("int").alias("epoch"),
                                               "drep_id", "status")),
    "ds2e_default_stance": _on_tables(D.pool_default_stance),
    "ds4c_voting_stats": _on_tables(D.voting_stats_table),
    "ds5g_cc_range_join": _on_tables(lambda t: D.cc_members_per_epoch(t, E.target_epochs(t))),
    "ds4d_json_rejects": _on_tables(D.json_rejects),
}


def _fresh_dir(spark: SparkSession, label: str) -> str:
    import uuid
    from ballotlens.session import scratch_dir
    return f"{scratch_dir(spark)}/ballotlens-{label}-{uuid.uuid4().hex[:10]}"


def _snk1_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1: DS1 written as epoch partitions, read back."""
    from ballotlens.plans.job import extract_all, read_dataset
    out = _fresh_dir(spark, "snk1")
    extract_all(spark, Tables.from_fixtures(spark, sf_dir), out, only=["drep_epoch_stats"])
    return read_dataset(spark, out, "drep_epoch_stats")


def _snk3_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2-4: DS5 built in two incremental runs (epochs <= 510, then the
    rest), read back; must equal a full rebuild."""
    from ballotlens.plans.job import extract_all, read_dataset
    out, t = _fresh_dir(spark, "snk3"), Tables.from_fixtures(spark, sf_dir)
    extract_all(spark, t, out, only=["epoch_summary"], settled_through=510)
    extract_all(spark, t, out, only=["epoch_summary"])
    return read_dataset(spark, out, "epoch_summary")


def _snk5_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: lifecycle stored from a source where every action is still
    ACTIVE, then upserted from the full source; read back."""
    from ballotlens.plans.job import extract_all, read_dataset
    out, t = _fresh_dir(spark, "snk5"), Tables.from_fixtures(spark, sf_dir)
    early = t.override(gov_action_proposal_status=t.gov_action_proposal_status
                       .filter(F.col("status") == "ACTIVE"))
    extract_all(spark, early, out, only=["gov_action_lifecycle"])
    extract_all(spark, t, out, only=["gov_action_lifecycle"])
    return read_dataset(spark, out, "gov_action_lifecycle")


def _src_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/SRC2: the tables DS1 reads, exported as folders (hive-partitioned
    by epoch, and one flat), registered from the folder listing and read back
    through the catalog; DS1 then runs on the exports (epoch IN-list ->
    partition pruning)."""
    from ballotlens.sources.catalog import register_source_tables
    out, t = _fresh_dir(spark, "src"), Tables.from_fixtures(spark, sf_dir)
    export(t, out, ("drep_dist", "drep", "voting_procedure", "adapot"))
    t.drep_registration.write.parquet(f"{out}/drep_registration")          # flat folder
    names = register_source_tables(spark, out, prefix="src_")
    assert {"src_drep_dist", "src_drep", "src_voting_procedure", "src_adapot",
            "src_drep_registration"} <= set(names), names
    return D.drep_epoch_stats(Tables.from_catalog(spark, out))


def _stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming: delegation_vote exported as epoch folders in two file drops
    (epoch 515 split across both); after each drop the file stream
    (availableNow) recomputes the touched epochs of delegation_events. Reads
    back the maintained dataset: every epoch of the source."""
    from ballotlens.plans.job import read_dataset
    from ballotlens.sources.catalog import source_schema
    from ballotlens.streaming import start_epoch_stream
    base, t = _fresh_dir(spark, "stream"), Tables.from_fixtures(spark, sf_dir)
    src, out, ckpt = f"{base}/src", f"{base}/out", f"{base}/ckpt"
    dv = t.delegation_vote.select(*[c.split()[0] for c in source_schema("delegation_vote").split(", ")])
    first = (F.col("epoch") < 515) | ((F.col("epoch") == 515) & (F.col("tx_index") % 2 == 0))
    for part in (dv.filter(first), dv.filter(~first)):
        append_epochs(part, f"{src}/delegation_vote")
        start_epoch_stream(spark, src, "delegation_vote", out, ["delegation_events"], checkpoint=ckpt,
                           tables=Tables.from_catalog(spark, src)).awaitTermination()
    return read_dataset(spark, out, "delegation_events")


def _refreshed(name: str) -> Query:
    """A stored dataset after its epochs were refreshed one by one, as a
    stream does that sees one epoch at a time: equal to a full rebuild."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ballotlens.plans.job import extract_all, read_dataset
        from ballotlens.streaming.incremental import refresh_epochs
        out, t = _fresh_dir(spark, "refresh"), Tables.from_fixtures(spark, sf_dir)
        extract_all(spark, t, out, only=[name], settled_through=510)
        epochs, _ = E.plan_run(t)
        middle = len(epochs) // 2
        refresh_epochs(spark, t, out, [name], epochs[middle:])
        refresh_epochs(spark, t, out, [name], epochs[:middle])
        refresh_epochs(spark, t, out, [name], epochs[-1:])
        return read_dataset(spark, out, name)
    return run


def _snk6_all(full: bool) -> Query:
    """SNK6: every dataset built by the job, twice (incremental, or full);
    rows and computed epochs per dataset."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from functools import reduce
        from ballotlens.plans.job import extract_all, read_dataset
        out, t = _fresh_dir(spark, "snk6"), Tables.from_fixtures(spark, sf_dir)
        extract_all(spark, t, out, settled_through=510)
        extract_all(spark, t, out, full=full)
        counts = [read_dataset(spark, out, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows")
                  for n in D.DATASETS]
        return reduce(lambda a, b: a.unionByName(b), counts)
    return run


QUERIES.update({
    "stream_epoch_summary_refreshed": _refreshed("epoch_summary"),
    "stream_lifecycle_refreshed": _refreshed("gov_action_lifecycle"),
    "snk6_all_incremental": _snk6_all(False),
    "snk6_all_full": _snk6_all(True),
    "stream_delegation_events": _stream_refresh,
    "src1_exports_catalog": _src_exports,
    "snk1_drep_epoch_stats_written": _snk1_written,
    "snk3_epoch_summary_incremental": _snk3_incremental,
    "snk5_lifecycle_upsert": _snk5_upsert,
})


# ------------------------------------------------ runs over exported folders

PER_EPOCH_EXPORTS = ("drep_dist", "voting_procedure", "adapot", "block", "transaction", "epoch_stake", "epoch_param",
                     "gov_action_proposal", "gov_action_proposal_status", "drep", "pool")
ALL_TIME_EXPORTS = ("drep_registration", "pool_registration", "delegation_vote", "committee", "committee_member",
                    "committee_registration")


def append_epochs(rows: DataFrame, path: str) -> None:
    """Add ``rows`` to the epoch folders under ``path``. An epoch is shared out by
    its size: no task sorts or writes a large one, or many, alone."""
    rows.hint("rebalance", "epoch").write.mode("append").partitionBy("epoch").parquet(path)


def export(tables: Tables, path: str, names, where=None) -> None:
    """Write source tables as epoch-partitioned folders; ``where(name)``: the rows."""
    from concurrent.futures import ThreadPoolExecutor

    def one(name: str) -> None:
        rows = tables[name] if where is None else tables[name].filter(where(name))
        append_epochs(rows, f"{path}/{name}")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, names))


def row_checksum(df: DataFrame) -> list:
    """(rows, checksum) aggregates: a sum of hashes of all columns' texts, equal
    for equal rows in any order; doubles count to six decimals."""
    text = [F.coalesce(F.round(F.col(n) * 1000000).cast("long").cast("string") if t == "double" else F.col(n).cast("string"), F.lit("~"))
            for n, t in sorted(df.dtypes)]
    head = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10).cast("long")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(head), F.lit(0)).alias("checksum")]


def _change_driven(names) -> Query:
    """SNK2/SNK5/SNK6 over exports: a first delivery without the newest epoch and
    with half the votes of epoch 515; then the rest arrives and a second run
    computes what follows from the changed files. Rows and checksum per dataset."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ballotlens.plans.dependencies import DEPENDS
        from ballotlens.plans.job import extract_all, read_dataset
        from ballotlens.sources.sinks import union_all
        base, t = _fresh_dir(spark, "changes"), Tables.from_fixtures(spark, sf_dir)
        newest, needed = E.plan_run(t)[0][-1], {"adapot", "drep_dist"}.union(*(DEPENDS[n] for n in names))
        half = lambda n: (F.col("epoch") == 515) & (F.col("idx") % 2 == 0) if n == "voting_procedure" else F.lit(False)
        later = lambda n: (F.col("epoch") >= newest) | half(n)
        # the fixtures hold votes on proposals of later epochs: where votes are joined, all proposals come first
        whole = [*ALL_TIME_EXPORTS, *(["gov_action_proposal"] if "gov_action_votes" in names else [])]
        per_epoch = [n for n in PER_EPOCH_EXPORTS if n in needed and n not in whole]
        export(t, f"{base}/src", [n for n in whole if n in needed])
        export(t, f"{base}/src", per_epoch, lambda n: ~later(n))
        extract_all(spark, Tables.from_catalog(spark, f"{base}/src"), f"{base}/out", only=names)
        export(t, f"{base}/src", per_epoch, later)
        extract_all(spark, Tables.from_catalog(spark, f"{base}/src"), f"{base}/out", only=names)
        sums = []
        for n in names:
            df = read_dataset(spark, f"{base}/out", n)
            sums.append(df.agg(*row_checksum(df)).select(F.lit(n).alias("dataset"), "rows", "checksum"))
        return union_all(sums)
    return run


def _reopened(datasets, view: str | None) -> Query:
    """SRC3-SRC6: datasets written and a catalog published; a new session opens
    it. Returns the rows of ``view``, or the views found and their row counts."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ballotlens.plans.job import extract_all
        from ballotlens.session import ensure_session
        from ballotlens.sources.catalog import open_catalog, save_catalog
        from ballotlens.sources.sinks import union_all
        out = _fresh_dir(spark, "catalog")
        extract_all(spark, Tables.from_fixtures(spark, sf_dir), out, only=datasets)
        save_catalog(spark, out)
        other = ensure_session(spark.newSession())
        names = open_catalog(other, out)
        if view is None:
            return union_all([other.table(n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("view_name"), "rows")
                              for n in names])
        return other.table(view).drop("epoch") if view == "gov_action_votes" else other.table(view)
    return run


def _ordered(fn, order, epoch: str, first_of: str) -> Query:
    """DS3c/DS6b: a dataset in files that follow each other in its order. Per
    epoch, in file order: rows, first and last value, rows out of place."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ballotlens.sources.sinks import order_faults, read_ordered, write_ordered
        path = _fresh_dir(spark, "ordered")
        write_ordered(fn(Tables.from_fixtures(spark, sf_dir)), path, order)
        place = F.struct("__file", "__row")
        edges = read_ordered(spark, path).groupBy(epoch).agg(
            F.min_by(first_of, place).alias("first_value"), F.max_by(first_of, place).alias("last_value"))
        return order_faults(spark, path, by=[epoch]).join(edges, epoch).withColumnRenamed(epoch, "epoch")
    return run


# values as an export may hold them, written into good voting stats: SQL text for both engines
MESSY_STATS = """case epoch % 5
  when 0 then replace(voting_stats, '"cc_yes":', '"cc_yes":"n/a","a":')
  when 1 then replace(voting_stats, '"drep_total_no_stake":', '"drep_total_no_stake":1.23E10,"b":')
  when 2 then replace(voting_stats, '"cc_no":', '"cc_no":12.6,"c":')
  when 3 then replace(voting_stats, '"cc_abstain":', '"cc_abstain":"","d":')
  else replace(voting_stats, '"spo_approval_ratio":', '"spo_approval_ratio":"0.5x","e":') end"""


def _messy(t: Tables) -> Tables:
    s = t.gov_action_proposal_status
    return t.override(gov_action_proposal_status=s.withColumn("voting_stats", F.expr(MESSY_STATS)))


# limits in force for 150 days each, with one missing: SQL text for both engines
DATED_LIMITS = """select cast(date '1994-03-01' + cast(n_nationkey * 150 as int) as date) as valid_from,
  case when n_nationkey < 24 then cast(date '1994-03-01' + cast(n_nationkey * 150 + 150 as int) as date) end as valid_to,
  cast(300000000000000 + n_nationkey * 10000000000000 as bigint) as annual_limit
from {nation} where n_nationkey <> 10"""


def _dated_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ballotlens.plans.kpis import Datasets, p4_6_treasury_vs_dated_ncl
    limits = spark.sql(DATED_LIMITS.format(nation="{nation}"), nation=spark.read.parquet(f"{sf_dir}/nation.parquet"))
    return p4_6_treasury_vs_dated_ncl(Datasets.from_tables(Tables.from_fixtures(spark, sf_dir)), limits)


def _null_order(t: Tables) -> DataFrame:
    """D5: previous proposal of the same type in an order with NULLs, which come last."""
    from ballotlens.operators.ordered import lag_within
    p = t.gov_action_proposal.select("type", F.nullif(F.col("slot") % 7, F.lit(0)).alias("place"), "tx_hash", "idx")
    return lag_within(p, "type", ["place", "tx_hash", "idx"], ["tx_hash"], span=3)


QUERIES.update({
    "d3_numeric_text": _on_tables(lambda t: D.voting_stats_table(_messy(t))),
    "d4_rejected_rows": _on_tables(lambda t: D.rejected_rows(_messy(t))),
    "d5_nulls_last": _on_tables(_null_order),
    "ds3c_ordered_votes": _ordered(lambda t: D.gov_action_votes(t), ["vote_epoch", "gov_action_tx_hash", "gov_action_index",
                                                                     "voter_hash", "vote_slot"], "vote_epoch", "gov_action_tx_hash"),
    "ds6b_ordered_events": _ordered(lambda t: D.delegation_events(t), ["epoch", "slot"], "epoch", "slot"),
    "p4_6_treasury_vs_dated_ncl": _dated_limits,
    "src3_partitioned_view": _reopened(["gov_action_votes"], "gov_action_votes"),
    "src4_file_view": _reopened(["cc_vote_details"], "cc_vote_details"),
    "src5_discovered_views": _reopened(["delegation_events", "governance_params"], None),
    "src6_kpi_view": _reopened(["gov_action_lifecycle", "epoch_summary"], "kpi_1_1_voting_turnout"),
    "snk5_affected_actions": _change_driven(["gov_action_lifecycle"]),
    "snk6_change_driven": _change_driven(list(D.DATASETS)),
})


def queries() -> dict[str, Query]:
    from ballotlens.plans.kpis import KPI_QUERIES
    return {**QUERIES, **KPI_QUERIES}
