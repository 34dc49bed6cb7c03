"""SNK6: the extraction job. One Spark job per dataset over all pending
epochs (never a loop per epoch), incremental by default.

Per dataset:

* wanted epochs = :func:`plan_epochs` (settled epochs from the governance
  start, plus the newest epoch when it is not settled);
* pending = wanted epochs never computed, epochs written while unsettled (marked), the
  current unsettled epoch, and epochs that follow from source files that changed
  (:mod:`ballotlens.plans.dependencies`); ``full`` = all wanted;
* the dataset is computed for the pending epochs and published as a new snapshot
  that keeps the folders of all other epochs.

``gov_action_lifecycle`` is maintained by key instead (SNK5). Its partitions are
resolution epochs and cannot tell which epochs were processed, so a run derives
the *affected* actions: those with proposal or status rows in changed epochs, and
stored ones that are open or were proposed or resolved in a changed epoch. Only these are
computed again, and only epochs that hold one of them are rewritten. ``epoch_summary``
also refetches the proposal epochs of withdrawals enacted in pending epochs, so an
incremental run counts them where a full rebuild does.

Datasets do not read each other, so several are computed at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlens import constants as C
from ballotlens.plans import datasets as D
from ballotlens.plans.dependencies import changed_epochs, fingerprints_for, pending_by_change
from ballotlens.plans.epochs import plan_run
from ballotlens.session import scratch_dir
from ballotlens.sources import sinks, snapshots
from ballotlens.sources.tables import Tables

# dataset -> sort keys inside each epoch partition
SORT_KEYS = {
    "drep_epoch_stats": ["drep_hash"],
    "pool_epoch_stats": ["pool_id"],
    "gov_action_votes": ["gov_action_tx_hash", "gov_action_index", "voter_hash", "vote_slot"],
    "gov_action_lifecycle": ["gov_action_tx_hash", "gov_action_index"],
    "epoch_summary": [],
    "delegation_events": ["slot"],
    "cc_vote_details": ["gov_action_tx_hash", "gov_action_index", "voter_hash"],
    "governance_params": [],
}
LIFECYCLE_KEY = ["gov_action_tx_hash", "gov_action_index"]
LIFECYCLE_SOURCES = ("gov_action_proposal", "gov_action_proposal_status")
WORKERS = 4             # datasets computed at once


def _with_epoch(name: str, df: DataFrame) -> DataFrame:
    # gov_action_votes carries vote_epoch only; partition on a copy of it
    if name == "gov_action_votes":
        return df.withColumn("epoch", F.col("vote_epoch"))
    return df


def _withdrawal_epochs(t: Tables, pending: list[int]) -> list[int]:
    """Proposal epochs of treasury withdrawals enacted in ``pending`` epochs
    (bounded by the number of epochs)."""
    enacted = D.in_epochs(t.gov_action_proposal_status.filter(F.col("status") == C.STATUS_ENACTED), pending)
    props = (t.gov_action_proposal.filter(F.col("type") == C.TREASURY_WITHDRAWALS_ACTION)
             .join(enacted.select(F.col("gov_action_tx_hash").alias("tx_hash"),
                                  F.col("gov_action_index").alias("idx")), ["tx_hash", "idx"], "left_semi"))
    return sorted(int(r.epoch) for r in props.select("epoch").distinct().collect())


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_open() -> Column:
    return F.col("status").isNull() | ~F.col("status").isin(*C.TERMINAL_STATUSES)


def _source_keys(t: Tables, epochs: Sequence[int]) -> DataFrame:
    """(key, epoch_proposed) of actions with proposal or status rows in ``epochs``;
    epoch_proposed is NULL where only a status row tells."""
    proposed = D.in_epochs(t.gov_action_proposal, epochs).select(
        F.col("tx_hash").alias(LIFECYCLE_KEY[0]), F.col("idx").cast("int").alias(LIFECYCLE_KEY[1]), F.col("epoch").cast("int").alias("since"))
    judged = D.in_epochs(t.gov_action_proposal_status, epochs).select(
        LIFECYCLE_KEY[0], F.col(LIFECYCLE_KEY[1]).cast("int").alias(LIFECYCLE_KEY[1]), F.lit(None).cast("int").alias("since"))
    return proposed.unionByName(judged)


def affected_actions(t: Tables, stored: DataFrame, changed: Sequence[int]) -> DataFrame:
    """One row (key, since) per action that may differ from its ``stored`` row after
    the source epochs ``changed``: those with rows there now, and stored ones
    that are open or were proposed or resolved there (their source rows may be gone).
    ``since``: the proposal epoch, NULL if no stored or changed row tells it."""
    touched = F.col("epoch_proposed").isin(list(changed)) | F.col("epoch_resolved").isin(list(changed))
    every = stored.select(*LIFECYCLE_KEY, F.col("epoch_proposed").alias("since"),
                          (F.coalesce(touched, F.lit(False)) | _is_open()).alias("hit"))
    sources = _source_keys(t, changed).withColumn("hit", F.lit(True))
    return (every.unionByName(sources).groupBy(*LIFECYCLE_KEY)
            .agg(F.max("since").alias("since"), F.bool_or("hit").alias("hit")).filter("hit").drop("hit"))


def with_proposals(t: Tables, actions: DataFrame) -> DataFrame:
    """``actions`` with all ``since`` known: those that only a status row names are
    looked up among the keys of all proposals; keys of no proposal go."""
    key = [F.col("tx_hash").alias(LIFECYCLE_KEY[0]), F.col("idx").cast("int").alias(LIFECYCLE_KEY[1])]
    nameless = actions.filter("since is null").select(*LIFECYCLE_KEY)
    found = (t.gov_action_proposal.select(*key, F.col("epoch").cast("int").alias("since")).join(nameless, LIFECYCLE_KEY, "left_semi")
             .groupBy(*LIFECYCLE_KEY).agg(F.max("since").alias("since")))
    return actions.filter("since is not null").unionByName(found)


def lifecycle_of(t: Tables, actions: DataFrame, targets: Sequence[int]) -> DataFrame:
    """DS4 rows of ``actions`` (a stored frame, every ``since`` known) only.
    Proposals are read from their epochs, statuses from the first of these on: an
    action has no status before it is proposed."""
    since = sorted(r.since for r in actions.select("since").distinct().collect())           # bounded by epochs
    proposals = D.in_epochs(t.gov_action_proposal, since)
    statuses = t.gov_action_proposal_status.filter(F.col("epoch") >= (since[0] if since else 0))
    keys = actions.select(*LIFECYCLE_KEY)
    of_proposal = [F.col(LIFECYCLE_KEY[0]).alias("tx_hash"), F.col(LIFECYCLE_KEY[1]).alias("idx")]
    part = t.override(gov_action_proposal=proposals.join(keys.select(*of_proposal), ["tx_hash", "idx"], "left_semi"),
                      gov_action_proposal_status=statuses.join(keys, LIFECYCLE_KEY, "left_semi"))
    return D.gov_action_lifecycle(part, list(targets))


def _maintain_lifecycle(spark: SparkSession, t: Tables, path: str, epochs: Sequence[int], targets: Sequence[int],
                        full: bool, record: bool) -> None:
    """SNK5. ``epochs``: source epochs that may have changed beside those that
    the fingerprints tell."""
    sort, prints = SORT_KEYS["gov_action_lifecycle"], fingerprints_for(t, "gov_action_lifecycle")
    base = None if full else snapshots.current(spark, path)
    state = {"targets": sorted(targets), **({"fingerprints": prints} if prints is not None and record else {})}
    if base is None:
        sinks.write_epochs(D.gov_action_lifecycle(t, list(targets)), path, sort, full=True, state=state)
        return
    before = base["state"]
    changed = set(targets) - set(before.get("targets", []))
    known = prints is not None and "fingerprints" in before and set(before.get("targets", [])) <= set(targets)
    if known:
        moved = set().union(*(changed_epochs(before["fingerprints"].get(n, {}), prints[n]) for n in LIFECYCLE_SOURCES))
        known = all(e.lstrip("-").isdigit() for e in moved)
        changed |= {int(e) for e in moved if e.lstrip("-").isdigit()} | set(epochs)
        if known and not changed:
            return                              # same sources, same targets: same rows
    stored = snapshots.read(spark, path, base)
    if known:
        actions = _kept(affected_actions(t, stored, sorted(changed)), "affected-actions")
        gone = actions.select(*LIFECYCLE_KEY)
        actions = _kept(with_proposals(t, actions), "affected-proposals")
        new = _kept(lifecycle_of(t, actions, targets), "affected-lifecycle")
    else:                                   # frames or flat files: any action may have changed
        new = _kept(D.gov_action_lifecycle(t, list(targets)), "all-lifecycle")
        gone = stored.filter(_is_open()).select(*LIFECYCLE_KEY)
    sinks.upsert_by_key(spark, new, path, LIFECYCLE_KEY, sort, delete_keys=gone, state=state)


def maintain(spark: SparkSession, t: Tables, out_dir: str, name: str, epochs: Sequence[int],
             targets: Sequence[int], full: bool = False, unsettled: Sequence[int] = (), record: bool = True) -> list[int]:
    """Bring one stored dataset up to date for ``epochs``; the one place that
    writes datasets, whatever decides on the epochs (a run, a stream). Returns
    the epochs computed; ``unsettled`` ones are marked to be computed again.
    ``record``: ``epochs`` are all that the source files ask for, so their
    fingerprints are stored (a stream that sees some epochs must not).

    ``gov_action_lifecycle`` is maintained by affected actions for all ``targets``.
    ``epoch_summary`` is also recomputed for the proposal epochs of
    withdrawals enacted in ``epochs``, and always counts withdrawals enacted in
    any target epoch, as a full rebuild does."""
    path = f"{out_dir}/{name}"
    epochs = sorted(set(int(e) for e in epochs))
    if name == "gov_action_lifecycle":
        _maintain_lifecycle(spark, t, path, [] if record else epochs, targets, full, record)
        return list(targets)
    if name == "epoch_summary":
        if epochs and not full:
            epochs = sorted(set(epochs) | set(_withdrawal_epochs(t, epochs)))
        epochs = [e for e in epochs if e in set(targets)]
    if not epochs:
        return []
    if name == "epoch_summary":
        df = D.epoch_summary(t, epochs, status_epochs=list(targets))
    else:
        df = _with_epoch(name, D.DATASETS[name](t, epochs))
    prints = fingerprints_for(t, name) if record else None
    sinks.write_epochs(df, path, SORT_KEYS[name], full=full, computed=epochs, unsettled=unsettled,
                       state=None if prints is None else {"fingerprints": prints})
    return epochs


def pending_epochs(spark: SparkSession, t: Tables, path: str, name: str, epochs: Sequence[int], unsettled: Sequence[int],
                   all_time: bool = False) -> list[int]:
    """SNK2: the epochs of a run that dataset ``name`` lacks or has to compute again."""
    have = set(sinks.processed_epochs(spark, path)) - set(sinks.unsettled_marks(spark, path))
    pending = {e for e in epochs if e not in have or e in unsettled}
    prints, manifest = fingerprints_for(t, name), snapshots.current(spark, path)
    if prints is not None and manifest is not None:
        pending |= pending_by_change(name, manifest["state"].get("fingerprints", {}), prints, epochs, all_time)
    return sorted(pending)


def extract_all(spark: SparkSession, tables: Tables, out_dir: str, only: Sequence[str] | None = None,
                full: bool = False, settled_through: int | None = None, all_time: bool = False,
                workers: int = WORKERS) -> dict[str, list[int]]:
    """Build or update every dataset under ``out_dir``. Returns, per dataset,
    the epochs it (re)computed. ``all_time``: changed all-time facts (first
    registrations, owners, committee) also reach settled epochs."""
    names = list(D.DATASETS)
    if only:
        unknown = sorted(set(only) - set(names))
        if unknown:
            raise ValueError(f"unknown dataset(s): {', '.join(unknown)}")
        names = [n for n in names if n in only]
    tables.fingerprints("adapot")               # listed before any table is read
    epochs, unsettled = plan_run(tables, settled_through)

    def run(name: str) -> list[int]:
        path = f"{out_dir}/{name}"
        pending = sorted(epochs) if full else pending_epochs(spark, tables, path, name, epochs, unsettled, all_time)
        return maintain(spark, tables, out_dir, name, pending, epochs, full, unsettled)

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return dict(zip(names, pool.map(run, names)))


def read_dataset(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """A written dataset with its original columns (and column order)."""
    df = snapshots.read(spark, f"{out_dir}/{name}")
    if df is None:
        df = spark.read.parquet(f"{out_dir}/{name}")
    if name == "gov_action_votes":
        df = df.drop("epoch")
    return df
