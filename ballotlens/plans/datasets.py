"""The eight derived datasets (DS1-DS8), each for all requested epochs at once.

Every function takes the source :class:`Tables` and optional epochs (a list,
default = :func:`plan_epochs`, or a frame with column ``epoch``) and returns a
lazy DataFrame. Per-epoch aggregates are computed before joining (no fan-out), and
only frames bounded by the number of epochs are broadcast explicitly; every
other join is left to AQE, which broadcasts from measured sizes and splits
skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotlens import constants as C
from ballotlens.functions import epoch_seconds, json_num, parse_json_strings, ratio, seconds_between
from ballotlens.operators.latest import asof_latest, latest_by
from ballotlens.operators.ranges import count_active_per_epoch
from ballotlens.plans.epochs import epoch_flag, in_epochs, plan_epochs, target_epochs  # noqa: F401
from ballotlens.sources.tables import Tables


def _epochs(t: Tables, epochs):
    """Requested epochs: a list (default: planned once for the run) or a frame."""
    return epochs if epochs is not None else plan_epochs(t)


# ---------------------------------------------------------------- DS1 -----

def drep_reg_info(t: Tables) -> DataFrame:
    """Per DRep: first registration epoch (all time) and whether a registration
    at its highest slot carries an anchor. ``max(struct(slot, has_anchor))``
    yields both the top slot and "any anchor among the rows at that slot" in
    one partial aggregate (no window, no self-join)."""
    reg = t.drep_registration
    top = F.max(F.struct(F.col("slot"), F.col("anchor_url").isNotNull().alias("a")))
    return (reg.groupBy("drep_hash")
               .agg(F.min("epoch").cast("int").alias("registration_epoch"), top.alias("__top"))
               .select("drep_hash", "registration_epoch",
                       F.when(F.col("__top.slot").isNotNull(), F.col("__top.a"))
                        .alias("has_metadata")))


def drep_vote_counts(t: Tables, epochs) -> DataFrame:
    votes = in_epochs(t.voting_procedure.filter(F.col("voter_type").isin(*C.DREP_VOTER_TYPES)), epochs)
    return (votes.groupBy("epoch", "voter_hash")
                 .agg(F.count(F.lit(1)).alias("votes_cast"),
                      F.count("anchor_url").alias("votes_with_rationale"))
                 .withColumnRenamed("voter_hash", "drep_hash"))


def drep_asof_status(t: Tables, epochs=None) -> DataFrame:
    """DS1a: every ``drep_dist`` row with the DRep's latest status as of its epoch."""
    dist = in_epochs(t.drep_dist, _epochs(t, epochs))
    return asof_latest(dist, t.drep, key="drep_hash", epoch="epoch",
                       order=("slot", "tx_index", "cert_index"), value="status")


def drep_epoch_stats(t: Tables, epochs=None) -> DataFrame:
    """DS1: one row per ``drep_dist`` row of the requested epochs.

    One shuffle of the snapshot table: snapshot rows, status events, the
    per-(DRep, epoch) vote counts and the per-DRep registration facts (both
    partially aggregated first) are unioned under one window key, and three
    window specs read them back: a running max over epochs (as-of status),
    a (key, epoch) group (votes) and a (key) group (registration). All three
    are satisfied by the single hash partitioning on the key, so the big
    table is not shuffled again for joins. Snapshot rows with a NULL hash
    match nothing (status NULL, 0 votes, no registration) and go round the
    windows; events with a NULL epoch are never "as of" any epoch.
    """
    epochs = _epochs(t, epochs)
    dist = in_epochs(t.drep_dist, epochs)
    ev_struct = F.struct("slot", "tx_index", "cert_index", F.col("status").alias("__v"))
    ev_type = t.drep.select(ev_struct.alias("e")).schema["e"].dataType

    def side(df, kind, **cols):
        base = {
            "epoch": F.lit(None).cast("int"), "drep_type": F.lit(None).cast("string"),
            "drep_id": F.lit(None).cast("string"), "amount": F.lit(None).cast("long"),
            "active_until": F.lit(None).cast("int"), "expiry": F.lit(None).cast("int"),
            "__ev": F.lit(None).cast(ev_type), "votes_cast": F.lit(None).cast("long"),
            "votes_with_rationale": F.lit(None).cast("long"),
            "registration_epoch": F.lit(None).cast("int"), "has_metadata": F.lit(None).cast("boolean"),
        }
        base.update(cols)
        return df.filter(F.col("drep_hash").isNotNull()).select(
            F.lit(kind).alias("__kind"), F.col("drep_hash").cast("string").alias("drep_hash"),
            *[v.alias(k) for k, v in base.items()])

    snap_cols = ("epoch", "drep_type", "drep_id", "amount", "active_until", "expiry")
    snaps = side(dist, 0, **{c: F.col(c) for c in snap_cols})
    events = side(t.drep.filter(F.col("epoch").isNotNull()), 1, epoch=F.col("epoch").cast("int"), __ev=ev_struct)
    votes = side(drep_vote_counts(t, epochs), 2, epoch=F.col("epoch").cast("int"),
                 votes_cast=F.col("votes_cast"), votes_with_rationale=F.col("votes_with_rationale"))
    regs = side(drep_reg_info(t), 3,
                registration_epoch=F.col("registration_epoch"), has_metadata=F.col("has_metadata"))
    asof = Window.partitionBy("drep_hash").orderBy(F.col("epoch").asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    same_epoch = Window.partitionBy("drep_hash", "epoch")
    same_key = Window.partitionBy("drep_hash")
    rows = (snaps.unionByName(events).unionByName(votes).unionByName(regs)
            .select("*",
                    F.max("__ev").over(asof).alias("__best"),
                    F.max("votes_cast").over(same_epoch).alias("__n"),
                    F.max("votes_with_rationale").over(same_epoch).alias("__r"),
                    F.max("registration_epoch").over(same_key).alias("__re"),
                    F.max(F.col("has_metadata").cast("int")).over(same_key).alias("__hm"))
            .filter(F.col("__kind") == 0))
    snapshot = [F.col("epoch").cast("int").alias("epoch"), F.col("drep_hash").cast("string").alias("drep_hash"),
                "drep_type", "drep_id", F.col("amount").cast("long").alias("delegated_amount"),
                F.col("active_until").cast("int").alias("active_until"), F.col("expiry").cast("int").alias("expiry")]
    found = rows.select(
        *snapshot, F.col("__best.__v").alias("status"),
        F.col("__re").alias("registration_epoch"),
        F.col("__hm").cast("boolean").alias("has_metadata"),
        F.coalesce("__n", F.lit(0)).cast("int").alias("votes_cast"),
        F.coalesce("__r", F.lit(0)).cast("int").alias("votes_with_rationale"))
    keyless = dist.filter(F.col("drep_hash").isNull()).select(
        *snapshot, F.lit(None).cast("string").alias("status"), F.lit(None).cast("int").alias("registration_epoch"),
        F.lit(None).cast("boolean").alias("has_metadata"), F.lit(0).alias("votes_cast"), F.lit(0).alias("votes_with_rationale"))
    return found.unionByName(keyless)


# ---------------------------------------------------------------- DS2 -----

def pool_default_stance(t: Tables) -> DataFrame:
    """DS2b-e: per pool, the default stance of its owners' latest
    ABSTAIN/NO_CONFIDENCE delegation (ABSTAIN wins when both occur)."""
    reg = latest_by(t.pool_registration, ["pool_id"], ["slot", "tx_index", "cert_index"],
                    ["pool_owners"])
    owners = reg.select("pool_id",
                        F.explode(F.from_json("pool_owners", "array<string>")).alias("credential"))
    defaults = latest_by(t.delegation_vote.filter(F.col("drep_type").isin(*C.DEFAULT_DREP_TYPES)),
                         ["credential"], ["slot", "tx_index", "cert_index"], ["drep_type"])
    return (owners.join(defaults, "credential", "inner")
                  .groupBy("pool_id").agg(F.min("drep_type").alias("default_stance")))


def pool_epoch_stats(t: Tables, epochs=None) -> DataFrame:
    """DS2: one row per ``pool`` lifecycle row of the requested epochs."""
    epochs = _epochs(t, epochs)
    votes = in_epochs(t.voting_procedure.filter(F.col("voter_type") == C.SPO_VOTER_TYPE), epochs)
    counts = (votes.groupBy("epoch", F.col("voter_hash").alias("pool_id"))
                   .agg(F.count(F.lit(1)).alias("votes_cast"),
                        F.count_if(F.col("vote") == C.VOTE_YES).alias("votes_yes"),
                        F.count_if(F.col("vote") == C.VOTE_NO).alias("votes_no"),
                        F.count_if(F.col("vote") == C.VOTE_ABSTAIN).alias("votes_abstain")))
    pools = in_epochs(t.pool, epochs)
    out = (pools.join(counts, ["epoch", "pool_id"], "left")
                .join(pool_default_stance(t), "pool_id", "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    return out.select(F.col("epoch").cast("int").alias("epoch"), "pool_id", "status",
                      F.col("amount").alias("stake_amount"),
                      zero("votes_cast"), zero("votes_yes"), zero("votes_no"), zero("votes_abstain"),
                      "default_stance")


# ---------------------------------------------------------------- DS3 -----

def _proposal_side(t: Tables) -> DataFrame:
    p = t.gov_action_proposal
    return p.select(F.col("tx_hash").alias("gov_action_tx_hash"),
                    F.col("idx").alias("gov_action_index"),
                    F.col("type").alias("action_type"),
                    F.col("epoch").cast("int").alias("action_epoch"),
                    F.col("block_time").alias("__action_time"))


def gov_action_votes(t: Tables, epochs=None) -> DataFrame:
    """DS3: votes of the requested epochs joined to their proposal (orphan
    votes dropped)."""
    votes = in_epochs(t.voting_procedure, _epochs(t, epochs))
    joined = votes.join(_proposal_side(t), ["gov_action_tx_hash", "gov_action_index"], "inner")
    return joined.select(
        "gov_action_tx_hash",
        F.col("gov_action_index").cast("int").alias("gov_action_index"),
        "action_type", "action_epoch",
        epoch_seconds("__action_time").alias("action_block_time"),
        "voter_type", "voter_hash", "vote",
        F.col("anchor_url").isNotNull().alias("has_rationale"),
        F.col("epoch").cast("int").alias("vote_epoch"),
        epoch_seconds("block_time").alias("vote_block_time"),
        F.col("slot").alias("vote_slot"),
    )


# ---------------------------------------------------------------- DS4 -----

def voting_stats_columns(stats_col: str = "voting_stats") -> list:
    """DS4c: the 23 flat keys of ``voting_stats``, parsed once, typed."""
    parsed = parse_json_strings(stats_col, {k: None for k, _ in C.VOTING_STATS_FIELDS})
    return [json_num(parsed[k], typ).alias(k) for k, typ in C.VOTING_STATS_FIELDS]


def latest_action_status(t: Tables) -> DataFrame:
    """DS4a/b: each action's latest status row (by epoch; of one epoch that
    with the greatest status and stats text) and, when terminal, the epoch it
    resolved in."""
    latest = latest_by(t.gov_action_proposal_status, ["gov_action_tx_hash", "gov_action_index"],
                       ["epoch", "status", "voting_stats"], ["status", "voting_stats", "epoch"])
    return latest.select(
        "gov_action_tx_hash", "gov_action_index", "status", "voting_stats",
        F.when(F.col("status").isin(*C.TERMINAL_STATUSES), F.col("epoch")).alias("epoch_resolved"))


def voting_stats_table(t: Tables) -> DataFrame:
    """DS4c in isolation: every status row with its parsed voting stats."""
    s = t.gov_action_proposal_status
    return s.select("gov_action_tx_hash", F.col("gov_action_index").cast("int").alias("gov_action_index"),
                    F.col("epoch").cast("int").alias("epoch"), "status", *voting_stats_columns())


def gov_action_lifecycle(t: Tables, epochs=None) -> DataFrame:
    """DS4: one row per proposal proposed in a requested epoch or still open
    (no status, or a non-terminal latest status)."""
    p = epoch_flag(t.gov_action_proposal, _epochs(t, epochs))
    r = latest_action_status(t).withColumnRenamed("gov_action_tx_hash", "tx_hash") \
                               .withColumnRenamed("gov_action_index", "idx")
    joined = p.join(r, ["tx_hash", "idx"], "left")
    open_or_new = (F.col("__in_epochs") | F.col("status").isNull()
                   | ~F.col("status").isin(*C.TERMINAL_STATUSES))
    return joined.filter(open_or_new).select(
        F.col("tx_hash").alias("gov_action_tx_hash"),
        F.col("idx").cast("int").alias("gov_action_index"),
        "type", "deposit", "return_address", "anchor_url",
        F.col("epoch").cast("int").alias("epoch_proposed"),
        epoch_seconds("block_time").alias("block_time_proposed"),
        "status",
        F.col("epoch_resolved").cast("int").alias("epoch_resolved"),
        *voting_stats_columns(),
        F.coalesce("epoch_resolved", "epoch").cast("int").alias("epoch"),
    )


# ---------------------------------------------------------------- DS5 -----

def cc_members_per_epoch(t: Tables, epochs) -> DataFrame:
    """DS5g: committee rows whose term covers each epoch (count of hashes)."""
    return count_active_per_epoch(t.committee_member, epochs, start="start_epoch",
                                  end="expired_epoch", counted="hash", out="cc_member_count")


def epoch_times(t: Tables, epochs) -> DataFrame:
    """DS5h: blocks, first and last block time per epoch."""
    seconds = F.unix_micros(F.col("block_time").cast("timestamp")) / 1e6
    return in_epochs(t.block, epochs).groupBy("epoch").agg(
        F.count(F.lit(1)).cast("int").alias("block_count"),
        F.rint(F.min(seconds)).cast("long").alias("epoch_start_time"),
        F.rint(F.max(seconds)).cast("long").alias("epoch_end_time"))


def epoch_summary(t: Tables, epochs=None, status_epochs=None) -> DataFrame:
    """DS5: one row per settled epoch; eleven per-epoch aggregates joined on
    ``epoch``. Each aggregate is one row per epoch, so broadcasting it is
    bounded by the epoch count whatever the table sizes.

    ``status_epochs`` (default: ``epochs``) are the status epochs in which an
    ENACTED withdrawal counts; an incremental run passes all target epochs so
    a recomputed proposal epoch gets the same count as a full rebuild."""
    epochs = _epochs(t, epochs)
    status_epochs = epochs if status_epochs is None else status_epochs
    base = in_epochs(t.adapot, epochs)
    by_epoch = lambda df: in_epochs(df, epochs).groupBy("epoch")

    blocks = epoch_times(t, epochs)
    txs = by_epoch(t.transaction).agg(F.count(F.lit(1)).cast("long").alias("tx_count"))
    stake = by_epoch(t.epoch_stake).agg(F.sum("amount").cast("long").alias("total_active_stake"))
    dtype = F.col("drep_type")
    dist = by_epoch(t.drep_dist).agg(
        F.sum("amount").cast("long").alias("total_drep_delegated"),
        F.sum(F.when(~dtype.isin(C.DREP_ABSTAIN), F.col("amount"))).cast("long")
         .alias("total_drep_delegated_non_abstain"),
        F.sum(F.when(dtype == C.DREP_NO_CONFIDENCE, F.col("amount"))).cast("long")
         .alias("total_drep_delegated_no_confidence"),
        F.count_distinct(F.when(~dtype.isin(*C.DEFAULT_DREP_TYPES), F.col("drep_hash")))
         .cast("int").alias("active_drep_count"))
    pools = by_epoch(t.pool.filter(F.col("status") != C.POOL_RETIRED)).agg(
        F.count(F.lit(1)).cast("int").alias("active_pool_count"))
    threshold = t.committee.select(
        F.max_by("threshold", F.struct("epoch", "slot"))).scalar()
    cc = cc_members_per_epoch(t, epochs).withColumn("cc_threshold", threshold)
    proposed = by_epoch(t.gov_action_proposal).agg(
        F.count(F.lit(1)).cast("int").alias("gov_actions_proposed"))
    status = F.col("status")
    statuses = by_epoch(t.gov_action_proposal_status).agg(
        F.count_if(status == C.STATUS_RATIFIED).cast("int").alias("gov_actions_ratified"),
        F.count_if(status == C.STATUS_EXPIRED).cast("int").alias("gov_actions_expired"))
    cert = F.col("type")
    regs = by_epoch(t.drep_registration).agg(
        F.count_if(cert == C.REG_DREP_CERT).cast("int").alias("drep_registrations"),
        F.count_if(cert == C.UNREG_DREP_CERT).cast("int").alias("drep_retirements"))
    enacted = in_epochs(t.gov_action_proposal_status.filter(status == C.STATUS_ENACTED), status_epochs)
    withdrawals = (t.gov_action_proposal.filter(F.col("type") == C.TREASURY_WITHDRAWALS_ACTION)
                   .join(enacted.select(F.col("gov_action_tx_hash").alias("tx_hash"),
                                        F.col("gov_action_index").alias("idx")),
                         ["tx_hash", "idx"], "inner")
                   .groupBy("epoch").agg(F.count(F.lit(1)).cast("long").alias("treasury_withdrawal_total")))

    out = base
    for part in (stake, dist, pools, cc, blocks, txs, proposed, statuses, regs, withdrawals):
        out = out.join(F.broadcast(part), "epoch", "left")
    zero = lambda c, typ: F.coalesce(F.col(c), F.lit(0)).cast(typ).alias(c)
    return out.select(
        F.col("epoch").cast("int").alias("epoch"),
        *[F.col(c).cast("long").alias(c) for c in ("treasury", "reserves", "circulation", "utxo", "fees")],
        "total_active_stake", "total_drep_delegated", "total_drep_delegated_non_abstain",
        "total_drep_delegated_no_confidence", "active_drep_count", "active_pool_count",
        "cc_member_count", F.col("cc_threshold").cast("double").alias("cc_threshold"),
        "block_count", "tx_count", "epoch_start_time", "epoch_end_time",
        zero("gov_actions_proposed", "int"), zero("gov_actions_ratified", "int"),
        zero("gov_actions_expired", "int"), zero("drep_registrations", "int"),
        zero("drep_retirements", "int"), zero("treasury_withdrawal_total", "long"),
    )


# ---------------------------------------------------------------- DS6 -----

def delegation_events(t: Tables, epochs=None) -> DataFrame:
    """DS6: delegation certificates of the requested epochs."""
    dv = in_epochs(t.delegation_vote, _epochs(t, epochs))
    return dv.select("address", "drep_hash", "drep_id", "drep_type", "credential",
                     F.col("epoch").cast("int").alias("epoch"), "slot",
                     epoch_seconds("block_time").alias("block_time"))


# ---------------------------------------------------------------- DS7 -----

def cc_vote_details(t: Tables, epochs=None) -> DataFrame:
    """DS7: committee votes of the requested epochs with the voter's latest
    cold key and the seconds from proposal to vote."""
    cold = latest_by(t.committee_registration, ["hot_key"], ["slot", "tx_index", "cert_index"],
                     ["cold_key"]).withColumnRenamed("hot_key", "voter_hash")
    votes = in_epochs(t.voting_procedure.filter(F.col("voter_type").isin(*C.CC_VOTER_TYPES)),
                      _epochs(t, epochs))
    joined = (votes.join(_proposal_side(t), ["gov_action_tx_hash", "gov_action_index"], "inner")
                   .join(cold, "voter_hash", "left"))
    return joined.select(
        "gov_action_tx_hash",
        F.col("gov_action_index").cast("int").alias("gov_action_index"),
        "action_type", "action_epoch", "voter_hash", "cold_key", "vote",
        F.col("epoch").cast("int").alias("vote_epoch"),
        epoch_seconds("block_time").alias("vote_block_time"),
        epoch_seconds("__action_time").alias("action_block_time"),
        seconds_between("block_time", "__action_time").alias("time_to_vote_seconds"),
        F.col("epoch").cast("int").alias("epoch"),
    )


# ---------------------------------------------------------------- DS8 -----

def _threshold_tree(groups) -> dict:
    return {key: {"numerator": None, "denominator": None} for key, _ in groups}


def governance_params(t: Tables, epochs=None) -> DataFrame:
    """DS8: protocol parameters per epoch; the JSON is parsed once into a
    struct and thresholds become ``numerator / nullif(denominator, 0)``."""
    tree = {k: None for k, _ in C.PARAM_SCALARS}
    tree["pool_voting_thresholds"] = _threshold_tree(C.POOL_THRESHOLDS)
    tree["drep_voting_thresholds"] = _threshold_tree(C.DREP_THRESHOLDS)
    ep = in_epochs(t.epoch_param, _epochs(t, epochs))
    p = ep.select(F.col("epoch"), parse_json_strings("params", tree).alias("p"))

    def thresholds(group: str, names):
        out = []
        for key, name in names:
            node = F.col("p")[group][key]
            out.append(ratio(json_num(node["numerator"], "double"),
                             json_num(node["denominator"], "double")).alias(name))
        return out

    return p.select(
        F.col("epoch").cast("int").alias("epoch"),
        *[json_num(F.col("p")[k], typ).alias(k) for k, typ in C.PARAM_SCALARS],
        *thresholds("pool_voting_thresholds", C.POOL_THRESHOLDS),
        *thresholds("drep_voting_thresholds", C.DREP_THRESHOLDS),
    )


# ------------------------------------------------------------ D4 rejects --

def json_rejects(t: Tables) -> DataFrame:
    """D4: malformed JSON is read as NULL (the original engine raised); the
    rejected rows are counted per (table, column) so they are not silent."""
    stats = t.gov_action_proposal_status.select(
        F.lit("gov_action_proposal_status").alias("source_table"), F.lit("voting_stats").alias("json_column"),
        (F.col("voting_stats").isNotNull()
         & F.from_json("voting_stats", "map<string,string>").isNull()).alias("__bad"))
    params = t.epoch_param.select(
        F.lit("epoch_param").alias("source_table"), F.lit("params").alias("json_column"),
        (F.col("params").isNotNull() & F.from_json("params", "map<string,string>").isNull()).alias("__bad"))
    owners = t.pool_registration.select(
        F.lit("pool_registration").alias("source_table"), F.lit("pool_owners").alias("json_column"),
        (F.col("pool_owners").isNotNull() & F.from_json("pool_owners", "array<string>").isNull()).alias("__bad"))
    return (stats.unionByName(params).unionByName(owners).groupBy("source_table", "json_column")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if("__bad").alias("rejected_rows")))


def _bad_json(column: str, schema: str):
    return F.col(column).isNotNull() & F.from_json(column, schema).isNull()


def rejected_rows(t: Tables) -> DataFrame:
    """D3/D4: every source value that a dataset reads as NULL because it is no
    JSON or no number: (source_table, source_column, field, row_key, reason,
    rejected_text), one row each, whatever the epochs of a run."""
    def rows(table: str, column: str, key: list, schema: str, reason: str, numbers: list):
        """numbers: (field, type) of the numeric fields inside good JSON."""
        # parsed once a row: a column of its own, else the optimiser parses the text once per field of it
        src = (t[table].withColumn("__key", F.concat_ws("/", *[F.col(k).cast("string") for k in key]))
               .withColumn("__json", parse_json_strings(column, {f: None for f, _ in numbers}) if numbers else F.lit(None)))
        row = lambda field, why, text: F.struct(F.lit(field).cast("string").alias("field"), F.lit(why).alias("reason"),
                                                text.alias("rejected_text"))
        text = lambda f: F.col("__json")[f]
        fields = [F.when(text(f).isNotNull() & json_num(text(f), typ).isNull(), row(f, "not a number", text(f))) for f, typ in numbers]
        faults = F.when(_bad_json(column, schema), F.array(row(None, reason, F.col(column)))).otherwise(
            F.filter(F.array(*fields), lambda r: r.isNotNull()) if fields else F.array().cast(
                "array<struct<field:string,reason:string,rejected_text:string>>"))
        # outer: a plain explode would also be a filter, which repeats the parsing on the rows that the table is made of
        return (src.withColumn("__r", F.explode_outer(faults)).filter(F.col("__r").isNotNull())
                .select(F.lit(table).alias("source_table"), F.lit(column).alias("source_column"), F.col("__r.field").alias("field"),
                        F.col("__key").alias("row_key"), F.col("__r.reason").alias("reason"),
                        F.col("__r.rejected_text").alias("rejected_text")))

    return (rows("gov_action_proposal_status", "voting_stats", ["gov_action_tx_hash", "gov_action_index", "epoch"], "map<string,string>",
                 "malformed json", list(C.VOTING_STATS_FIELDS))
            .unionByName(rows("epoch_param", "params", ["epoch"], "map<string,string>", "malformed json",
                              list(C.PARAM_SCALARS)))
            .unionByName(rows("pool_registration", "pool_owners", ["pool_id", "slot", "cert_index"], "array<string>", "not a list", [])))


DATASETS = {
    "drep_epoch_stats": drep_epoch_stats,
    "pool_epoch_stats": pool_epoch_stats,
    "gov_action_votes": gov_action_votes,
    "gov_action_lifecycle": gov_action_lifecycle,
    "epoch_summary": epoch_summary,
    "delegation_events": delegation_events,
    "cc_vote_details": cc_vote_details,
    "governance_params": governance_params,
}
