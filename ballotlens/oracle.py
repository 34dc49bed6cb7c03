"""DuckDB reference SQL for the correctness gate (``oracle_sql()``).

Each entry is a complete DuckDB query over the driver's tables: the
governance tables are derived in CTEs from the same projection text the Spark
side uses (``sources.fixtures``), then the operator is written independently,
in plain per-group SQL (ROW_NUMBER / correlated ranges), so that the two
engines check each other rather than share logic.
"""

from __future__ import annotations

from ballotlens import constants as C
from ballotlens.sources.fixtures import duckdb_with


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


TERMINAL = _q(C.TERMINAL_STATUSES)
DREP_VT = _q(C.DREP_VOTER_TYPES)
CC_VT = _q(C.CC_VOTER_TYPES)

# target epochs: settled epochs from the governance start, plus the newest
TARGETS = """tgt as (
  select distinct epoch from g_adapot
  where epoch >= (select coalesce(min(epoch), 0) from g_drep_dist)
     or epoch = (select max(epoch) from g_adapot))"""


def _with(tables, *ctes: str, body: str) -> str:
    return duckdb_with(list(dict.fromkeys(tables)), body, extra_ctes=ctes)


def _ds(tables, ctes, body):
    need = list(tables) + ["adapot", "drep_dist"]
    return _with(need, TARGETS, *ctes, body=body)


def _epoch_secs(c: str) -> str:
    return f"cast(epoch({c}) as bigint)"


# ------------------------------------------------------------------ META ---

META = {
    "meta1_settled_epochs": _with(["adapot"], body="select distinct epoch from g_adapot"),
    "meta2_max_epoch": _with(["adapot"], body="select max(epoch) as max_epoch from g_adapot"),
    "meta3_governance_start": _with(
        ["drep_dist"], body="select cast(coalesce(min(epoch), 0) as int) as start_epoch from g_drep_dist"),
    "meta4_target_epochs": _ds([], [], "select epoch from tgt"),
}

# ------------------------------------------------------------------ DS1 ---

_DS1_CTES = ["""dd1 as (select * from g_drep_dist where epoch in (select epoch from tgt))"""]
# as-of status, registration facts and vote counts as correlated lookups per row
_ASOF_STATUS = """(select s.status from g_drep s where s.drep_hash = dd1.drep_hash and s.epoch <= dd1.epoch
   order by s.slot desc nulls last, s.tx_index desc, s.cert_index desc limit 1)"""
_DS1_BODY = f"""select cast(dd1.epoch as int) as epoch, dd1.drep_hash, dd1.drep_type, dd1.drep_id,
  dd1.amount as delegated_amount, cast(dd1.active_until as int) as active_until,
  cast(dd1.expiry as int) as expiry,
  {_ASOF_STATUS} as status,
  (select cast(min(r.epoch) as int) from g_drep_registration r where r.drep_hash = dd1.drep_hash)
    as registration_epoch,
  (select bool_or(r.anchor_url is not null) from g_drep_registration r
    where r.drep_hash = dd1.drep_hash
      and r.slot = (select max(r2.slot) from g_drep_registration r2 where r2.drep_hash = dd1.drep_hash))
    as has_metadata,
  (select cast(count(*) as int) from g_voting_procedure v
    where v.voter_hash = dd1.drep_hash and v.epoch = dd1.epoch and v.voter_type in ({DREP_VT})) as votes_cast,
  (select cast(count(v.anchor_url) as int) from g_voting_procedure v
    where v.voter_hash = dd1.drep_hash and v.epoch = dd1.epoch and v.voter_type in ({DREP_VT}))
    as votes_with_rationale
from dd1"""
DS1_TABLES = ["drep_dist", "drep", "drep_registration", "voting_procedure"]

# ------------------------------------------------------------------ DS2 ---

# owners: unnested from the pool's newest certificate; stance: the newest default delegation of a credential
_DS2_CTES = [
    """owner_of as (
  select k.pool_id, unnest(try_cast((select c.pool_owners from g_pool_registration c where c.pool_id = k.pool_id
      order by c.slot desc, c.tx_index desc, c.cert_index desc limit 1) as varchar[])) as who
  from (select distinct pool_id from g_pool_registration) k)""",
    """stance_of as (
  select credential as who, max(struct_pack(a := slot, b := tx_index, c := cert_index, stance := drep_type)).stance as stance
  from g_delegation_vote where drep_type in ('ABSTAIN', 'NO_CONFIDENCE') group by credential)""",
]


def _spo_votes(agg: str) -> str:
    return (f"(select cast({agg} as int) from g_voting_procedure v where v.voter_type = '{C.SPO_VOTER_TYPE}' "
            "and v.voter_hash = p.pool_id and v.epoch = p.epoch)")


_DS2_BODY = f"""select cast(p.epoch as int) as epoch, p.pool_id, p.status, p.amount as stake_amount,
  {_spo_votes('count(*)')} as votes_cast,
  {_spo_votes("count(*) filter (where v.vote = 'YES')")} as votes_yes,
  {_spo_votes("count(*) filter (where v.vote = 'NO')")} as votes_no,
  {_spo_votes("count(*) filter (where v.vote = 'ABSTAIN')")} as votes_abstain,
  (select min(stance) from stance_of where who in (select o.who from owner_of o where o.pool_id = p.pool_id))
    as default_stance
from g_pool p
where p.epoch in (select epoch from tgt)"""
DS2_TABLES = ["pool", "voting_procedure", "pool_registration", "delegation_vote"]

# ------------------------------------------------------------------ DS3 ---

def _with_action(where: str) -> str:
    """Votes of the target epochs; each looks up the proposal it names."""
    return f"""(select v.*, (select struct_pack(type := p.type, epoch := p.epoch, block_time := p.block_time)
               from g_gov_action_proposal p where p.tx_hash = v.gov_action_tx_hash and p.idx = v.gov_action_index) as action
        from g_voting_procedure v where {where} and v.epoch in (select epoch from tgt))"""


_DS3_CTES: list[str] = []
_DS3_BODY = f"""select gov_action_tx_hash, cast(gov_action_index as int) as gov_action_index, action.type as action_type,
  cast(action.epoch as int) as action_epoch, {_epoch_secs('action.block_time')} as action_block_time,
  voter_type, voter_hash, vote, anchor_url is not null as has_rationale,
  cast(epoch as int) as vote_epoch, {_epoch_secs('block_time')} as vote_block_time, slot as vote_slot
from {_with_action("true")} where action is not null"""
DS3_TABLES = ["voting_procedure", "gov_action_proposal"]

# ------------------------------------------------------------------ DS4 ---


def _stats_cols(src: str) -> str:
    cols = []
    for key, typ in C.VOTING_STATS_FIELDS:
        txt = f"json_extract_string(case when json_valid({src}) then {src} end, '$.{key}')"
        if typ == "double":
            cols.append(f"cast({txt} as double) as {key}")
        else:
            cols.append(f"cast({txt} as {typ}) as {key}")
    return ",\n  ".join(cols)


# every action looks up its newest status row as one struct; the rule is then a filter on that struct
_DS4_CTES = [
    """decided as (
  select a.*, (select struct_pack(state := z.status, stats := z.voting_stats, since := z.epoch)
               from g_gov_action_proposal_status z
               where z.gov_action_tx_hash = a.tx_hash and z.gov_action_index = a.idx
               order by z.epoch desc, z.status desc nulls last, z.voting_stats desc nulls last limit 1) as now
  from g_gov_action_proposal a)""",
    f"""closed as (
  select *, case when now.state in ({TERMINAL}) then now.since end as closed_in, now.stats as stats from decided)""",
]
_DS4_BODY = f"""select tx_hash as gov_action_tx_hash, cast(idx as int) as gov_action_index, type,
  deposit, return_address, anchor_url, cast(epoch as int) as epoch_proposed,
  {_epoch_secs('block_time')} as block_time_proposed, now.state as status,
  cast(closed_in as int) as epoch_resolved,
  {_stats_cols('stats')},
  cast(coalesce(closed_in, closed.epoch) as int) as epoch
from closed
where now.state is null or not now.state in ({TERMINAL}) or exists (select 1 from tgt where tgt.epoch = closed.epoch)"""
DS4_TABLES = ["gov_action_proposal", "gov_action_proposal_status"]

# ------------------------------------------------------------------ DS5 ---

_DS5_CTES: list[str] = []
# every measure is a correlated lookup on the epoch row; "having count(*) > 0"
# keeps NULL (not 0) for epochs without rows where the dataset has NULL
_CC_COUNT = """(select cast(count(m.hash) as int) from g_committee_member m
    where m.start_epoch <= a.epoch and (m.expired_epoch is null or m.expired_epoch > a.epoch))"""
_DS5_BODY = f"""select cast(a.epoch as int) as epoch, cast(a.treasury as bigint) as treasury,
  cast(a.reserves as bigint) as reserves, cast(a.circulation as bigint) as circulation,
  cast(a.utxo as bigint) as utxo, cast(a.fees as bigint) as fees,
  (select cast(sum(s.amount) as bigint) from g_epoch_stake s where s.epoch = a.epoch) as total_active_stake,
  (select cast(sum(d.amount) as bigint) from g_drep_dist d where d.epoch = a.epoch) as total_drep_delegated,
  (select cast(sum(d.amount) filter (where d.drep_type <> 'ABSTAIN') as bigint) from g_drep_dist d
    where d.epoch = a.epoch) as total_drep_delegated_non_abstain,
  (select cast(sum(d.amount) filter (where d.drep_type = 'NO_CONFIDENCE') as bigint) from g_drep_dist d
    where d.epoch = a.epoch) as total_drep_delegated_no_confidence,
  (select cast(count(distinct d.drep_hash) filter (where d.drep_type not in ('ABSTAIN', 'NO_CONFIDENCE')) as int)
    from g_drep_dist d where d.epoch = a.epoch having count(*) > 0) as active_drep_count,
  (select cast(count(*) as int) from g_pool p where p.epoch = a.epoch and p.status <> 'RETIRED'
    having count(*) > 0) as active_pool_count,
  {_CC_COUNT} as cc_member_count,
  (select c.threshold from g_committee c order by c.epoch desc, c.slot desc limit 1) as cc_threshold,
  (select cast(count(*) as int) from g_block b where b.epoch = a.epoch having count(*) > 0) as block_count,
  (select cast(count(*) as bigint) from g_transaction x where x.epoch = a.epoch having count(*) > 0) as tx_count,
  (select cast(min(epoch(b.block_time)) as bigint) from g_block b where b.epoch = a.epoch) as epoch_start_time,
  (select cast(max(epoch(b.block_time)) as bigint) from g_block b where b.epoch = a.epoch) as epoch_end_time,
  (select cast(count(*) as int) from g_gov_action_proposal g where g.epoch = a.epoch) as gov_actions_proposed,
  (select cast(count(*) filter (where s.status = 'RATIFIED') as int) from g_gov_action_proposal_status s
    where s.epoch = a.epoch) as gov_actions_ratified,
  (select cast(count(*) filter (where s.status = 'EXPIRED') as int) from g_gov_action_proposal_status s
    where s.epoch = a.epoch) as gov_actions_expired,
  (select cast(count(*) filter (where r.type = 'REG_DREP_CERT') as int) from g_drep_registration r
    where r.epoch = a.epoch) as drep_registrations,
  (select cast(count(*) filter (where r.type = 'UNREG_DREP_CERT') as int) from g_drep_registration r
    where r.epoch = a.epoch) as drep_retirements,
  (select cast(count(*) as bigint) from g_gov_action_proposal g
    join g_gov_action_proposal_status s on s.gov_action_tx_hash = g.tx_hash and s.gov_action_index = g.idx
    where g.epoch = a.epoch and g.type = 'TREASURY_WITHDRAWALS_ACTION' and s.status = 'ENACTED'
      and s.epoch in (select epoch from tgt)) as treasury_withdrawal_total
from g_adapot a
where a.epoch in (select epoch from tgt)"""
DS5_TABLES = ["adapot", "block", "transaction", "epoch_stake", "drep_dist", "pool", "committee_member",
              "committee", "gov_action_proposal", "gov_action_proposal_status", "drep_registration"]

# ------------------------------------------------------------------ DS6 ---

_DS6_BODY = f"""select address, drep_hash, drep_id, drep_type, credential, cast(epoch as int) as epoch, slot,
  {_epoch_secs('block_time')} as block_time
from g_delegation_vote where epoch in (select epoch from tgt)"""

# ------------------------------------------------------------------ DS7 ---

_DS7_CTES: list[str] = []
_DS7_BODY = f"""select gov_action_tx_hash, cast(gov_action_index as int) as gov_action_index, action.type as action_type,
  cast(action.epoch as int) as action_epoch, voter_hash,
  (select c.cold_key from g_committee_registration c where c.hot_key = voter_hash
   order by c.slot desc, c.tx_index desc, c.cert_index desc limit 1) as cold_key,
  vote, cast(epoch as int) as vote_epoch, {_epoch_secs('block_time')} as vote_block_time,
  {_epoch_secs('action.block_time')} as action_block_time,
  cast(date_diff('second', action.block_time, block_time) as bigint) as time_to_vote_seconds,
  cast(epoch as int) as epoch
from {_with_action(f"voter_type in ({CC_VT})")} where action is not null"""
DS7_TABLES = ["voting_procedure", "gov_action_proposal", "committee_registration"]

# ------------------------------------------------------------------ DS8 ---


def _ds8_cols() -> str:
    cols = []
    for key, typ in C.PARAM_SCALARS:
        cols.append(f"cast(json_extract_string(params, '$.{key}') as {typ}) as {key}")
    for group, names in (("pool_voting_thresholds", C.POOL_THRESHOLDS),
                         ("drep_voting_thresholds", C.DREP_THRESHOLDS)):
        for key, name in names:
            num = f"cast(json_extract_string(params, '$.{group}.{key}.numerator') as double)"
            den = f"cast(json_extract_string(params, '$.{group}.{key}.denominator') as double)"
            cols.append(f"{num} / nullif({den}, 0) as {name}")
    return ",\n  ".join(cols)


_DS8_BODY = f"""select cast(epoch as int) as epoch,
  {_ds8_cols()}
from g_epoch_param where epoch in (select epoch from tgt)"""

# dataset name -> (source tables, helper CTEs, body)
BUNDLES = {
    "drep_epoch_stats": (DS1_TABLES, _DS1_CTES, _DS1_BODY),
    "pool_epoch_stats": (DS2_TABLES, _DS2_CTES, _DS2_BODY),
    "gov_action_votes": (DS3_TABLES, _DS3_CTES, _DS3_BODY),
    "gov_action_lifecycle": (DS4_TABLES, _DS4_CTES, _DS4_BODY),
    "epoch_summary": (DS5_TABLES, _DS5_CTES, _DS5_BODY),
    "delegation_events": (["delegation_vote"], [], _DS6_BODY),
    "cc_vote_details": (DS7_TABLES, _DS7_CTES, _DS7_BODY),
    "governance_params": (["epoch_param"], [], _DS8_BODY),
}


def over_datasets(names, body: str, tables=(), ctes=()) -> str:
    """SQL whose ``body`` reads datasets as CTEs ``ds_<name>`` (plus optional
    raw ``g_<table>`` tables and extra CTEs)."""
    need_tables: list[str] = list(tables)
    all_ctes: list[str] = [TARGETS]
    for n in names:
        tabs, helper, ds_body = BUNDLES[n]
        need_tables += tabs
        all_ctes += [c for c in helper if c not in all_ctes]
        all_ctes.append(f"ds_{n} as (\n{ds_body})")
    all_ctes += list(ctes)
    return _with(need_tables + ["adapot", "drep_dist"], *all_ctes, body=body)


DATASETS = {
    "ds1_drep_epoch_stats": _ds(DS1_TABLES, _DS1_CTES, _DS1_BODY),
    "ds2_pool_epoch_stats": _ds(DS2_TABLES, _DS2_CTES, _DS2_BODY),
    "ds3_gov_action_votes": _ds(DS3_TABLES, _DS3_CTES, _DS3_BODY),
    "ds4_gov_action_lifecycle": _ds(DS4_TABLES, _DS4_CTES, _DS4_BODY),
    "ds5_epoch_summary": _ds(DS5_TABLES, _DS5_CTES, _DS5_BODY),
    "ds6_delegation_events": _ds(["delegation_vote"], [], _DS6_BODY),
    "ds7_cc_vote_details": _ds(DS7_TABLES, _DS7_CTES, _DS7_BODY),
    "ds8_governance_params": _ds(["epoch_param"], [], _DS8_BODY),
}

SUBOPS = {
    "ds1a_asof_status": _ds(DS1_TABLES, _DS1_CTES, f"""select dd1.drep_hash, cast(dd1.epoch as int) as epoch,
  dd1.drep_id, {_ASOF_STATUS} as status
from dd1"""),
    "ds2e_default_stance": _ds(DS2_TABLES, _DS2_CTES, """select pool_id, default_stance from (
  select k.pool_id, (select min(stance) from stance_of where who in
                       (select o.who from owner_of o where o.pool_id = k.pool_id)) as default_stance
  from (select distinct pool_id from owner_of) k)
where default_stance is not null"""),
    "ds4c_voting_stats": _with(["gov_action_proposal_status"], body=f"""select gov_action_tx_hash,
  cast(gov_action_index as int) as gov_action_index, cast(epoch as int) as epoch, status,
  {_stats_cols('voting_stats')}
from g_gov_action_proposal_status"""),
    "ds4d_json_rejects": _with(["gov_action_proposal_status", "epoch_param", "pool_registration"], body="""
select 'gov_action_proposal_status' as source_table, 'voting_stats' as json_column, count(*) as rows,
  cast(sum(case when voting_stats is not null and not json_valid(voting_stats) then 1 else 0 end) as bigint)
    as rejected_rows
from g_gov_action_proposal_status
union all
select 'epoch_param', 'params', count(*),
  cast(sum(case when params is not null and not json_valid(params) then 1 else 0 end) as bigint)
from g_epoch_param
union all
select 'pool_registration', 'pool_owners', count(*),
  cast(sum(case when pool_owners is not null and try_cast(pool_owners as varchar[]) is null then 1 else 0 end) as bigint)
from g_pool_registration"""),
    "ds5g_cc_range_join": _ds(DS5_TABLES, [], f"""select cast(a.epoch as int) as epoch, {_CC_COUNT} as cc_member_count
from g_adapot a where a.epoch in (select epoch from tgt)"""),
}


# sinks read back what they wrote: same rows as the dataset
SINKS = {
    "stream_delegation_events": _with(["delegation_vote"], body=f"""select address, drep_hash, drep_id, drep_type,
  credential, cast(epoch as int) as epoch, slot, {_epoch_secs('block_time')} as block_time
from g_delegation_vote"""),
    "stream_epoch_summary_refreshed": DATASETS["ds5_epoch_summary"],
    "stream_lifecycle_refreshed": DATASETS["ds4_gov_action_lifecycle"],
    "src1_exports_catalog": DATASETS["ds1_drep_epoch_stats"],
    "snk1_drep_epoch_stats_written": DATASETS["ds1_drep_epoch_stats"],
    "snk3_epoch_summary_incremental": DATASETS["ds5_epoch_summary"],
    "snk5_lifecycle_upsert": DATASETS["ds4_gov_action_lifecycle"],
}


_COUNTS = over_datasets(list(BUNDLES), " union all ".join(
    f"select '{n}' as dataset, count(*) as rows from ds_{n}" for n in BUNDLES))
SINKS["snk6_all_incremental"] = SINKS["snk6_all_full"] = _COUNTS


# ------------------------------------------------ runs over exported folders

_VOTE = ["gov_action_tx_hash", "gov_action_index", "action_type", "action_epoch", "action_block_time", "voter_hash", "vote", "vote_epoch",
         "vote_block_time"]
COLUMNS = {
    "drep_epoch_stats": ["epoch", "drep_hash", "drep_type", "drep_id", "delegated_amount", "active_until", "expiry", "status",
                         "registration_epoch", "has_metadata", "votes_cast", "votes_with_rationale"],
    "pool_epoch_stats": ["epoch", "pool_id", "status", "stake_amount", "votes_cast", "votes_yes", "votes_no", "votes_abstain",
                         "default_stance"],
    "gov_action_votes": [*_VOTE, "voter_type", "has_rationale", "vote_slot"],
    "gov_action_lifecycle": ["gov_action_tx_hash", "gov_action_index", "type", "deposit", "return_address", "anchor_url",
                             "epoch_proposed", "block_time_proposed", "status", "epoch_resolved", "epoch",
                             *[k for k, _ in C.VOTING_STATS_FIELDS]],
    "epoch_summary": ["epoch", "treasury", "reserves", "circulation", "utxo", "fees", "total_active_stake", "total_drep_delegated",
                      "total_drep_delegated_non_abstain", "total_drep_delegated_no_confidence", "active_drep_count",
                      "active_pool_count", "cc_member_count", "cc_threshold", "block_count", "tx_count", "epoch_start_time",
                      "epoch_end_time", "gov_actions_proposed", "gov_actions_ratified", "gov_actions_expired",
                      "drep_registrations", "drep_retirements", "treasury_withdrawal_total"],
    "delegation_events": ["address", "drep_hash", "drep_id", "drep_type", "credential", "epoch", "slot", "block_time"],
    "cc_vote_details": [*_VOTE, "cold_key", "time_to_vote_seconds", "epoch"],
    "governance_params": ["epoch", *[k for k, _ in C.PARAM_SCALARS], *[n for _, n in C.POOL_THRESHOLDS], *[n for _, n in C.DREP_THRESHOLDS]],
}


def _is_double(name: str) -> bool:
    return name.endswith("_ratio") or name.startswith(("pvt_", "dvt_")) or name == "cc_threshold"


def _checksums(names) -> str:
    def one(name: str) -> str:
        text = ", ".join("coalesce(cast(" + (f"cast(round({c} * 1000000) as bigint)" if _is_double(c) else c) + " as varchar), '~')"
                         for c in sorted(COLUMNS[name]))
        return (f"select '{name}' as dataset, count(*) as rows, cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {text})), 1, 8) "
                f"as bigint)), 0) as bigint) as checksum from ds_{name}")
    return over_datasets(names, " union all ".join(one(n) for n in names))


def _per_epoch_order(name: str, epoch: str, value: str) -> str:
    return over_datasets([name], f"""select {epoch} as epoch, count(*) as rows, cast(0 as bigint) as misplaced,
  cast(0 as bigint) as overlaps, min({value}) as first_value, max({value}) as last_value
from ds_{name} group by {epoch}""")


SINKS.update({
    "snk5_affected_actions": _checksums(["gov_action_lifecycle"]),
    "snk6_change_driven": _checksums(list(BUNDLES)),
    "ds3c_ordered_votes": _per_epoch_order("gov_action_votes", "vote_epoch", "gov_action_tx_hash"),
    "ds6b_ordered_events": _per_epoch_order("delegation_events", "epoch", "slot"),
    "src3_partitioned_view": DATASETS["ds3_gov_action_votes"],
    "src4_file_view": DATASETS["ds7_cc_vote_details"],
    "src5_discovered_views": over_datasets(["delegation_events", "governance_params"], """
select 'delegation_events' as view_name, count(*) as rows from ds_delegation_events
union all select 'governance_params', count(*) from ds_governance_params
union all select 'kpi_1_2_active_stake_participation', count(distinct epoch) from ds_delegation_events
union all select 'kpi_1_5_delegation_churn', count(distinct e.epoch)
from ds_delegation_events e where exists (
  select 1 from (select * from ds_delegation_events) p where p.address = e.address and p.slot < e.slot
    and p.drep_hash is not null and (p.drep_hash <> e.drep_hash or p.drep_type <> e.drep_type)
    and not exists (select 1 from ds_delegation_events q where q.address = e.address and q.slot > p.slot and q.slot < e.slot))"""),
})


def _messy_with(body: str, tables=()) -> str:
    from ballotlens.registry import MESSY_STATS
    return _with(["gov_action_proposal_status", *tables], f"""messy as (
  select gov_action_tx_hash, gov_action_index, epoch, status, {MESSY_STATS} as voting_stats from g_gov_action_proposal_status)""", body=body)


def _text_of(column: str, key: str) -> str:
    return f"json_extract_string(case when json_valid({column}) then {column} end, '$.{key}')"


def _rules() -> dict[str, str]:
    numbers = ",\n  ".join(f"try_cast({_text_of('voting_stats', k)} as {t}) as {k}" for k, t in C.VOTING_STATS_FIELDS)
    key = "concat_ws('/', gov_action_tx_hash, gov_action_index, epoch)"
    fields = " union all ".join(f"""select 'gov_action_proposal_status', 'voting_stats', '{k}', {key}, 'not a number', {_text_of('voting_stats', k)}
from messy where {_text_of('voting_stats', k)} is not null and try_cast({_text_of('voting_stats', k)} as {t}) is null"""
                                for k, t in C.VOTING_STATS_FIELDS)
    params = " union all ".join(f"""select 'epoch_param', 'params', '{k}', cast(epoch as varchar), 'not a number', {_text_of('params', k)}
from g_epoch_param where {_text_of('params', k)} is not null and try_cast({_text_of('params', k)} as {t}) is null"""
                                for k, t in C.PARAM_SCALARS)
    return {
        "d3_numeric_text": _messy_with(f"""select gov_action_tx_hash, cast(gov_action_index as int) as gov_action_index,
  cast(epoch as int) as epoch, status, {numbers} from messy"""),
        "d4_rejected_rows": _messy_with(f"""select 'gov_action_proposal_status' as source_table, 'voting_stats' as source_column,
  cast(null as varchar) as field, {key} as row_key, 'malformed json' as reason, voting_stats as rejected_text
from messy where voting_stats is not null and not json_valid(voting_stats)
union all select 'epoch_param', 'params', null, cast(epoch as varchar), 'malformed json', params
from g_epoch_param where params is not null and not json_valid(params)
union all select 'pool_registration', 'pool_owners', null, concat_ws('/', pool_id, slot, cert_index), 'not a list', pool_owners
from g_pool_registration where pool_owners is not null and try_cast(pool_owners as varchar[]) is null
union all {fields} union all {params}""", ["epoch_param", "pool_registration"]),
        "d5_nulls_last": _with(["gov_action_proposal"], body="""select type, place, tx_hash, idx,
  lag(tx_hash) over (partition by type order by place asc nulls last, tx_hash, idx) as prev_tx_hash
from (select type, nullif(slot % 7, 0) as place, tx_hash, idx from g_gov_action_proposal)"""),
    }


def all_sql() -> dict[str, str]:
    from ballotlens.oracle_kpis import KPIS
    return {**META, **DATASETS, **SUBOPS, **KPIS, **SINKS, **_rules(), "src6_kpi_view": KPIS["k1_1_voting_turnout"]}
