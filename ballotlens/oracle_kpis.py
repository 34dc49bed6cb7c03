"""DuckDB reference SQL for the KPI queries (K1.x, DOC, P*).

Datasets are embedded as CTEs ``ds_<name>`` (see ``oracle.over_datasets``);
every KPI is then plain per-group SQL with ordinary window functions.
"""

from __future__ import annotations

from ballotlens import constants as C
from ballotlens.oracle import over_datasets

DREP = ", ".join(f"'{v}'" for v in C.DREP_VOTER_TYPES)
SPO = f"'{C.SPO_VOTER_TYPE}'"
DEFAULTS = "'ABSTAIN', 'NO_CONFIDENCE'"
ACTIVE = (f"drep_hash is not null and drep_type not in ({DEFAULTS}) and coalesce(status, '') <> 'RETIRED' "
          "and (active_until is null or epoch <= active_until)")


def pct(num: str, den: str, digits: int = 4) -> str:
    return f"round(cast({num} as double) * 100.0 / nullif(cast({den} as double), 0), {digits})"


def cnt(cond: str) -> str:
    return f"cast(sum(case when {cond} then 1 else 0 end) as bigint)"


def _utc(secs: str) -> str:
    return f"make_timestamp(cast({secs} as bigint) * 1000000)"


K = {}

K["k1_1_voting_turnout"] = over_datasets(["gov_action_lifecycle", "epoch_summary"], f"""
select a.epoch, a.actions_count, a.avg_participating_stake, e.circulation,
  {pct('a.avg_participating_stake', 'e.circulation')} as turnout_pct
from (select epoch_proposed as epoch, count(*) as actions_count,
             avg(drep_yes_vote_stake + drep_no_vote_stake + drep_abstain_vote_stake) as avg_participating_stake
      from ds_gov_action_lifecycle where drep_yes_vote_stake is not null group by epoch_proposed) a
join ds_epoch_summary e on e.epoch = a.epoch""")

# per epoch: distinct addresses; addresses whose first epoch it is; addresses seen so far
K["k1_2_active_stake_participation"] = over_datasets(["delegation_events"], """
select p.epoch, count(distinct p.address) as active_addresses,
  (select count(*) from (select address from ds_delegation_events group by address
                         having min(epoch) = p.epoch) f) as new_addresses,
  (select count(distinct e.address) from ds_delegation_events e where e.epoch <= p.epoch)
    as cumulative_unique_addresses
from ds_delegation_events p group by p.epoch""")

K["k1_3_delegation_rate"] = over_datasets(["epoch_summary"], f"""
select epoch, total_drep_delegated, circulation,
  {pct('total_drep_delegated', 'circulation')} as delegation_rate_pct
from ds_epoch_summary""")

# delegations of an address numbered in order; each is compared with the one numbered before it
_CHURN = """numbered as (
  select address, epoch, slot, drep_hash, drep_type, row_number() over (partition by address
    order by slot nulls last, epoch nulls last, drep_type nulls last, drep_hash nulls last, drep_id nulls last,
             credential nulls last) as i
  from ds_delegation_events),
churn as (
  select e.address, e.epoch, e.slot, p.drep_hash as ph
  from numbered e join numbered p on p.address is not distinct from e.address and p.i = e.i - 1
  where p.drep_hash is not null and (e.drep_hash <> p.drep_hash or e.drep_type <> p.drep_type))"""

K["k1_5_delegation_churn"] = over_datasets(["delegation_events"], """
select epoch, count(*) as delegation_changes, count(distinct address) as addresses_changed
from churn group by epoch""", ctes=[_CHURN])

K["k1_8_inactive_delegated_ada"] = over_datasets(["drep_epoch_stats"], """
select epoch, cast(sum(delegated_amount) as bigint) as inactive_delegated_ada, count(*) as inactive_drep_count
from ds_drep_epoch_stats where status = 'RETIRED' or epoch > active_until group by epoch""")

K["doc1_ratified_approval"] = over_datasets(["gov_action_lifecycle"], """
select type, drep_approval_ratio, spo_approval_ratio from ds_gov_action_lifecycle where status = 'RATIFIED'""")

K["doc2_gini_sample"] = over_datasets(["drep_epoch_stats"], f"""
select epoch,
  1.0 - 2.0 * (cast(sum(ps) as double) / cast(sum(delegated_amount) as double)) / cast(count(*) as double) as gini
from (select epoch, delegated_amount,
             sum(delegated_amount) over (partition by epoch order by delegated_amount
                                         range between unbounded preceding and current row) as ps
      from ds_drep_epoch_stats where drep_type not in ({DEFAULTS})) r
group by epoch""")

K["doc3_treasury_delta"] = over_datasets(["epoch_summary"], """
select e.epoch, e.treasury,
  e.treasury - (select p.treasury from ds_epoch_summary p where p.epoch < e.epoch order by p.epoch desc limit 1)
    as delta
from ds_epoch_summary e""")

# ------------------------------------------------------------------ P1 ---

K["p1_4_delegation_by_wallet_tier"] = over_datasets(["delegation_events"], f"""
select epoch, tier, count(*) as wallets, {cnt('del')} as delegated_wallets,
  cast(sum(amount) as bigint) as stake, cast(sum(case when del then amount else 0 end) as bigint) as delegated_stake,
  {pct(cnt('del'), 'count(*)')} as wallet_delegation_pct,
  {pct('sum(case when del then amount else 0 end)', 'sum(amount)')} as stake_delegation_pct
from (select s.epoch, s.amount, coalesce(f.fe <= s.epoch, false) as del,
             cast(case when s.amount < 1 then 0 else length(cast(s.amount as varchar)) - 1 end as int) as tier
      from g_epoch_stake s
      left join (select address, min(epoch) as fe from ds_delegation_events group by address) f
        on f.address = s.address
      where s.epoch in (select epoch from tgt)) x
group by epoch, tier""", tables=["epoch_stake"])

K["p1_6_new_wallet_delegation_rate"] = over_datasets([], f"""
select r.epoch, count(*) as new_wallets, {cnt('f.fe >= r.epoch and f.fe <= r.epoch + 0')} as new_wallets_delegating,
  {pct(cnt('f.fe >= r.epoch and f.fe <= r.epoch + 0'), 'count(*)')} as new_wallet_delegation_pct
from (select address, min(epoch) as epoch from g_stake_registration group by address) r
left join (select address, min(epoch) as fe from g_delegation_vote group by address) f on f.address = r.address
group by r.epoch""", tables=["stake_registration", "delegation_vote"])

_LATEST_VOTE = """lv_{n} as (
  select * from (
    select voter_hash, gov_action_tx_hash, gov_action_index, vote, vote_epoch, vote_slot,
           row_number() over (partition by voter_hash, gov_action_tx_hash, gov_action_index
                              order by vote_slot desc, vote desc) as rn
    from ds_gov_action_votes where voter_type in ({types})) x
  where rn = 1)"""

K["p1_7_post_vote_delegation_outflow"] = over_datasets(["delegation_events", "gov_action_votes"], f"""
select lv.gov_action_tx_hash, lv.gov_action_index, lv.vote,
  count(distinct lv.voter_hash) as dreps_with_outflow, count(*) as outflow_delegations,
  cast(sum((select sum(es.amount) from g_epoch_stake es where es.address = m.address and es.epoch = m.epoch)) as bigint)
    as outflow_stake
from lv_drep lv
join (select ph, epoch, address, max(slot) as slot from churn group by ph, epoch, address) m
  on m.ph = lv.voter_hash and m.epoch between lv.vote_epoch and lv.vote_epoch + 2
 and (m.epoch > lv.vote_epoch or m.slot > lv.vote_slot)
group by lv.gov_action_tx_hash, lv.gov_action_index, lv.vote""",
                                                       tables=["epoch_stake"],
                                                       ctes=[_CHURN, _LATEST_VOTE.format(n="drep", types=DREP)])

# ------------------------------------------------------------------ P2 ---


def _gini_sql(src: str, key: str, val: str) -> str:
    n = "cast(count(*) as double)"
    return f"""select {key}, count(*) as n, cast(sum({val}) as bigint) as total,
  2.0 * cast(sum(i * {val}) as double) / ({n} * cast(sum({val}) as double)) - ({n} + 1.0) / {n} as gini
from (select {key}, {val}, row_number() over (partition by {key} order by {val}) as i from {src}) r
group by {key}"""


K["p2_1_drep_stake_gini"] = over_datasets(["drep_epoch_stats"], f"""
select epoch, n as drep_count, total as total_stake, gini from (
{_gini_sql(f"(select epoch, delegated_amount from ds_drep_epoch_stats where {ACTIVE})", "epoch", "delegated_amount")}) g""")

_OPEN = """open_ as (
  select gov_action_tx_hash, gov_action_index,
         unnest(generate_series(epoch_proposed, coalesce(epoch_resolved, (select max(epoch) from ds_epoch_summary))))
           as epoch
  from ds_gov_action_lifecycle
  where coalesce(epoch_resolved, (select max(epoch) from ds_epoch_summary)) >= epoch_proposed)"""

K["p2_2_drep_activity_rate"] = over_datasets(["gov_action_lifecycle", "epoch_summary", "gov_action_votes",
                                              "drep_epoch_stats"], f"""
select d.epoch, count(*) as registered_dreps,
  {cnt('n.open_actions > 0 and cast(coalesce(vd.k, 0) as double) >= 0.5 * n.open_actions')} as active_dreps,
  max(coalesce(n.open_actions, 0)) as open_actions,
  {pct(cnt('n.open_actions > 0 and cast(coalesce(vd.k, 0) as double) >= 0.5 * n.open_actions'), 'count(*)')}
    as activity_rate_pct
from (select distinct epoch, drep_hash as voter_hash from ds_drep_epoch_stats
      where drep_hash is not null and coalesce(status, '') <> 'RETIRED') d
left join (select v.epoch, v.voter_hash, count(*) as k
           from (select distinct voter_hash, gov_action_tx_hash, gov_action_index, vote_epoch as epoch
                 from ds_gov_action_votes where voter_type in ({DREP})) v
           where exists (select 1 from open_ o where o.gov_action_tx_hash = v.gov_action_tx_hash
                         and o.gov_action_index = v.gov_action_index and o.epoch = v.epoch)
           group by v.epoch, v.voter_hash) vd on vd.epoch = d.epoch and vd.voter_hash = d.voter_hash
left join (select epoch, count(*) as open_actions from open_ group by epoch) n on n.epoch = d.epoch
group by d.epoch""", ctes=[_OPEN])

K["p2_3_drep_rationale_rate"] = over_datasets(["gov_action_votes"], f"""
select vote_epoch as epoch, count(*) as drep_votes, {cnt('has_rationale')} as votes_with_rationale,
  {pct(cnt('has_rationale'), 'count(*)')} as rationale_rate_pct
from ds_gov_action_votes where voter_type in ({DREP}) group by vote_epoch""")


def _median_latency(types: str, count_name: str) -> str:
    return over_datasets(["gov_action_votes"], f"""
select vote_epoch as epoch, count(*) as {count_name},
  median(vote_block_time - action_block_time) as median_seconds_to_vote
from ds_gov_action_votes where voter_type in ({types}) group by vote_epoch""")


K["p2_4_drep_time_to_vote"] = _median_latency(DREP, "drep_votes")

K["p2_5_drep_vote_correlation"] = over_datasets(["drep_epoch_stats", "gov_action_votes"], """
select count(r) as pairs, round(avg(r), 6) as mean_pairwise_corr from (
  select case when n * sxx - sx * sx > 0 and n * syy - sy * sy > 0
              then cast(n * sxy - sx * sy as double)
                   / sqrt(cast(n * sxx - sx * sx as double) * cast(n * syy - sy * sy as double)) end as r
  from (select a.voter_hash as a, b.voter_hash as b, count(*) as n,
               sum(a.code) as sx, sum(b.code) as sy, sum(a.code * a.code) as sxx,
               sum(b.code * b.code) as syy, sum(a.code * b.code) as sxy
        from vcodes a join vcodes b on a.gov_action_tx_hash = b.gov_action_tx_hash
                                   and a.gov_action_index = b.gov_action_index and a.voter_hash < b.voter_hash
        group by a.voter_hash, b.voter_hash) s) p""", ctes=[
    _LATEST_VOTE.format(n="drep", types=DREP),
    """top_d as (select drep_hash as voter_hash from ds_drep_epoch_stats
  where drep_hash is not null
    and epoch = (select max(epoch) from ds_drep_epoch_stats where drep_hash is not null)
  order by delegated_amount desc, drep_hash limit 10)""",
    """vcodes as (select voter_hash, gov_action_tx_hash, gov_action_index,
  cast(case vote when 'YES' then 1 when 'NO' then -1 else 0 end as bigint) as code
  from lv_drep where voter_hash in (select voter_hash from top_d))"""])

K["p2_6_drep_lifecycle_rate"] = over_datasets(["epoch_summary"], """
select epoch, drep_registrations, drep_retirements, drep_registrations - drep_retirements as net_drep_change
from ds_epoch_summary""")


def _vote_changes(types: str) -> str:
    return over_datasets(["gov_action_votes"], f"""
select vote_epoch as epoch, count(*) as vote_changes, count(distinct voter_hash) as voters_changing
from (select voter_hash, vote, vote_epoch,
             lag(vote) over (partition by voter_hash, gov_action_tx_hash, gov_action_index
                             order by vote_slot, vote) as pv
      from ds_gov_action_votes where voter_type in ({types})) o
where pv is not null and vote <> pv group by vote_epoch""")


K["p2_7_drep_vote_changes"] = _vote_changes(DREP)

K["p2_8_drep_seniority"] = over_datasets([], """
select strftime(t, '%Y-%m') as registration_month, count(*) as dreps
from (select drep_hash, min(block_time) as t from g_drep_registration group by drep_hash) r
group by strftime(t, '%Y-%m')""", tables=["drep_registration"])

K["p2_9_drep_cc_latency"] = over_datasets(["gov_action_votes", "cc_vote_details"], f"""
select v.action_epoch as epoch, count(*) as drep_votes, median(v.vote_block_time - c.cc) as median_seconds_after_cc
from ds_gov_action_votes v
join (select gov_action_tx_hash, gov_action_index, max(vote_block_time) as cc
      from ds_cc_vote_details group by gov_action_tx_hash, gov_action_index) c
  on c.gov_action_tx_hash = v.gov_action_tx_hash and c.gov_action_index = v.gov_action_index
where v.voter_type in ({DREP}) group by v.action_epoch""")

K["p2_10_drep_metadata_completeness"] = over_datasets(["drep_epoch_stats"], f"""
select epoch, count(*) as dreps, {cnt('has_metadata')} as with_metadata,
  {pct(cnt('has_metadata'), 'count(*)')} as completeness_pct
from ds_drep_epoch_stats where drep_hash is not null group by epoch""")

K["p2_11_top100_volatility"] = over_datasets(["drep_epoch_stats"], f"""
select epoch, top_share,
  round(stddev_samp(top_share) over (order by epoch rows between 4 preceding and current row), 9) as top_share_stddev
from (select epoch,
        cast(sum(case when rn <= 100 then delegated_amount else 0 end) as double)
          / nullif(cast(sum(delegated_amount) as double), 0) as top_share
      from (select epoch, delegated_amount,
                   row_number() over (partition by epoch order by delegated_amount desc, drep_hash) as rn
            from ds_drep_epoch_stats where {ACTIVE}) r
      group by epoch) s""")

K["p2_12_voting_seasonality"] = over_datasets(["gov_action_lifecycle", "epoch_summary"], f"""
select p.year, p.month, p.actions, p.avg_turnout_pct,
  round(p.avg_turnout_pct - q.avg_turnout_pct, 6) as yoy_change_pct
from per p left join per q on q.year = p.year - 1 and q.month = p.month""", ctes=[f"""per as (
  select cast(year({_utc('block_time_proposed')}) as int) as year,
         cast(month({_utc('block_time_proposed')}) as int) as month,
         count(*) as actions, round(avg(tp), 6) as avg_turnout_pct
  from (select l.block_time_proposed,
          cast(l.drep_yes_vote_stake + l.drep_no_vote_stake + l.drep_abstain_vote_stake as double) * 100.0
            / nullif(cast(e.circulation as double), 0) as tp
        from ds_gov_action_lifecycle l join ds_epoch_summary e on e.epoch = l.epoch_proposed
        where l.drep_yes_vote_stake is not null) t
  group by 1, 2)"""])

# ------------------------------------------------------------------ P3 ---

# live pools: staked in the epoch, and no retirement as their newest event up to it
_LIVE = """live as (
  select epoch, pool_id, sum(amount) as ps from g_epoch_stake x
  where epoch in (select epoch from tgt) and pool_id is not null
    and coalesce((select l.status from g_pool l where l.pool_id = x.pool_id and l.epoch <= x.epoch
                  order by l.epoch desc, l.slot desc, l.tx_index desc, l.cert_index desc limit 1), '') <> 'RETIRED'
  group by epoch, pool_id)"""
_POOLS = f"""pf as (
  select epoch, pool_id, ps, exists (select 1 from g_voting_procedure v where v.voter_type = {SPO}
                                     and v.voter_hash = live.pool_id and v.epoch = live.epoch) as voted
  from live)"""
_POOL_TABLES = ["pool", "epoch_stake", "voting_procedure"]

K["p3_1_spo_turnout"] = over_datasets([], f"""
select epoch, count(*) as active_pools, {cnt('voted')} as voting_pools, cast(sum(ps) as bigint) as active_stake,
  cast(sum(case when voted then ps else 0 end) as bigint) as voting_stake,
  {pct(cnt('voted'), 'count(*)')} as turnout_pct,
  {pct('sum(case when voted then ps else 0 end)', 'sum(ps)')} as stake_turnout_pct
from pf group by epoch""", tables=_POOL_TABLES, ctes=[_LIVE, _POOLS])

K["p3_2_spo_silent_stake"] = over_datasets([], f"""
select epoch, cast(sum(ps) as bigint) as active_stake,
  cast(sum(case when not voted then ps else 0 end) as bigint) as silent_stake,
  {pct('sum(case when not voted then ps else 0 end)', 'sum(ps)')} as silent_stake_pct
from pf group by epoch""", tables=_POOL_TABLES, ctes=[_LIVE, _POOLS])

K["p3_3_default_stance_adoption"] = over_datasets(["pool_epoch_stats"], f"""
select epoch, count(*) as pools, {cnt("stance = 'ABSTAIN'")} as abstain_pools,
  {cnt("stance = 'NO_CONFIDENCE'")} as no_confidence_pools, {pct('count(stance)', 'count(*)')} as adoption_pct
from (select epoch, (select min(stance) from stance_of where who in
                       (select o.who from owner_of o where o.pool_id = live.pool_id)) as stance from live)
group by epoch""", tables=["pool", "epoch_stake"], ctes=[_LIVE])

K["p3_4_spo_vote_latency"] = _median_latency(SPO, "spo_votes")

K["p3_5_stake_concentration"] = over_datasets([], f"""
select g.epoch, g.n as entities, h.hhi, g.gini from (
{_gini_sql("(select epoch, cast(stake as bigint) as stake from per_e)", "epoch", "stake")}) g
join (select epoch, cast(sum(stake * stake) as double)
                    / (cast(sum(stake) as double) * cast(sum(stake) as double)) as hhi
      from per_e group by epoch) h on h.epoch = g.epoch""", tables=["epoch_stake"], ctes=["""per_e as (
  select epoch, pool_id as entity, sum(amount) as stake from g_epoch_stake
  where epoch in (select epoch from tgt) group by epoch, pool_id)"""])

K["p3_6_spo_vote_changes"] = _vote_changes(SPO)

K["p3_7_spo_drep_divergence"] = over_datasets(["gov_action_lifecycle"], """
select gov_action_tx_hash, gov_action_index, type, status, drep_approval_ratio, spo_approval_ratio,
  spo_approval_ratio - drep_approval_ratio as divergence
from ds_gov_action_lifecycle""")

# ------------------------------------------------------------------ P4 ---

K["p4_1_action_volume"] = over_datasets([], """
select strftime(block_time, '%Y-%m') as month, type, return_address, count(*) as actions
from g_gov_action_proposal group by strftime(block_time, '%Y-%m'), type, return_address""",
                                        tables=["gov_action_proposal"])

K["p4_2_contention"] = over_datasets(["gov_action_lifecycle"], f"""
select epoch_proposed as epoch, count(*) as actions,
  round(avg(y / nullif(y + n + a, 0)), 9) as avg_yes_share,
  round(avg(n / nullif(y + n + a, 0)), 9) as avg_no_share,
  round(avg(a / nullif(y + n + a, 0)), 9) as avg_abstain_share,
  {cnt('abs(y / nullif(y + n, 0) - 0.5) < 0.05')} as close_actions,
  {pct(cnt('abs(y / nullif(y + n, 0) - 0.5) < 0.05'), 'count(*)')} as close_share_pct
from (select epoch_proposed, cast(drep_yes_vote_stake as double) as y, cast(drep_no_vote_stake as double) as n,
             coalesce(cast(drep_abstain_vote_stake as double), 0.0) as a
      from ds_gov_action_lifecycle where drep_yes_vote_stake is not null) x
group by epoch_proposed""")

_TREASURY_YEARS = f"""ty as (
  select cast(year({_utc('epoch_end_time')}) as int) as year, delta
  from (select epoch, epoch_end_time, treasury - lag(treasury) over (order by epoch) as delta
        from ds_epoch_summary) d
  where delta is not null and epoch_end_time is not null)"""
_TREASURY = """tyr as (
  select year, cast(sum(case when delta > 0 then delta else 0 end) as bigint) as treasury_added,
         cast(sum(case when delta < 0 then -delta else 0 end) as bigint) as treasury_spent
  from ty group by year)"""

K["p4_3_treasury_balance_rate"] = over_datasets(["epoch_summary"], """
select year, treasury_added, treasury_spent,
  cast(treasury_spent as double) / nullif(cast(treasury_added as double), 0) as balance_rate
from tyr""", ctes=[_TREASURY_YEARS, _TREASURY])

K["p4_5_time_to_enactment"] = over_datasets(["gov_action_lifecycle", "epoch_summary"], """
select l.type, count(*) as enacted_actions,
  median(e.epoch_end_time - l.block_time_proposed) / 86400.0 as median_days_to_enactment
from ds_gov_action_lifecycle l join ds_epoch_summary e on e.epoch = l.epoch_resolved
where l.status = 'ENACTED' group by l.type""")

K["p4_6_treasury_vs_ncl"] = over_datasets(["epoch_summary"], f"""
select year, treasury_spent, cast(350000000000000 as bigint) as net_change_limit,
  {pct('treasury_spent', '350000000000000')} as spend_vs_ncl_pct
from tyr""", ctes=[_TREASURY_YEARS, _TREASURY])

K["p4_7_zero_cc_no"] = over_datasets(["gov_action_lifecycle"], f"""
select epoch_proposed as epoch, count(*) as actions, {cnt('cc_no = 0')} as zero_cc_no_actions,
  {pct(cnt('cc_no = 0'), 'count(*)')} as zero_cc_no_pct
from ds_gov_action_lifecycle where cc_no is not null group by epoch_proposed""")

K["p4_8_success_by_source"] = over_datasets(["gov_action_lifecycle"], f"""
select return_address, count(*) as submitted, {cnt("status in ('RATIFIED', 'ENACTED')")} as approved,
  {pct(cnt("status in ('RATIFIED', 'ENACTED')"), 'count(*)')} as success_rate_pct
from ds_gov_action_lifecycle group by return_address""")

K["p4_9_min_attack_vector"] = over_datasets(["drep_epoch_stats", "governance_params"], f"""
select n.epoch, cast(n.active_stake as bigint) as active_stake, n.threshold,
  (select min(r.rn) from r where r.epoch = n.epoch
     and cast(r.cum as double) >= n.threshold * cast(n.active_stake as double)) as min_actors
from (select s.epoch, sum(s.x) as active_stake, max(p.dvt_motion_no_confidence) as threshold
      from s left join ds_governance_params p on p.epoch = s.epoch group by s.epoch) n""", ctes=[
    f"""s as (select epoch, drep_hash, delegated_amount as x from ds_drep_epoch_stats
  where {ACTIVE})""",
    """r as (select epoch, x,
  sum(x) over (partition by epoch order by x desc, drep_hash rows between unbounded preceding and current row) as cum,
  row_number() over (partition by epoch order by x desc, drep_hash) as rn from s)"""])

# every pair (DReps, pools) that reaches both thresholds, and the smallest of them
_MOTIONS = ("motion_no_confidence", "committee_normal", "committee_no_confidence", "hard_fork_initiation")
K["p4_9_joint_attack_vector"] = over_datasets(["drep_epoch_stats", "governance_params"], """
select n.epoch, m.motion, n.drep_stake, n.dt as drep_threshold, n.pool_stake, n.pt as pool_threshold,
  (select min(a.rn) from rd a where a.epoch = n.epoch and cast(a.cum as double) >= n.dt * cast(n.drep_stake as double)) as min_dreps,
  (select min(b.rn) from rp b where b.epoch = n.epoch and cast(b.cum as double) >= n.pt * cast(n.pool_stake as double)) as min_pools,
  (select min(a.rn + b.rn) from rd a, rp b where a.epoch = n.epoch and b.epoch = n.epoch
     and cast(a.cum as double) >= n.dt * cast(n.drep_stake as double)
     and cast(b.cum as double) >= n.pt * cast(n.pool_stake as double)) as min_actors
from bodies n join (select unnest([""" + ", ".join(f"'{m}'" for m in _MOTIONS) + """]) as motion) m on n.motion = m.motion""",
                                              tables=["pool", "epoch_stake"], ctes=[
    f"""rd as (select epoch, sum(x) over (partition by epoch order by x desc, drep_hash rows unbounded preceding) as cum,
  row_number() over (partition by epoch order by x desc, drep_hash) as rn
  from (select epoch, drep_hash, delegated_amount as x from ds_drep_epoch_stats where {ACTIVE}))""",
    _LIVE,
    """rp as (select epoch, sum(ps) over (partition by epoch order by ps desc, pool_id rows unbounded preceding) as cum,
  row_number() over (partition by epoch order by ps desc, pool_id) as rn from live)""",
    """bodies as (select e.epoch, t.motion,
  (select cast(max(cum) as bigint) from rd where rd.epoch = e.epoch) as drep_stake, if((select count(*) from rd where rd.epoch = e.epoch) > 0, t.dt, null) as dt,
  (select cast(max(cum) as bigint) from rp where rp.epoch = e.epoch) as pool_stake, if((select count(*) from rp where rp.epoch = e.epoch) > 0, t.pt, null) as pt
  from (select epoch from rd union select epoch from rp) e left join (""" + " union all ".join(
        f"select epoch, '{m}' as motion, dvt_{m} as dt, pvt_{m} as pt from ds_governance_params" for m in _MOTIONS)
    + """) t on t.epoch = e.epoch)"""])

_DATED = """select valid_from, coalesce(valid_to, date '2100-01-01') as valid_to, annual_limit from limits"""
K["p4_6_treasury_vs_dated_ncl"] = over_datasets(["epoch_summary"], f"""
select year, treasury_spent, net_change_limit, {pct('treasury_spent', 'net_change_limit')} as spend_vs_ncl_pct
from (select year, treasury_spent,
    case when (select count(*) from days d where d.year = tyr.year and d.annual_limit is null) = 0 then
      (select cast(sum(d.annual_limit) // count(*) as bigint) from days d where d.year = tyr.year) end as net_change_limit
  from tyr)""", ctes=[_TREASURY_YEARS, _TREASURY, "limits as (@LIMITS@)", f"""days as (
  select year, day, (select l.annual_limit from ({_DATED}) l where l.valid_from <= day and day < l.valid_to) as annual_limit
  from (select tyr.year, unnest(generate_series(cast(make_date(tyr.year, 1, 1) as timestamp),
    cast(make_date(tyr.year, 12, 31) as timestamp), interval 1 day)) as day from tyr))"""])

# ------------------------------------------------------------------ P5 ---

K["p5_1_cc_time_to_decision"] = over_datasets(["cc_vote_details"], """
select action_epoch as epoch, count(*) as cc_votes,
  median(time_to_vote_seconds) / 86400.0 as median_days_to_vote
from ds_cc_vote_details group by action_epoch""")

_ACTIONS = "(select count(*) from (select distinct tx_hash, idx from g_gov_action_proposal))"
K["p5_2_cc_member_participation"] = over_datasets(["cc_vote_details"], f"""
select cold_key, hot_key, cast(n as bigint) as actions_voted, {_ACTIONS} as total_actions,
  {pct('n', _ACTIONS)} as participation_pct
from (
  select m.hash as cold_key, cast(null as varchar) as hot_key,
    (select count(distinct (c.gov_action_tx_hash, c.gov_action_index)) from ds_cc_vote_details c where c.cold_key = m.hash) as n
  from (select hash from g_committee_member where hash is not null
        union select cold_key from ds_cc_vote_details where cold_key is not null) m
  union all
  select null, voter_hash, count(distinct (gov_action_tx_hash, gov_action_index))
  from ds_cc_vote_details where cold_key is null group by voter_hash)""", tables=["gov_action_proposal", "committee_member"])

K["p5_3_cc_abstain_rate"] = over_datasets(["cc_vote_details"], f"""
select vote_epoch as epoch, count(*) as cc_votes, {cnt("vote = 'ABSTAIN'")} as abstain_votes,
  {pct(cnt("vote = 'ABSTAIN'"), 'count(*)')} as abstain_rate_pct
from ds_cc_vote_details group by vote_epoch""")

K["p5_4_cc_non_unanimous"] = over_datasets(["cc_vote_details"], f"""
select action_epoch as epoch, count(*) as actions, {cnt('k > 1')} as non_unanimous_actions,
  {pct(cnt('k > 1'), 'count(*)')} as non_unanimous_pct
from (select gov_action_tx_hash, gov_action_index, action_epoch, count(distinct vote) as k
      from ds_cc_vote_details group by gov_action_tx_hash, gov_action_index, action_epoch) a
group by action_epoch""")



def _limits() -> str:
    from ballotlens.registry import DATED_LIMITS
    return DATED_LIMITS.format(nation="nation")


KPIS = {**K, "p4_6_treasury_vs_dated_ncl": K["p4_6_treasury_vs_dated_ncl"].replace("@LIMITS@", _limits())}
