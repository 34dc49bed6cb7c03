"""Enumerations of the governance source tables.

Fixed values: these strings must equal what the chain exports carry.
"""

# --- fixed values: voter types -------------------------------------------
DREP_VOTER_TYPES = ("DREP_KEY_HASH", "DREP_SCRIPT_HASH")
SPO_VOTER_TYPE = "STAKING_POOL_KEY_HASH"
CC_VOTER_TYPES = ("CONSTITUTIONAL_COMMITTEE_HOT_KEY_HASH",
                  "CONSTITUTIONAL_COMMITTEE_HOT_SCRIPT_HASH")

# --- fixed values: votes ---------------------------------------------------
VOTE_YES, VOTE_NO, VOTE_ABSTAIN = "YES", "NO", "ABSTAIN"

# --- fixed values: DRep types in drep_dist / delegation_vote ---------------
DREP_ABSTAIN = "ABSTAIN"
DREP_NO_CONFIDENCE = "NO_CONFIDENCE"
DEFAULT_DREP_TYPES = (DREP_ABSTAIN, DREP_NO_CONFIDENCE)

# --- fixed values: governance action statuses ------------------------------
STATUS_ACTIVE = "ACTIVE"
STATUS_RATIFIED = "RATIFIED"
STATUS_EXPIRED = "EXPIRED"
STATUS_ENACTED = "ENACTED"
STATUS_DROPPED = "DROPPED"
TERMINAL_STATUSES = (STATUS_RATIFIED, STATUS_EXPIRED, STATUS_ENACTED, STATUS_DROPPED)
APPROVED_STATUSES = (STATUS_RATIFIED, STATUS_ENACTED)

# --- fixed values: governance action types ---------------------------------
TREASURY_WITHDRAWALS_ACTION = "TREASURY_WITHDRAWALS_ACTION"

# --- fixed values: DRep certificate types ----------------------------------
REG_DREP_CERT = "REG_DREP_CERT"
UNREG_DREP_CERT = "UNREG_DREP_CERT"

# --- fixed values: DRep and pool statuses ----------------------------------
DREP_RETIRED = "RETIRED"
POOL_RETIRED = "RETIRED"

# --- fixed values: voting_stats keys (flat JSON) and their output types ----
VOTING_STATS_FIELDS = (
    ("cc_yes", "int"),
    ("cc_no", "int"),
    ("cc_abstain", "int"),
    ("cc_do_not_vote", "int"),
    ("cc_approval_ratio", "double"),
    ("drep_yes_vote_stake", "bigint"),
    ("drep_no_vote_stake", "bigint"),
    ("drep_abstain_vote_stake", "bigint"),
    ("drep_no_confidence_stake", "bigint"),
    ("drep_auto_abstain_stake", "bigint"),
    ("drep_do_not_vote_stake", "bigint"),
    ("drep_total_yes_stake", "bigint"),
    ("drep_total_no_stake", "bigint"),
    ("drep_total_abstain_stake", "bigint"),
    ("drep_approval_ratio", "double"),
    ("spo_yes_vote_stake", "bigint"),
    ("spo_no_vote_stake", "bigint"),
    ("spo_abstain_vote_stake", "bigint"),
    ("spo_do_not_vote_stake", "bigint"),
    ("spo_total_yes_stake", "bigint"),
    ("spo_total_no_stake", "bigint"),
    ("spo_total_abstain_stake", "bigint"),
    ("spo_approval_ratio", "double"),
)

# --- fixed values: protocol parameter scalars (params JSON) ----------------
PARAM_SCALARS = (
    ("drep_deposit", "bigint"),
    ("gov_action_deposit", "bigint"),
    ("drep_activity", "int"),
    ("gov_action_lifetime", "int"),
    ("committee_min_size", "int"),
    ("committee_max_term_length", "int"),
)

# --- fixed values: voting thresholds (JSON key, output column) -------------
POOL_THRESHOLDS = (
    ("pvt_motion_no_confidence", "pvt_motion_no_confidence"),
    ("pvt_committee_normal", "pvt_committee_normal"),
    ("pvt_committee_no_confidence", "pvt_committee_no_confidence"),
    ("pvt_hard_fork_initiation", "pvt_hard_fork_initiation"),
    ("pvt_ppsecurity_group", "pvt_pp_security_group"),
)
DREP_THRESHOLDS = (
    ("dvt_motion_no_confidence", "dvt_motion_no_confidence"),
    ("dvt_committee_normal", "dvt_committee_normal"),
    ("dvt_committee_no_confidence", "dvt_committee_no_confidence"),
    ("dvt_update_to_constitution", "dvt_update_to_constitution"),
    ("dvt_hard_fork_initiation", "dvt_hard_fork_initiation"),
    ("dvt_ppnetwork_group", "dvt_pp_network_group"),
    ("dvt_ppeconomic_group", "dvt_pp_economic_group"),
    ("dvt_pptechnical_group", "dvt_pp_technical_group"),
    ("dvt_ppgov_group", "dvt_pp_gov_group"),
    ("dvt_treasury_withdrawal", "dvt_treasury_withdrawal"),
)
