"""Governance source tables derived from the driver's test tables.

The chain exports are not part of the test data, so each governance table is
one projection of a driver table (FIXTURES.md §2). The projections are kept as
SQL expression text so that the *same* text builds the Spark DataFrames
(``selectExpr``) and the DuckDB oracle's CTEs: both sides of a correctness
check start from identical inputs, and only the operator under test differs.

On a cluster the real exports are read with :mod:`ballotlens.sources.catalog`
instead; nothing downstream depends on how a table was produced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlens import constants as C

# --- expression helpers (FIXTURES.md shorthand, expanded) -------------------


def _epoch(c: str) -> str:
    """One epoch per calendar quarter, 1995Q1 = 500."""
    return (f"cast(500+(cast(extract(year from {c}) as int)-1995)*4"
            f"+cast(extract(quarter from {c}) as int)-1 as int)")


def _day(c: str) -> str:
    return f"(cast(extract(year from {c}) as bigint)*366+cast(extract(doy from {c}) as bigint))"


def _div_int(x: str, n: int) -> str:
    # floor before the int cast: DuckDB rounds a double->int cast, Spark truncates
    return f"cast(floor(({x})/{n}) as int)"


_ACTION_TYPE = (
    f"case {_div_int('o_orderkey', 50)}%7 when 0 then 'PARAMETER_CHANGE_ACTION' "
    "when 1 then 'HARD_FORK_INITIATION_ACTION' when 2 then 'TREASURY_WITHDRAWALS_ACTION' "
    "when 3 then 'NO_CONFIDENCE' when 4 then 'UPDATE_COMMITTEE' "
    "when 5 then 'NEW_CONSTITUTION' else 'INFO_ACTION' end")


def _json_object(pairs: list[tuple[str, str]]) -> str:
    """concat(...) text producing a JSON object; values are SQL expressions
    that render as JSON scalars (numbers, or the text 'null')."""
    parts: list[str] = []
    for i, (key, value) in enumerate(pairs):
        sep = "," if i else ""
        parts.append(f"'{sep}\"{key}\":'")
        parts.append(value)
    return "concat('{'," + ",".join(parts) + ",'}')"


def _voting_stats() -> str:
    """One value per key of the voting stats: ratios, small counts, and for
    stakes a base amount plus the key's place, so that no two are alike."""
    ok, action = "o_orderkey", _div_int("o_orderkey", 50)
    values = {"cc_yes": f"{ok}%8", "cc_no": f"{action}%3", "cc_abstain": "k", "cc_do_not_vote": "4-k",
              "cc_approval_ratio": f"concat('0.',100+{ok}%899)", "drep_approval_ratio": f"concat('0.',100+{action}%811)",
              "spo_approval_ratio": f"concat('0.',100+{action}%613)",
              "drep_yes_vote_stake": f"1000000000000+{ok}*1000003+k", "drep_no_vote_stake": f"300000000000+{ok}*7919",
              "drep_abstain_vote_stake": f"case when {ok}%550=0 then 'null' else '50000000000' end"}
    pairs = [(key, values.get(key, f"{place}000000000+{ok}")) for place, (key, _) in enumerate(C.VOTING_STATS_FIELDS, 1)]
    return (f"case when {ok}%350=0 then null when {ok}%850=0 then '{{\"cc_yes\": 1, broken' "
            f"else {_json_object(pairs)} end")


def _params() -> str:
    def ratio(i: int) -> str:
        return _json_object([
            ("numerator", f"51+(epoch+{i})%40"),
            ("denominator", f"case when (epoch+{i})%17=0 then 0 else 100 end"),
        ])

    pvt = _json_object([(key, ratio(i)) for i, (key, _) in enumerate(C.POOL_THRESHOLDS)])
    dvt = _json_object([(key, ratio(i)) for i, (key, _) in enumerate(C.DREP_THRESHOLDS)])
    return _json_object([
        ("drep_deposit", "500000000+epoch"),
        ("gov_action_deposit", "100000000000"),
        ("drep_activity", "20"),
        ("gov_action_lifetime", "6"),
        ("committee_max_term_length", "146"),
        ("committee_min_size", "case when epoch%5=0 then 'null' else '7' end"),
        ("pool_voting_thresholds", pvt),
        ("drep_voting_thresholds", dvt),
    ])


# --- table specs ------------------------------------------------------------


@dataclass(frozen=True)
class Derivation:
    source: str                      # driver table
    columns: tuple                   # (name, type, expression)
    where: str | None = None
    expand: str | None = None        # K (k=1..4) | J (j=0..2) | EPOCHS | EPOCHS_GOV
    group_by: str | None = None      # expression (adapot only)
    notes: str = field(default="")


# One governance action per 50 successive order keys, aggregated over their
# orders: (key, aggregate) of the grouped source "orders50".
ORDERS50_KEY = _div_int("o_orderkey", 50)
ORDERS50 = (
    ("o_orderkey", f"cast({ORDERS50_KEY} as bigint)*50"),
    ("o_orderdate", "max_by(o_orderdate, (o_orderkey*7)%50)"),
    ("o_custkey", "min(o_custkey)"),
    ("n_orders", "count(*)"),
)
_DREP_SET = "(j=0 or (j=1 and c_custkey%3=0) or (j=2 and c_custkey%4=0))"
GOV_START_EPOCH_FIXTURE = 502

DERIVATIONS: dict[str, Derivation] = {
    "gov_action_proposal": Derivation("orders50", (
        ("tx_hash", "string", "concat('ga',o_orderkey)"),
        ("idx", "int", f"{_div_int('o_orderkey', 50)}%2"),
        ("type", "string", _ACTION_TYPE),
        ("deposit", "bigint", "100000000000+n_orders"),
        ("return_address", "string", "concat('stake',o_custkey%20)"),
        ("anchor_url", "string", "case when o_orderkey%4=0 then concat('u',o_orderkey) end"),
        ("epoch", "int", _epoch("o_orderdate")),
        ("slot", "bigint", f"{_day('o_orderdate')}*86400+o_orderkey"),
        ("block_time", "timestamp", "o_orderdate"),
    )),
    # every sixth action has no status: its rows name an unknown one
    "gov_action_proposal_status": Derivation("orders50", (
        ("gov_action_tx_hash", "string", "concat(case when o_orderkey%300=0 then 'none' else 'ga' end,o_orderkey)"),
        ("gov_action_index", "int", f"{_div_int('o_orderkey', 50)}%2"),
        ("type", "string", _ACTION_TYPE),
        ("status", "string",
         f"case when k<4 then 'ACTIVE' else case {_div_int('o_orderkey', 50)}%5 "
         "when 0 then 'RATIFIED' when 1 then 'EXPIRED' when 2 then 'ENACTED' "
         "when 3 then 'DROPPED' else 'ACTIVE' end end"),
        ("voting_stats", "string", _voting_stats()),
        ("epoch", "int", f"{_epoch('o_orderdate')}+k-1"),
    ), expand="K"),
    "voting_procedure": Derivation("lineitem", (
        ("tx_hash", "string", "concat('v',l_orderkey,'-',l_linenumber,'-',l_partkey)"),
        ("idx", "int", "l_linenumber"),
        ("tx_index", "int", "l_partkey"),
        ("voter_type", "string",
         "case when l_linenumber<=3 then 'DREP_KEY_HASH' when l_linenumber=4 then 'DREP_SCRIPT_HASH' "
         "when l_linenumber<=6 then 'STAKING_POOL_KEY_HASH' "
         "when l_partkey%2=0 then 'CONSTITUTIONAL_COMMITTEE_HOT_KEY_HASH' "
         "else 'CONSTITUTIONAL_COMMITTEE_HOT_SCRIPT_HASH' end"),
        ("voter_hash", "string",
         "case when l_linenumber<=4 then concat('d',(l_partkey%300)*5) "
         "when l_linenumber<=6 then concat('p',l_suppkey) else concat('hot',l_suppkey%7) end"),
        # votes on one action in 21 name an unknown one
        ("gov_action_tx_hash", "string", f"concat(case when {_div_int('l_orderkey', 50)}%21=0 then 'lost' else 'ga' end,"
                                         "l_orderkey-l_orderkey%50)"),
        ("gov_action_index", "int", f"{_div_int('(l_orderkey-l_orderkey%50)', 50)}%2"),
        ("vote", "string", "case l_returnflag when 'N' then 'YES' when 'R' then 'NO' else 'ABSTAIN' end"),
        ("anchor_url", "string", "case when l_linestatus='F' then concat('u',l_orderkey) end"),
        ("epoch", "int", _epoch("l_shipdate")),
        ("slot", "bigint", f"{_day('l_shipdate')}*86400+l_linenumber*1000+l_partkey%1000"),
        ("block_time", "timestamp", "l_shipdate"),
    )),
    "drep": Derivation("customer", (
        ("drep_hash", "string", "concat(case when c_custkey<=5 then 'x' else 'd' end,c_custkey)"),
        ("status", "string", "case j when 0 then 'REGISTERED' when 1 then 'UPDATED' else 'RETIRED' end"),
        ("epoch", "int", "500+c_custkey%10+j*8"),
        ("slot", "bigint", "(500+c_custkey%10+j*8)*432000+c_custkey%1000"),
        ("tx_index", "int", "c_custkey%9"),
        ("cert_index", "int", "j"),
    ), where=_DREP_SET, expand="J"),
    "drep_registration": Derivation("customer", (
        ("type", "string",
         "case j when 0 then 'REG_DREP_CERT' when 1 then 'UPDATE_DREP_CERT' else 'UNREG_DREP_CERT' end"),
        ("drep_hash", "string", "concat(case when c_custkey<=10 then 'x' else 'd' end,c_custkey)"),
        ("anchor_url", "string", "case when j<2 and (c_custkey+j)%2=0 then concat('m',c_custkey) end"),
        ("epoch", "int", "500+c_custkey%10+j*8"),
        ("slot", "bigint", "(500+c_custkey%10+j*8)*432000+c_custkey%1000"),
        ("tx_index", "int", "c_custkey%9"),
        ("cert_index", "int", "j"),
        ("block_time", "timestamp", "case c_custkey%4 when 0 then timestamp '2024-01-01 00:00:00' "
         "when 1 then timestamp '2024-02-29 23:59:59' when 2 then timestamp '2024-07-15 12:00:00' "
         "else timestamp '2023-12-31 23:59:59' end"),
    ), where=_DREP_SET, expand="J"),
    "drep_dist": Derivation("customer", (
        ("drep_hash", "string", "case when c_custkey in (0,5) then null else concat('d',c_custkey) end"),
        ("drep_type", "string",
         "case when c_custkey=0 then 'ABSTAIN' when c_custkey=5 then 'NO_CONFIDENCE' "
         "when c_custkey%3=0 then 'SCRIPTHASH' else 'ADDR_KEYHASH' end"),
        ("drep_id", "string", "concat('drep1',c_custkey)"),
        ("amount", "bigint", "cast(floor(abs(c_acctbal)*1000000) as bigint)+epoch*1000"),
        ("epoch", "int", "epoch"),
        ("active_until", "int", "case when c_custkey<=5 then null else epoch+c_custkey%7-2 end"),
        ("expiry", "int", "case when c_custkey<=5 then null else epoch+c_custkey%7+18 end"),
    ), expand="EPOCHS_GOV"),
    "delegation_vote": Derivation("events", (
        ("tx_hash", "string", "concat('e',event_id)"),
        ("cert_index", "int", "0"),
        ("tx_index", "int", "event_id%11"),
        ("address", "string", "concat('stake',user_id)"),
        ("drep_hash", "string",
         "case event_type when 'error' then null when 'signup' then null "
         "else concat('d',(event_id%4)*5+10) end"),
        ("drep_id", "string",
         "case event_type when 'error' then null when 'signup' then null "
         "else concat('drep1',(event_id%4)*5+10) end"),
        ("drep_type", "string",
         "case event_type when 'error' then 'ABSTAIN' when 'signup' then 'NO_CONFIDENCE' "
         "when 'view' then 'SCRIPTHASH' else 'ADDR_KEYHASH' end"),
        ("epoch", "int", "499+cast(extract(day from ts) as int)"),
        ("credential", "string", "concat('cred',user_id)"),
        ("slot", "bigint", "event_id*20"),
        ("block_time", "timestamp", "ts"),
    )),
    "committee": Derivation("nation", (
        ("threshold", "double", "case n_nationkey when 0 then 0.6 else 0.67 end"),
        ("epoch", "int", "500+n_nationkey*10"),
        ("slot", "bigint", "n_nationkey"),
    )),
    "committee_member": Derivation("nation", (
        ("hash", "string", "concat('cold',n_nationkey%7)"),
        ("start_epoch", "int", "500+n_nationkey"),
        ("expired_epoch", "int", "case when n_nationkey%3=0 then null else 510+n_nationkey end"),
        ("epoch", "int", "500+n_nationkey"),
        ("slot", "bigint", "n_nationkey"),
    )),
    "committee_registration": Derivation("nation", (
        ("cold_key", "string", "concat('cold',n_nationkey)"),
        ("hot_key", "string", "concat('hot',n_nationkey%5)"),
        ("epoch", "int", "500+n_nationkey"),
        ("slot", "bigint", "n_nationkey*10"),
        ("tx_index", "int", "0"),
        ("cert_index", "int", "0"),
    )),
    "epoch_param": Derivation("EPOCHS", (
        ("epoch", "int", "epoch"),
        ("params", "string", _params()),
    )),
    "adapot": Derivation("orders", (
        ("epoch", "int", _epoch("o_orderdate")),
        ("treasury", "decimal(38,0)", "sum(cast(floor(o_totalprice*100) as bigint))"),
        ("reserves", "decimal(38,0)", "sum(cast(floor(o_totalprice*70) as bigint))"),
        ("circulation", "decimal(38,0)", "sum(cast(floor(o_totalprice*90000) as bigint))"),
        ("utxo", "decimal(38,0)", "sum(cast(floor(o_totalprice*80000) as bigint))"),
        ("fees", "decimal(38,0)", "count(*)"),
    ), group_by=_epoch("o_orderdate")),
    "epoch_stake": Derivation("customer", (
        ("epoch", "int", "epoch"),
        ("address", "string", "concat('stake',c_custkey)"),
        ("amount", "decimal(38,0)", "cast(floor(abs(c_acctbal)*1000000) as bigint)+epoch"),
        ("pool_id", "string", "concat('p',c_custkey%40)"),
    ), expand="EPOCHS"),
    # four lifecycle events per pool, in different epochs
    "pool": Derivation("supplier", (
        ("pool_id", "string", "concat('p',s_suppkey)"),
        ("status", "string",
         "case (s_suppkey+k)%4 when 0 then 'REGISTRATION' "
         "when 1 then 'UPDATE' when 2 then 'RETIRING' else 'RETIRED' end"),
        ("amount", "decimal(38,0)", "cast(floor(abs(s_acctbal)*1000000) as bigint)"),
        ("epoch", "int", "500+(s_suppkey*5+k*7)%28"),
        ("slot", "bigint", "(500+(s_suppkey*5+k*7)%28)*432000+s_suppkey"),
        ("tx_index", "int", "0"),
        ("cert_index", "int", "0"),
    ), expand="K"),
    "pool_registration": Derivation("supplier", (
        ("pool_id", "string", "concat('p',s_suppkey)"),
        ("pool_owners", "string",
         "case when s_suppkey%10=9 then '[]' when s_suppkey%13=0 then 'no list' else "
         "concat('[\"cred',s_suppkey+j,'\", \"cred',s_suppkey+7,'\"]') end"),
        ("epoch", "int", "500+j*6"),
        ("slot", "bigint", "(500+j*6)*432000+s_suppkey"),
        ("tx_index", "int", "0"),
        ("cert_index", "int", "j"),
    ), where="j<2", expand="J"),
    "block": Derivation("orders", (
        ("hash", "string", "concat('b',o_orderkey)"),
        ("number", "bigint", "o_orderkey"),
        ("epoch", "int", _epoch("o_orderdate")),
        ("slot", "bigint", f"{_day('o_orderdate')}*86400+o_orderkey"),
        ("block_time", "timestamp", "o_orderdate"),
    )),
    "transaction": Derivation("lineitem", (
        ("tx_hash", "string", "concat('t',l_orderkey,'-',l_linenumber,'-',l_partkey)"),
        ("epoch", "int", _epoch("l_shipdate")),
    )),
    "stake_registration": Derivation("customer", (
        ("tx_hash", "string", "concat('r',c_custkey)"),
        ("type", "string", "'STAKE_REGISTRATION'"),
        ("address", "string", "concat('stake',c_custkey)"),
        ("credential", "string", "concat('cred',c_custkey)"),
        ("epoch", "int", "500+c_custkey%28"),
        ("slot", "bigint", "(500+c_custkey%28)*432000+c_custkey"),
    )),
}

GOV_TABLES = tuple(DERIVATIONS)
EPOCHS_SQL = f"select distinct {_epoch('o_orderdate')} as epoch from orders"


def _col_sql(name: str, typ: str, expr: str) -> str:
    return f"cast({expr} as {typ}) as {name}"


# --- Spark side -------------------------------------------------------------


def _expand_values(kind: str) -> tuple[str, list[int]]:
    return {"K": ("k", [1, 2, 3, 4]), "J": ("j", [0, 1, 2])}[kind]


def derive_spark(spark: SparkSession, sf_dir: str, name: str, read=None) -> DataFrame:
    """Lazily derive governance table ``name`` from the driver tables
    (``read(table) -> DataFrame`` may memoise the driver-table reads)."""
    spec = DERIVATIONS[name]
    read = read or (lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
    if spec.source == "EPOCHS":
        src = read("orders").selectExpr(f"{_epoch('o_orderdate')} as epoch").distinct()
    elif spec.source == "orders50":
        key, *aggs = ORDERS50
        src = read("orders").groupBy(F.expr(key[1]).alias(key[0])).agg(*[F.expr(e).alias(n) for n, e in aggs])
    else:
        src = read(spec.source)
    if spec.expand in ("K", "J"):
        col, values = _expand_values(spec.expand)
        # row multiplication of the spec: a fixed-length array, no join
        src = src.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))
    elif spec.expand in ("EPOCHS", "EPOCHS_GOV"):
        epochs = read("orders").selectExpr(f"{_epoch('o_orderdate')} as epoch").distinct()
        if spec.expand == "EPOCHS_GOV":
            epochs = epochs.filter(F.col("epoch") >= GOV_START_EPOCH_FIXTURE)
        # snapshot table: every entity in every epoch, one per calendar quarter
        # of the order dates (<= 28): an array that each row is exploded over
        # the rows are dealt to as many tasks as a shuffle has before they multiply: a
        # row group of the driver table would else become a whole snapshot table in one task
        src = src.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        src = src.withColumn("epoch", F.explode(epochs.agg(F.sort_array(F.collect_set("epoch"))).scalar()))
    if spec.where:
        src = src.filter(F.expr(spec.where))
    if spec.group_by:
        key, *aggs = spec.columns
        return (src.groupBy(F.expr(spec.group_by).alias(key[0]))
                .agg(*[F.expr(f"cast({e} as {t})").alias(n) for n, t, e in aggs])
                .select(F.col(key[0]).cast(key[1]).alias(key[0]), *[n for n, _, _ in aggs]))
    return src.selectExpr(*[_col_sql(*c) for c in spec.columns])


# --- DuckDB side (oracle text) ----------------------------------------------


def derive_duckdb_sql(name: str) -> str:
    spec = DERIVATIONS[name]
    cols = ", ".join(_col_sql(*c) for c in spec.columns)
    if spec.source == "EPOCHS":
        frm = "g_epochs"
    elif spec.source == "orders50":
        frm = "(select " + ", ".join(f"{e} as {n}" for n, e in ORDERS50) + f" from orders group by {ORDERS50[0][1]}) o"
    else:
        frm = spec.source
    if spec.expand in ("K", "J"):
        col, values = _expand_values(spec.expand)
        frm += " cross join (values " + ", ".join(f"({v})" for v in values) + f") f({col})"
    elif spec.expand == "EPOCHS":
        frm += " cross join g_epochs e"
    elif spec.expand == "EPOCHS_GOV":
        frm += f" cross join (select epoch from g_epochs where epoch >= {GOV_START_EPOCH_FIXTURE}) e"
    sql = f"select {cols} from {frm}"
    if spec.where:
        sql += f" where {spec.where}"
    if spec.group_by:
        sql += f" group by {spec.group_by}"
    return sql


def duckdb_with(tables: list[str] | tuple[str, ...], body: str, extra_ctes=()) -> str:
    """Prefix ``body`` with CTEs ``g_<table>`` for the governance tables it
    reads, followed by ``extra_ctes`` (``name as (...)`` texts)."""
    ctes = []
    needs_epochs = any(DERIVATIONS[t].source == "EPOCHS" or
                       (DERIVATIONS[t].expand or "").startswith("EPOCHS") for t in tables)
    if needs_epochs:
        ctes.append(f"g_epochs as ({EPOCHS_SQL})")
    for t in tables:
        ctes.append(f"g_{t} as ({derive_duckdb_sql(t)})")
    ctes.extend(extra_ctes)
    return "with " + ",\n".join(ctes) + "\n" + body
