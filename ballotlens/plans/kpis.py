"""KPI views over the datasets (K1.x as implemented views, DOC ad-hoc
queries, and the KPIs the docs specify, P1.4-P5.4).

Every KPI is a function of a :class:`Datasets` accessor (and, for a few, the
source :class:`Tables`) returning a lazy DataFrame. Ratios are computed on
doubles with ``nullif`` denominators; sums that feed a ratio stay exact
(integer/decimal) until one final division, so results do not depend on the
order rows are summed in. Windows that would put one key's rows in one task
(lag per address, rank per epoch) use :mod:`ballotlens.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlens import constants as C
from ballotlens.functions import pct, ratio
from ballotlens.operators.latest import asof_latest
from ballotlens.operators.ordered import cumulative_histogram, lag_within, sum_after
from ballotlens.operators.quantiles import count_and_median
from ballotlens.plans import datasets as D
from ballotlens.sources.tables import Tables

# Parameters the docs leave open (defaults documented in README).
ACTIVITY_MIN_SHARE = 0.5        # P2.2: X
TOP_N_DREPS = 10                # P2.5: N
VOLATILITY_WINDOW = 5           # P2.11: W
OUTFLOW_EPOCHS = 2              # P1.7: Z
CLOSE_MARGIN = 0.05             # P4.2: "close" = within this of 0.5
NEW_WALLET_WINDOW = 0           # P1.6: delegation within this many epochs of registration
NCL_LOVELACE = 350_000_000_000_000  # P4.6: net change limit per calendar year
ATTACK_THRESHOLD = "dvt_motion_no_confidence"  # P4.9
JOINT_MOTIONS = ("motion_no_confidence", "committee_normal", "committee_no_confidence",
                 "hard_fork_initiation")  # P4.9: motions in which DReps (dvt_*) and pools (pvt_*) both vote


class Datasets:
    """Lazy accessor ``name -> DataFrame`` for the eight datasets, either
    computed from source tables or read from a catalog of written outputs."""

    def __init__(self, get: Callable[[str], DataFrame], tables: Tables | None = None,
                 epochs: list[int] | None = None):
        self._get = get
        self._cache: dict[str, DataFrame] = {}
        self._tables = tables
        self._written = False           # datasets are read, not computed
        self._epochs = epochs

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("tables", "epochs"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._get(name)
        return self._cache[name]

    @property
    def tables(self) -> Tables:
        """Source tables (for KPIs that read them directly)."""
        if self._tables is None:
            raise KeyError("source tables not provided")
        return self._tables

    @property
    def epochs(self) -> list[int]:
        """Target epochs of the run, planned once (bounded list)."""
        if self._epochs is None:
            self._epochs = D.plan_epochs(self.tables)
        return self._epochs

    def spark_epochs(self) -> DataFrame:
        """The target epochs as a frame (one row each)."""
        spark = self.gov_action_lifecycle.sparkSession
        return spark.range(1).select(F.explode(F.array(*[F.lit(int(e)) for e in self.epochs])).alias("epoch"))

    @property
    def _from_source(self) -> bool:
        """Whether datasets are computed from source tables, so that a KPI may
        take a lighter path than the whole dataset."""
        return self._tables is not None and not self._written

    def drep_statuses(self) -> DataFrame:
        """(epoch, drep_hash, status) of every DRep snapshot row."""
        return self.drep_snapshots().select("epoch", "drep_hash", "status")

    def drep_snapshots(self) -> DataFrame:
        """The columns of ``drep_epoch_stats`` that weigh DReps, without its vote
        counts and registration facts: one as-of lookup on the snapshots."""
        if not self._from_source:
            return self.drep_epoch_stats
        return D.drep_asof_status(self.tables, self.epochs).select(
            F.col("epoch").cast("int").alias("epoch"), "drep_hash", "drep_type",
            F.col("amount").cast("long").alias("delegated_amount"), F.col("active_until").cast("int").alias("active_until"), "status")

    def drep_amounts(self) -> DataFrame:
        """(epoch, drep_hash, drep_type, delegated_amount): no status lookup."""
        if not self._from_source:
            return self.drep_epoch_stats
        return D.in_epochs(self.tables.drep_dist, self.epochs).select(
            F.col("epoch").cast("int").alias("epoch"), "drep_hash", "drep_type", F.col("amount").cast("long").alias("delegated_amount"))

    def enactments(self) -> DataFrame:
        """(type, epoch_resolved, block_time_proposed) of enacted actions."""
        if not self._from_source:
            return self.gov_action_lifecycle.filter(F.col("status") == C.STATUS_ENACTED)
        r = D.latest_action_status(self.tables).filter(F.col("status") == C.STATUS_ENACTED).select(
            F.col("gov_action_tx_hash").alias("tx_hash"), F.col("gov_action_index").alias("idx"), "epoch_resolved")
        return D.in_epochs(self.tables.gov_action_proposal, self.epochs).join(r, ["tx_hash", "idx"]).select(
            "type", "epoch_resolved", D.epoch_seconds("block_time").alias("block_time_proposed"))

    def epoch_ends(self) -> DataFrame:
        """(epoch, epoch_end_time), one row per epoch."""
        if not self._from_source:
            return self.epoch_summary.select("epoch", "epoch_end_time")
        times = D.epoch_times(self.tables, self.epochs).select("epoch", "epoch_end_time")
        return D.in_epochs(self.tables.adapot, self.epochs).select("epoch").join(F.broadcast(times), "epoch", "left")

    @classmethod
    def from_tables(cls, t: Tables, epochs: list[int] | None = None) -> "Datasets":
        ds = cls(lambda n: D.DATASETS[n](t, ds.epochs), t, epochs)
        return ds

    @classmethod
    def from_outputs(cls, spark: SparkSession, out_dir: str, tables: Tables | None = None) -> "Datasets":
        """Datasets as written by ``extract_all`` (the lineage cut a production
        run uses: KPIs read persisted tables instead of recomputing them).
        ``tables`` is only needed by KPIs that also read source tables."""
        from ballotlens.plans.job import read_dataset
        from ballotlens.sources.sinks import written_epochs
        epochs = written_epochs(spark, f"{out_dir}/epoch_summary") or None
        ds = cls(lambda n: read_dataset(spark, out_dir, n), tables, epochs)
        ds._written = True
        return ds


def _inactive() -> Column:
    """K1.8's rule: retired, or not heard of since ``active_until``."""
    return F.coalesce((F.col("status") == C.DREP_RETIRED) | (F.col("epoch") > F.col("active_until")), F.lit(False))


def _dreps_active(df: DataFrame) -> DataFrame:
    """DReps proper (no default stance) that are active in the row's epoch."""
    return df.filter(F.col("drep_hash").isNotNull() & ~F.col("drep_type").isin(*C.DEFAULT_DREP_TYPES) & ~_inactive())


# ================================================================ K1 =======

def k1_1_voting_turnout(ds: Datasets) -> DataFrame:
    """Per proposal epoch: actions with DRep stake data, their average
    participating stake (yes+no+abstain) and its share of circulation."""
    life = ds.gov_action_lifecycle.filter(F.col("drep_yes_vote_stake").isNotNull())
    stake = F.col("drep_yes_vote_stake") + F.col("drep_no_vote_stake") + F.col("drep_abstain_vote_stake")
    # aggregate first (one row per epoch), then attach circulation: bounded broadcast
    per_epoch = life.groupBy(F.col("epoch_proposed").alias("epoch")).agg(
        F.count(F.lit(1)).alias("actions_count"), F.avg(stake).alias("avg_participating_stake"))
    circ = ds.epoch_summary.select("epoch", "circulation")
    return per_epoch.join(F.broadcast(circ), "epoch", "inner").select(
        "epoch", "actions_count", "avg_participating_stake", "circulation",
        pct("avg_participating_stake", "circulation").alias("turnout_pct"))


def k1_2_active_stake_participation(ds: Datasets) -> DataFrame:
    """Per epoch: distinct delegating addresses, first-time ones, running total."""
    ev = ds.delegation_events
    per_epoch = ev.groupBy("epoch").agg(F.count_distinct("address").alias("active_addresses"))
    first = ev.groupBy("address").agg(F.min("epoch").alias("epoch"))
    new = first.groupBy("epoch").agg(F.count(F.lit(1)).alias("new_addresses"))
    # one row per epoch: a single ordered window over it is bounded
    w = Window.orderBy("epoch").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (per_epoch.join(new, "epoch", "left")
            .withColumn("new_addresses", F.coalesce("new_addresses", F.lit(0)))
            .withColumn("cumulative_unique_addresses", F.sum("new_addresses").over(w).cast("long")))


def k1_3_delegation_rate(ds: Datasets) -> DataFrame:
    s = ds.epoch_summary
    return s.select("epoch", "total_drep_delegated", "circulation",
                    pct("total_drep_delegated", "circulation").alias("delegation_rate_pct"))


def churn_rows(ds: Datasets) -> DataFrame:
    """Delegations that change the address's previous DRep (hash or type).
    SQL three-valued logic is kept: a NULL hash only counts when the type
    changes, and the first delegation of an address never counts. Delegations
    of one slot are ordered by what they delegate to, so the result does not
    depend on the order rows are read in."""
    events = ds.delegation_events
    order = [c for c in ("slot", "epoch", "drep_type", "drep_hash", "drep_id", "credential") if c in events.columns]
    ev = lag_within(events, "address", order, ["drep_hash", "drep_type"])
    changed = ((F.col("drep_hash") != F.col("prev_drep_hash"))
               | (F.col("drep_type") != F.col("prev_drep_type")))
    return ev.filter(F.col("prev_drep_hash").isNotNull() & changed)


def k1_5_delegation_churn(ds: Datasets) -> DataFrame:
    return (churn_rows(ds).groupBy("epoch")
            .agg(F.count(F.lit(1)).alias("delegation_changes"),
                 F.count_distinct("address").alias("addresses_changed")))


def k1_8_inactive_delegated_ada(ds: Datasets) -> DataFrame:
    s = ds.drep_snapshots()
    return (s.filter(_inactive()).groupBy("epoch")
            .agg(F.sum("delegated_amount").cast("long").alias("inactive_delegated_ada"),
                 F.count(F.lit(1)).alias("inactive_drep_count")))


# ================================================================ DOC ======

def doc1_ratified_approval(ds: Datasets) -> DataFrame:
    return (ds.gov_action_lifecycle.filter(F.col("status") == C.STATUS_RATIFIED)
            .select("type", "drep_approval_ratio", "spo_approval_ratio"))


def doc2_gini_sample(ds: Datasets) -> DataFrame:
    """The documented sample: ``1 - 2 * avg(running share)``, running share
    over a RANGE frame (ties share their peer sum). Sums stay exact until one
    final division."""
    s = ds.drep_amounts().filter(~F.col("drep_type").isin(*C.DEFAULT_DREP_TYPES))
    h = cumulative_histogram(s, "epoch", "delegated_amount")
    n = F.col("n").cast("decimal(20,0)")
    peers = F.col("sum_before") + F.coalesce(F.col("delegated_amount").cast("decimal(20,0)") * n, F.lit(0))
    agg = h.groupBy("epoch").agg(F.sum((peers * n).cast("decimal(38,0)")).alias("__cs"),
                                 F.max("sum_all").alias("__total"), F.max("n_all").alias("__n"))
    share_sum = F.col("__cs").cast("double") / F.col("__total").cast("double")
    return agg.select("epoch", (F.lit(1.0) - F.lit(2.0) * share_sum / F.col("__n").cast("double"))
                      .alias("gini"))


def doc3_treasury_delta(ds: Datasets) -> DataFrame:
    # one row per epoch: the global LAG is bounded by the number of epochs
    w = Window.orderBy("epoch")
    s = ds.epoch_summary
    return s.select("epoch", "treasury", (F.col("treasury") - F.lag("treasury").over(w)).alias("delta"))


# ================================================================ P1 =======

def _digits_tier(amount: Column) -> Column:
    """Wallet-size tier = power of ten of the lovelace amount (exact: digit count)."""
    a = amount.cast("decimal(38,0)")
    return F.when(a < 1, F.lit(0)).otherwise(F.length(a.cast("string")) - 1).cast("int")


def p1_4_delegation_by_wallet_tier(ds: Datasets) -> DataFrame:
    """Per epoch and power-of-ten tier of the address's stake: wallets and
    stake that had delegated to a DRep by that epoch."""
    t = ds.tables
    first = ds.delegation_events.groupBy("address").agg(F.min("epoch").alias("__first"))
    st = D.in_epochs(t.epoch_stake, ds.epochs)
    j = st.join(first, "address", "left").withColumn(
        "__del", F.coalesce(F.col("__first") <= F.col("epoch"), F.lit(False)))
    agg = (j.groupBy("epoch", _digits_tier(F.col("amount")).alias("tier"))
            .agg(F.count(F.lit(1)).alias("wallets"),
                 F.count_if("__del").alias("delegated_wallets"),
                 F.sum("amount").cast("long").alias("stake"),
                 F.sum(F.when(F.col("__del"), F.col("amount")).otherwise(0)).cast("long")
                  .alias("delegated_stake")))
    return agg.select("epoch", "tier", "wallets", "delegated_wallets", "stake", "delegated_stake",
                      pct("delegated_wallets", "wallets").alias("wallet_delegation_pct"),
                      pct("delegated_stake", "stake").alias("stake_delegation_pct"))


def p1_6_new_wallet_delegation_rate(ds: Datasets, window: int = NEW_WALLET_WINDOW) -> DataFrame:
    """Per registration epoch: new stake addresses, and those whose first
    delegation falls within ``window`` epochs of registering."""
    t = ds.tables
    reg = t.stake_registration.groupBy("address").agg(F.min("epoch").alias("epoch"))
    first = t.delegation_vote.groupBy("address").agg(F.min("epoch").alias("__first"))
    j = reg.join(first, "address", "left")
    ok = (F.col("__first") >= F.col("epoch")) & (F.col("__first") <= F.col("epoch") + window)
    agg = j.groupBy("epoch").agg(F.count(F.lit(1)).alias("new_wallets"),
                                 F.count_if(F.coalesce(ok, F.lit(False))).alias("new_wallets_delegating"))
    return agg.withColumn("new_wallet_delegation_pct", pct("new_wallets_delegating", "new_wallets"))


def _latest_drep_votes(ds: Datasets, voter_types=C.DREP_VOTER_TYPES, voters: DataFrame | None = None) -> DataFrame:
    """Each voter's latest vote per action (by slot, then vote text); ``voters``:
    only of the voters whose ``voter_hash`` is among them."""
    v = ds.gov_action_votes.filter(F.col("voter_type").isin(*voter_types))
    if voters is not None:
        # dealt by the key to all tasks: latest rows hold texts and are found by sorting, too much for a few
        parts = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        v = v.join(voters, "voter_hash", "left_semi").repartition(parts, "voter_hash", "gov_action_tx_hash", "gov_action_index")
    return D.latest_by(v, ["voter_hash", "gov_action_tx_hash", "gov_action_index"],
                       ["vote_slot", "vote"], ["vote", "vote_epoch", "vote_slot"])


def p1_7_post_vote_delegation_outflow(ds: Datasets, z: int = OUTFLOW_EPOCHS) -> DataFrame:
    """Per action and vote value: delegators that left a DRep with that
    (latest) vote after the vote, within ``z`` epochs, and their stake. An
    address that leaves a DRep several times in an epoch counts once, by its
    last move.

    Only votes of DReps that were ever delegated to are read on: no one leaves the
    others. They are expanded over their z+1 epochs; each takes the sums over what left
    the same DRep in that epoch after it. Votes of one DRep, epoch and slot have the
    same sums, found once for their place. Leavers of one DRep and epoch are
    cut into ranges of slots, so a DRep that a third of all leave is spread."""
    leave = (churn_rows(ds).groupBy(F.col("prev_drep_hash").alias("voter_hash"), "epoch", "address")
             .agg(F.max("slot").alias("slot")))
    stake = D.in_epochs(ds.tables.epoch_stake, ds.epochs).select("address", "epoch", "amount")
    action = ["gov_action_tx_hash", "gov_action_index", "vote"]
    # merge: a snapshot table is large, also where Spark's estimate (rows before they are expanded by epoch) says otherwise
    left = (leave.join(stake.hint("merge"), ["address", "epoch"], "left")
            .select("voter_hash", "epoch", "slot", F.lit(1).alias("moves"), "amount"))
    voters = ds.delegation_events.select(F.col("drep_hash").alias("voter_hash")).distinct()
    votes = (_latest_drep_votes(ds, voters=voters)
             .withColumn("epoch", F.explode(F.sequence(F.col("vote_epoch"), F.col("vote_epoch") + z)))
             .withColumn("slot", F.when(F.col("epoch") == F.col("vote_epoch"), F.col("vote_slot")).otherwise(F.lit(-1))))
    place = ["voter_hash", "epoch", "slot"]
    after = sum_after(left, votes.select(*place).distinct(), ["voter_hash", "epoch"], "slot",
                      ["moves", "amount"]).filter(F.col("moves") > 0)
    return votes.select(*place, *action).join(after, place).groupBy(*action).agg(F.count_distinct("voter_hash").alias("dreps_with_outflow"),
                                      F.sum("moves").alias("outflow_delegations"),
                                      F.sum("amount").cast("long").alias("outflow_stake"))


# ================================================================ P2 =======

def gini_by(df: DataFrame, keys, value: str) -> DataFrame:
    """Gini = 2*sum(i*x_i)/(n*sum x) - (n+1)/n with i the ascending rank;
    exact integer sums, one final division. A group of c tied rows after b
    smaller ones holds the ranks b+1..b+c: their sum is c*b + c*(c+1)/2."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    h = cumulative_histogram(df, keys, value)
    c = F.col("n").cast("decimal(18,0)")
    ranks = (c * F.col("n_before").cast("decimal(18,0)")
             + (F.col("n") * (F.col("n") + 1) / 2).cast("decimal(18,0)")).cast("decimal(18,0)")
    agg = h.groupBy(*keys).agg(
        F.max("n_all").alias("n"), F.max("sum_all").alias("__t"),
        F.sum((ranks * F.col(value).cast("decimal(20,0)")).cast("decimal(38,0)")).alias("__iw"))
    n = F.col("n").cast("double")
    g = (F.lit(2.0) * F.col("__iw").cast("double") / (n * F.col("__t").cast("double"))
         - (n + F.lit(1.0)) / n)
    return agg.select(*keys, "n", F.col("__t").cast("long").alias("total"), g.alias("gini"))


def p2_1_drep_stake_gini(ds: Datasets) -> DataFrame:
    s = _dreps_active(ds.drep_snapshots())
    g = gini_by(s, "epoch", "delegated_amount")
    return g.select("epoch", F.col("n").alias("drep_count"), F.col("total").alias("total_stake"), "gini")


def _action_spans(ds: Datasets) -> DataFrame:
    """(action, epoch_proposed, last epoch open) of actions open in some epoch:
    to the resolution epoch or the newest planned epoch."""
    last = F.coalesce(F.col("epoch_resolved"), F.lit(max(ds.epochs)))
    return (ds.gov_action_lifecycle.filter(last >= F.col("epoch_proposed"))
            .select("gov_action_tx_hash", "gov_action_index", "epoch_proposed", last.alias("last_epoch")))


def p2_2_drep_activity_rate(ds: Datasets, min_share: float = ACTIVITY_MIN_SHARE) -> DataFrame:
    """Per epoch: registered (non-retired) DReps, and those that voted in the
    epoch on at least ``min_share`` of the actions open in it. Open actions
    are a running sum of +1 at the proposal and -1 after the last open epoch;
    a vote is on an open action if it lies between the two."""
    spans = _action_spans(ds)
    delta = F.explode(F.array(F.struct(F.col("epoch_proposed").alias("epoch"), F.lit(1).alias("d")),
                              F.struct((F.col("last_epoch") + 1).alias("epoch"), F.lit(-1).alias("d"))))
    changes = spans.select(delta.alias("x")).groupBy("x.epoch").agg(F.sum("x.d").alias("__d"))
    marks = ds.spark_epochs().select("epoch", F.lit(0).cast("long").alias("__d"))
    # one row per epoch: a single ordered window over them is bounded
    upto = Window.orderBy("epoch").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    n_open = (changes.unionByName(marks).groupBy("epoch").agg(F.sum("__d").alias("__d"))
              .select("epoch", F.sum("__d").over(upto).alias("open_actions")))
    votes = (ds.gov_action_votes.filter(F.col("voter_type").isin(*C.DREP_VOTER_TYPES))
             .select("voter_hash", "gov_action_tx_hash", "gov_action_index",
                     F.col("vote_epoch").alias("epoch")).distinct())
    voted = (votes.join(spans, ["gov_action_tx_hash", "gov_action_index"])
             .filter(F.col("epoch").between(F.col("epoch_proposed"), F.col("last_epoch")))
             .select("epoch", "voter_hash", "gov_action_tx_hash", "gov_action_index").distinct()
             .groupBy("epoch", "voter_hash").agg(F.count(F.lit(1)).alias("__k")))
    dreps = (ds.drep_statuses().filter(F.col("drep_hash").isNotNull()
                                       & (F.coalesce(F.col("status"), F.lit("")) != C.DREP_RETIRED))
             .select("epoch", F.col("drep_hash").alias("voter_hash")).distinct())
    per = (dreps.join(voted, ["epoch", "voter_hash"], "left")
                .join(F.broadcast(n_open), "epoch", "left"))
    active = F.coalesce(F.col("__k"), F.lit(0)).cast("double") >= F.lit(min_share) * F.col("open_actions")
    agg = per.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("registered_dreps"),
        F.count_if(F.coalesce(active & (F.col("open_actions") > 0), F.lit(False))).alias("active_dreps"),
        F.max(F.coalesce("open_actions", F.lit(0))).alias("open_actions"))
    return agg.withColumn("activity_rate_pct", pct("active_dreps", "registered_dreps"))


def _vote_kpi_base(ds: Datasets, voter_types) -> DataFrame:
    return ds.gov_action_votes.filter(F.col("voter_type").isin(*voter_types))


def p2_3_drep_rationale_rate(ds: Datasets) -> DataFrame:
    v = _vote_kpi_base(ds, C.DREP_VOTER_TYPES)
    agg = v.groupBy(F.col("vote_epoch").alias("epoch")).agg(
        F.count(F.lit(1)).alias("drep_votes"), F.count_if("has_rationale").alias("votes_with_rationale"))
    return agg.withColumn("rationale_rate_pct", pct("votes_with_rationale", "drep_votes"))


def _median_latency(ds: Datasets, voter_types, count_name: str, out: str) -> DataFrame:
    v = _vote_kpi_base(ds, voter_types).withColumnRenamed("vote_epoch", "epoch")
    return count_and_median(v, "epoch", F.col("vote_block_time") - F.col("action_block_time"), count_name, out)


def p2_4_drep_time_to_vote(ds: Datasets) -> DataFrame:
    return _median_latency(ds, C.DREP_VOTER_TYPES, "drep_votes", "median_seconds_to_vote")


def _vote_code() -> Column:
    return F.when(F.col("vote") == C.VOTE_YES, 1).when(F.col("vote") == C.VOTE_NO, -1).otherwise(0)


def p2_5_drep_vote_correlation(ds: Datasets, top_n: int = TOP_N_DREPS) -> DataFrame:
    """Mean pairwise correlation of vote codes (YES 1, NO -1, ABSTAIN 0) over
    shared actions, among the ``top_n`` DReps by stake in the newest epoch.
    Pairs are only formed inside that fixed top-N set (<= N*(N-1)/2)."""
    s = ds.drep_epoch_stats.filter(F.col("drep_hash").isNotNull())
    newest = s.select(F.max("epoch")).scalar()
    # top-N report: ordered limit (partial top-k per partition, N rows merged)
    top = (s.filter(F.col("epoch") == newest)
            .orderBy(F.col("delegated_amount").desc(), F.col("drep_hash"))
            .limit(top_n).select(F.col("drep_hash").alias("voter_hash")))
    votes = (_latest_drep_votes(ds).join(F.broadcast(top), "voter_hash", "left_semi")
             .select("voter_hash", "gov_action_tx_hash", "gov_action_index", _vote_code().alias("code")))
    a = votes.select(F.col("voter_hash").alias("a"), "gov_action_tx_hash", "gov_action_index",
                     F.col("code").alias("ca"))
    b = votes.select(F.col("voter_hash").alias("b"), "gov_action_tx_hash", "gov_action_index",
                     F.col("code").alias("cb"))
    # Pearson r from exact integer sums (codes are small ints): identical in
    # any engine, NULL when either side has zero variance
    x, y = F.col("ca").cast("long"), F.col("cb").cast("long")
    sums = (a.join(b, ["gov_action_tx_hash", "gov_action_index"], "inner")
             .filter(F.col("a") < F.col("b"))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                                    F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"),
                                    F.sum(x * y).alias("sxy")))
    num = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    dx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    dy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    r = F.when((dx > 0) & (dy > 0), num.cast("double") / F.sqrt(dx.cast("double") * dy.cast("double")))
    pairs = sums.select(r.alias("r"))
    return pairs.agg(F.count("r").alias("pairs"), F.round(F.avg("r"), 6).alias("mean_pairwise_corr"))


def p2_6_drep_lifecycle_rate(ds: Datasets) -> DataFrame:
    s = ds.epoch_summary
    return s.select("epoch", "drep_registrations", "drep_retirements",
                    (F.col("drep_registrations") - F.col("drep_retirements")).alias("net_drep_change"))


def vote_changes(ds: Datasets, voter_types) -> DataFrame:
    """Per vote epoch: re-votes that differ from the voter's previous vote on
    the same action (P2.7 for DReps, P3.6 for pools)."""
    v = _vote_kpi_base(ds, voter_types).select(
        "voter_hash", "gov_action_tx_hash", "gov_action_index", "vote", "vote_slot", "vote_epoch")
    lagged = lag_within(v, ["voter_hash", "gov_action_tx_hash", "gov_action_index"],
                        ["vote_slot", "vote", "vote_epoch"], ["vote"])
    ch = lagged.filter(F.col("prev_vote").isNotNull() & (F.col("vote") != F.col("prev_vote")))
    return ch.groupBy(F.col("vote_epoch").alias("epoch")).agg(
        F.count(F.lit(1)).alias("vote_changes"), F.count_distinct("voter_hash").alias("voters_changing"))


def p2_7_drep_vote_changes(ds: Datasets) -> DataFrame:
    return vote_changes(ds, C.DREP_VOTER_TYPES)


def p2_8_drep_seniority(ds: Datasets) -> DataFrame:
    """Histogram of DReps by month of first registration."""
    reg = ds.tables.drep_registration.groupBy("drep_hash").agg(F.min("block_time").alias("__t"))
    return (reg.groupBy(F.date_format("__t", "yyyy-MM").alias("registration_month"))
               .agg(F.count(F.lit(1)).alias("dreps")))


def p2_9_drep_cc_latency(ds: Datasets) -> DataFrame:
    """Per action epoch: median seconds from the committee's decision (its
    last vote on the action) to each DRep vote on it."""
    cc = ds.cc_vote_details.groupBy("gov_action_tx_hash", "gov_action_index").agg(
        F.max("vote_block_time").alias("__cc"))
    v = (_vote_kpi_base(ds, C.DREP_VOTER_TYPES).join(cc, ["gov_action_tx_hash", "gov_action_index"], "inner")
         .withColumnRenamed("action_epoch", "epoch"))
    return count_and_median(v, "epoch", F.col("vote_block_time") - F.col("__cc"), "drep_votes",
                             "median_seconds_after_cc")


def p2_10_drep_metadata_completeness(ds: Datasets) -> DataFrame:
    s = ds.drep_epoch_stats.filter(F.col("drep_hash").isNotNull())
    agg = s.groupBy("epoch").agg(F.count(F.lit(1)).alias("dreps"),
                                 F.count_if(F.coalesce("has_metadata", F.lit(False))).alias("with_metadata"))
    return agg.withColumn("completeness_pct", pct("with_metadata", "dreps"))


def p2_11_top100_volatility(ds: Datasets, top: int = 100, window: int = VOLATILITY_WINDOW) -> DataFrame:
    """Per epoch: share of active-DRep stake held by the top ``top`` DReps and
    its sample stddev over the last ``window`` epochs. The top-k per epoch is
    a WindowGroupLimit (partial top-k before the shuffle)."""
    s = _dreps_active(ds.drep_epoch_stats)
    w = Window.partitionBy("epoch").orderBy(F.col("delegated_amount").desc(), F.col("drep_hash"))
    topk = (s.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= top)
             .groupBy("epoch").agg(F.sum("delegated_amount").alias("__top")))
    tot = s.groupBy("epoch").agg(F.sum("delegated_amount").alias("__all"))
    # both sides one row per epoch: bounded broadcast
    share = topk.join(F.broadcast(tot), "epoch").select("epoch", ratio("__top", "__all").alias("top_share"))
    roll = Window.orderBy("epoch").rowsBetween(-(window - 1), 0)  # one row per epoch
    return share.select("epoch", "top_share", F.round(F.stddev_samp("top_share").over(roll), 9)
                        .alias("top_share_stddev"))


def _action_turnout(ds: Datasets) -> DataFrame:
    life = ds.gov_action_lifecycle.filter(F.col("drep_yes_vote_stake").isNotNull())
    circ = ds.epoch_summary.select(F.col("epoch").alias("epoch_proposed"), "circulation")
    stake = F.col("drep_yes_vote_stake") + F.col("drep_no_vote_stake") + F.col("drep_abstain_vote_stake")
    # unrounded per-action ratio: rounding before averaging would create ties
    turnout = stake.cast("double") * F.lit(100.0) / F.nullif(F.col("circulation").cast("double"), F.lit(0.0))
    return life.join(circ, "epoch_proposed").withColumn("turnout_pct", turnout)


def p2_12_voting_seasonality(ds: Datasets) -> DataFrame:
    """Average action turnout per calendar month of proposal, and the change
    against the same month a year earlier."""
    t = _action_turnout(ds).withColumn("__ts", F.timestamp_seconds("block_time_proposed"))
    per = (t.groupBy(F.year("__ts").alias("year"), F.month("__ts").alias("month"))
            .agg(F.count(F.lit(1)).alias("actions"), F.round(F.avg("turnout_pct"), 6).alias("avg_turnout_pct")))
    prev = per.select((F.col("year") + 1).alias("year"), "month", F.col("avg_turnout_pct").alias("__prev"))
    return (per.join(F.broadcast(prev), ["year", "month"], "left")   # one row per month
               .select("year", "month", "actions", "avg_turnout_pct",
                       F.round(F.col("avg_turnout_pct") - F.col("__prev"), 6).alias("yoy_change_pct")))


# ================================================================ P3 =======

def _live_pools(ds: Datasets) -> DataFrame:
    """(epoch, pool_id, pool_stake): pools with a stake snapshot in the epoch
    whose latest lifecycle event up to it, if any, is not a retirement. One row
    per pool and epoch, whether or not it has events in that epoch."""
    t = ds.tables
    stake = (D.in_epochs(t.epoch_stake, ds.epochs).groupBy("epoch", "pool_id")
             .agg(F.sum("amount").alias("pool_stake")))
    known = asof_latest(stake, t.pool, key="pool_id", epoch="epoch",
                        order=("epoch", "slot", "tx_index", "cert_index"), value="status")
    return known.filter(F.col("pool_id").isNotNull()
                        & (F.coalesce("status", F.lit("")) != C.POOL_RETIRED)).drop("status")


def _pool_stake_frame(ds: Datasets) -> DataFrame:
    """Live pools per epoch with their delegated stake and whether the pool
    voted in that epoch."""
    voters = (D.in_epochs(ds.tables.voting_procedure.filter(F.col("voter_type") == C.SPO_VOTER_TYPE), ds.epochs)
              .select("epoch", F.col("voter_hash").alias("pool_id")).distinct()
              .withColumn("voted", F.lit(True)))
    return (_live_pools(ds).join(voters, ["epoch", "pool_id"], "left")
            .select("epoch", "pool_id", F.coalesce("pool_stake", F.lit(0)).alias("pool_stake"),
                    F.coalesce("voted", F.lit(False)).alias("voted")))


def p3_1_spo_turnout(ds: Datasets) -> DataFrame:
    f = _pool_stake_frame(ds)
    agg = f.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("active_pools"), F.count_if("voted").alias("voting_pools"),
        F.sum("pool_stake").cast("long").alias("active_stake"),
        F.sum(F.when(F.col("voted"), F.col("pool_stake")).otherwise(0)).cast("long").alias("voting_stake"))
    return agg.select("*", pct("voting_pools", "active_pools").alias("turnout_pct"),
                      pct("voting_stake", "active_stake").alias("stake_turnout_pct"))


def p3_2_spo_silent_stake(ds: Datasets) -> DataFrame:
    f = _pool_stake_frame(ds)
    agg = f.groupBy("epoch").agg(
        F.sum("pool_stake").cast("long").alias("active_stake"),
        F.sum(F.when(~F.col("voted"), F.col("pool_stake")).otherwise(0)).cast("long").alias("silent_stake"))
    return agg.withColumn("silent_stake_pct", pct("silent_stake", "active_stake"))


def p3_3_default_stance_adoption(ds: Datasets) -> DataFrame:
    """Per epoch: live pools, and those whose owners delegate to a default."""
    p = _live_pools(ds).join(D.pool_default_stance(ds.tables), "pool_id", "left")
    agg = p.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("pools"),
        F.count_if(F.col("default_stance") == C.DREP_ABSTAIN).alias("abstain_pools"),
        F.count_if(F.col("default_stance") == C.DREP_NO_CONFIDENCE).alias("no_confidence_pools"),
        F.count("default_stance").alias("__any"))
    return agg.select("epoch", "pools", "abstain_pools", "no_confidence_pools",
                      pct("__any", "pools").alias("adoption_pct"))


def p3_4_spo_vote_latency(ds: Datasets) -> DataFrame:
    return _median_latency(ds, (C.SPO_VOTER_TYPE,), "spo_votes", "median_seconds_to_vote")


def p3_5_stake_concentration(ds: Datasets, entities: DataFrame | None = None) -> DataFrame:
    """HHI and Gini of stake per entity per epoch. ``entities`` maps
    ``pool_id -> entity`` (an external registry); by default each pool is its
    own entity. HHI = sum(stake^2) / total^2 from exact sums."""
    t = ds.tables
    st = D.in_epochs(t.epoch_stake, ds.epochs).select("epoch", "pool_id", "amount")
    if entities is not None:
        st = st.join(entities, "pool_id", "left").withColumn("entity", F.coalesce("entity", "pool_id"))
    else:
        st = st.withColumn("entity", F.col("pool_id"))
    per = st.groupBy("epoch", "entity").agg(F.sum("amount").cast("decimal(38,0)").alias("stake"))
    hhi = per.groupBy("epoch").agg(
        F.sum(F.col("stake") * F.col("stake")).alias("__sq"), F.sum("stake").alias("__t"))
    hhi = hhi.select("epoch", (F.col("__sq").cast("double")
                               / (F.col("__t").cast("double") * F.col("__t").cast("double"))).alias("hhi"))
    g = gini_by(per.withColumn("stake", F.col("stake").cast("long")), "epoch", "stake")
    return g.join(F.broadcast(hhi), "epoch").select("epoch", F.col("n").alias("entities"), "hhi", "gini")


def p3_6_spo_vote_changes(ds: Datasets) -> DataFrame:
    return vote_changes(ds, (C.SPO_VOTER_TYPE,))


def p3_7_spo_drep_divergence(ds: Datasets) -> DataFrame:
    life = ds.gov_action_lifecycle
    return life.select("gov_action_tx_hash", "gov_action_index", "type", "status",
                       "drep_approval_ratio", "spo_approval_ratio",
                       (F.col("spo_approval_ratio") - F.col("drep_approval_ratio")).alias("divergence"))


# ================================================================ P4 =======

def p4_1_action_volume(ds: Datasets) -> DataFrame:
    p = ds.tables.gov_action_proposal
    return (p.groupBy(F.date_format("block_time", "yyyy-MM").alias("month"), "type", "return_address")
             .agg(F.count(F.lit(1)).alias("actions")))


def p4_2_contention(ds: Datasets, margin: float = CLOSE_MARGIN) -> DataFrame:
    """Per proposal epoch: average yes/no/abstain shares of DRep vote stake,
    and the share of close outcomes (yes share of yes+no within ``margin`` of
    one half)."""
    life = ds.gov_action_lifecycle.filter(F.col("drep_yes_vote_stake").isNotNull())
    y, n, a = (F.col(c).cast("double") for c in
               ("drep_yes_vote_stake", "drep_no_vote_stake", "drep_abstain_vote_stake"))
    tot = F.nullif(y + n + F.coalesce(a, F.lit(0.0)), F.lit(0.0))
    x = life.select("epoch_proposed", (y / tot).alias("ys"), (n / tot).alias("ns"),
                    (F.coalesce(a, F.lit(0.0)) / tot).alias("as_"),
                    (F.abs(y / F.nullif(y + n, F.lit(0.0)) - F.lit(0.5)) < margin).alias("close"))
    agg = x.groupBy(F.col("epoch_proposed").alias("epoch")).agg(
        F.count(F.lit(1)).alias("actions"),
        F.round(F.avg("ys"), 9).alias("avg_yes_share"), F.round(F.avg("ns"), 9).alias("avg_no_share"),
        F.round(F.avg("as_"), 9).alias("avg_abstain_share"),
        F.count_if(F.coalesce("close", F.lit(False))).alias("close_actions"))
    return agg.withColumn("close_share_pct", pct("close_actions", "actions"))


def _treasury_years(ds: Datasets) -> DataFrame:
    """Treasury change per epoch, attributed to the calendar year of the
    epoch's last block."""
    w = Window.orderBy("epoch")  # one row per epoch
    s = ds.epoch_summary.select("epoch", "treasury", "epoch_end_time",
                                (F.col("treasury") - F.lag("treasury").over(w)).alias("delta"))
    return s.filter(F.col("delta").isNotNull() & F.col("epoch_end_time").isNotNull()).select(
        F.year(F.timestamp_seconds("epoch_end_time")).alias("year"), "delta")


def p4_3_treasury_balance_rate(ds: Datasets) -> DataFrame:
    y = _treasury_years(ds).groupBy("year").agg(
        F.sum(F.when(F.col("delta") > 0, F.col("delta")).otherwise(0)).cast("long").alias("treasury_added"),
        F.sum(F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0)).cast("long").alias("treasury_spent"))
    return y.withColumn("balance_rate", ratio("treasury_spent", "treasury_added"))


def p4_5_time_to_enactment(ds: Datasets) -> DataFrame:
    """Per action type: median days from proposal to the end of the epoch in
    which the action was enacted."""
    ends = ds.epoch_ends().withColumnRenamed("epoch", "epoch_resolved")
    j = ds.enactments().join(F.broadcast(ends), "epoch_resolved", "inner")          # one row per epoch
    # median of whole seconds (exact in any engine), then one division
    secs = F.col("epoch_end_time") - F.col("block_time_proposed")
    m = count_and_median(j, "type", secs, "enacted_actions", "__med")
    return m.select("type", "enacted_actions", (F.col("__med") / F.lit(86400.0)).alias("median_days_to_enactment"))


def p4_6_treasury_vs_ncl(ds: Datasets, ncl_lovelace: int = NCL_LOVELACE) -> DataFrame:
    y = p4_3_treasury_balance_rate(ds).select("year", "treasury_spent")
    return y.select("year", "treasury_spent", F.lit(ncl_lovelace).cast("long").alias("net_change_limit"),
                    pct("treasury_spent", F.lit(ncl_lovelace)).alias("spend_vs_ncl_pct"))


def yearly_limits(limits: DataFrame, last_year) -> DataFrame:
    """(year, net_change_limit) from ``limits`` (valid_from, valid_to exclusive or
    NULL = open, annual_limit): each limit counts by the days of the year on which it is
    in force, rounded down; NULL for a year with days that no limit covers. An
    interval is expanded into the years it touches, so years look limits up by
    equality. Intervals must not overlap."""
    year_start = lambda y: F.make_date(y, F.lit(1), F.lit(1))
    end = F.coalesce(F.col("valid_to"), year_start(last_year + 1))
    x = (limits.select("valid_from", end.alias("valid_to"), "annual_limit").filter(F.col("valid_from") < F.col("valid_to"))
         .withColumn("year", F.explode(F.sequence(F.year("valid_from"), F.year(F.date_sub("valid_to", 1))))))
    begin, until = year_start(F.col("year")), year_start(F.col("year") + 1)
    days = F.datediff(F.least("valid_to", until), F.greatest("valid_from", begin))
    per = x.groupBy("year").agg(F.sum(days).alias("covered"), F.max(F.datediff(until, begin)).alias("days"),
                                F.sum(F.col("annual_limit").cast("decimal(30,0)") * days).alias("weighted"))
    whole = F.call_function("div", F.col("weighted").cast("long"), F.col("days").cast("long"))
    return per.select("year", F.when(F.col("covered") == F.col("days"), whole).alias("net_change_limit"))


def p4_6_treasury_vs_dated_ncl(ds: Datasets, limits: DataFrame) -> DataFrame:
    """P4.6 against effective-dated limits (an external table): spend per
    calendar year, the year's limit, and their ratio (NULL without a limit)."""
    y = p4_3_treasury_balance_rate(ds).select("year", "treasury_spent")
    per_year = yearly_limits(limits, y.select(F.max("year")).scalar())
    return (y.join(F.broadcast(per_year), "year", "left")                       # one row per year
            .select("year", "treasury_spent", "net_change_limit", pct("treasury_spent", "net_change_limit").alias("spend_vs_ncl_pct")))


def p4_7_zero_cc_no(ds: Datasets) -> DataFrame:
    life = ds.gov_action_lifecycle.filter(F.col("cc_no").isNotNull())
    agg = life.groupBy(F.col("epoch_proposed").alias("epoch")).agg(
        F.count(F.lit(1)).alias("actions"), F.count_if(F.col("cc_no") == 0).alias("zero_cc_no_actions"))
    return agg.withColumn("zero_cc_no_pct", pct("zero_cc_no_actions", "actions"))


def p4_8_success_by_source(ds: Datasets) -> DataFrame:
    life = ds.gov_action_lifecycle
    agg = life.groupBy("return_address").agg(
        F.count(F.lit(1)).alias("submitted"),
        F.count_if(F.col("status").isin(*C.APPROVED_STATUSES)).alias("approved"))
    return agg.withColumn("success_rate_pct", pct("approved", "submitted"))


def _largest_first(rows: DataFrame, keys, stake: str) -> DataFrame:
    """Per ``keys`` and distinct ``stake``, largest first: ``first`` rank and
    number ``n`` of the tied rows, ``cum`` stake up to and with them, ``all`` stake.
    Tied rows are one row of the cumulative histogram of the negated stake."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    h = cumulative_histogram(rows.select(*keys, (-F.col(stake)).alias("__neg")), keys, "__neg")
    n = F.col("n").cast("decimal(18,0)")
    return h.select(*keys, (-F.col("__neg")).alias("x"), (F.col("n_before") + 1).alias("first"), "n", (-F.col("sum_all")).alias("all"),
                    (-F.col("sum_before") + F.coalesce(-F.col("__neg").cast("decimal(20,0)") * n, F.lit(0))).alias("cum"))


def _fewest(threshold: Column) -> Column:
    """Aggregate over :func:`_largest_first` rows of a group: the fewest actors,
    largest first, whose stake reaches ``threshold`` of all. With ``before`` = stake
    ranked ahead of a tied group and ``x`` its stake each, the answer inside the
    group is ``first - 1 + ceil((goal - before) / x)``."""
    goal = threshold * F.col("all").cast("double")
    before = (F.col("cum") - F.col("x") * F.col("n")).cast("double")
    inside = F.ceil((goal - before) / F.nullif(F.col("x").cast("double"), F.lit(0.0)))
    return F.min(F.when((F.col("cum").cast("double") >= goal) & ((before < goal) | (F.col("first") == 1)),
                        F.col("first") - 1 + F.greatest(F.lit(1), inside))).cast("long")


def p4_9_min_attack_vector(ds: Datasets, threshold: str = ATTACK_THRESHOLD) -> DataFrame:
    """Per epoch: fewest active DReps (largest stake first) whose combined
    stake reaches the ``threshold`` share of all active DRep stake."""
    groups = _largest_first(_dreps_active(ds.drep_snapshots()), "epoch", "delegated_amount")
    th = ds.governance_params.select("epoch", F.col(threshold).alias("threshold"))       # one row per epoch
    return groups.join(F.broadcast(th), "epoch", "left").groupBy("epoch").agg(
        F.max("all").cast("long").alias("active_stake"), F.max("threshold").alias("threshold"),
        _fewest(F.col("threshold")).alias("min_actors"))


def p4_9_joint_attack_vector(ds: Datasets, motions=JOINT_MOTIONS) -> DataFrame:
    """Per epoch and motion in which both bodies vote: the fewest actors, DReps
    and stake pools together, that reach the thresholds of both.

    Each body is one descending table of prefix sums (actors of equal stake are
    one row), both bodies and all thresholds are answered by one aggregate over
    them. A body's stake does not help the other to its threshold, so the frontier of
    (DReps, pools) that suffice has one corner: the fewest of each."""
    dreps = _dreps_active(ds.drep_snapshots()).select("epoch", F.lit("drep").alias("body"), F.col("delegated_amount").alias("stake"))
    pools = _live_pools(ds).select(F.col("epoch").cast("int").alias("epoch"), F.lit("pool").alias("body"),
                                   F.col("pool_stake").cast("long").alias("stake"))
    groups = _largest_first(dreps.unionByName(pools), ["epoch", "body"], "stake")
    th = ds.governance_params.select("epoch", *[f"{p}_{m}" for m in motions for p in ("dvt", "pvt")])     # one row per epoch
    of_body = lambda m: F.when(F.col("body") == "drep", F.col(f"dvt_{m}")).otherwise(F.col(f"pvt_{m}"))
    per_body = groups.join(F.broadcast(th), "epoch", "left").groupBy("epoch", "body").agg(
        F.max("all").cast("long").alias("stake"), *[F.max(of_body(m)).alias(f"share_{m}") for m in motions],
        *[_fewest(of_body(m)).alias(f"fewest_{m}") for m in motions])
    side = lambda c, body: F.max(F.when(F.col("body") == body, F.col(c)))
    wide = per_body.groupBy("epoch").agg(*[
        F.struct(F.lit(m).alias("motion"), side("stake", "drep").alias("drep_stake"), side(f"share_{m}", "drep").alias("drep_threshold"),
                 side(f"fewest_{m}", "drep").alias("min_dreps"), side("stake", "pool").alias("pool_stake"),
                 side(f"share_{m}", "pool").alias("pool_threshold"), side(f"fewest_{m}", "pool").alias("min_pools")).alias(m)
        for m in motions])
    return (wide.select("epoch", F.explode(F.array(*motions)).alias("r")).select("epoch", "r.*")
            .withColumn("min_actors", F.col("min_dreps") + F.col("min_pools")))


# ================================================================ P5 =======

def p5_1_cc_time_to_decision(ds: Datasets) -> DataFrame:
    c = ds.cc_vote_details
    m = count_and_median(c, "action_epoch", F.col("time_to_vote_seconds"), "cc_votes", "__med")
    return m.select(F.col("action_epoch").alias("epoch"), "cc_votes",
                    (F.col("__med") / F.lit(86400.0)).alias("median_days_to_vote"))


def p5_2_cc_member_participation(ds: Datasets) -> DataFrame:
    """Per committee member: actions voted on, of all actions. Members of the
    roster that never voted are rows with 0; a voting hot key that no
    registration maps to a member is a row of its own (cold_key NULL)."""
    c = ds.cc_vote_details
    total = ds.tables.gov_action_proposal.select(
        F.count_distinct("tx_hash", "idx")).scalar()
    unmapped = F.when(F.col("cold_key").isNull(), F.col("voter_hash"))
    per = c.groupBy("cold_key", unmapped.alias("hot_key")).agg(
        F.count_distinct("gov_action_tx_hash", "gov_action_index").alias("actions_voted"))
    roster = ds.tables.committee_member.filter(F.col("hash").isNotNull()).select(F.col("hash").alias("cold_key")).distinct()
    silent = roster.join(per.select("cold_key"), "cold_key", "left_anti").select(
        "cold_key", F.lit(None).cast("string").alias("hot_key"), F.lit(0).cast("long").alias("actions_voted"))
    return per.unionByName(silent).select(
        "cold_key", "hot_key", "actions_voted", total.cast("long").alias("total_actions"),
        pct("actions_voted", total).alias("participation_pct"))


def p5_3_cc_abstain_rate(ds: Datasets) -> DataFrame:
    c = ds.cc_vote_details
    agg = c.groupBy(F.col("vote_epoch").alias("epoch")).agg(
        F.count(F.lit(1)).alias("cc_votes"), F.count_if(F.col("vote") == C.VOTE_ABSTAIN).alias("abstain_votes"))
    return agg.withColumn("abstain_rate_pct", pct("abstain_votes", "cc_votes"))


def p5_4_cc_non_unanimous(ds: Datasets) -> DataFrame:
    c = ds.cc_vote_details
    per = c.groupBy("gov_action_tx_hash", "gov_action_index", "action_epoch").agg(
        F.count_distinct("vote").alias("__k"))
    agg = per.groupBy(F.col("action_epoch").alias("epoch")).agg(
        F.count(F.lit(1)).alias("actions"), F.count_if(F.col("__k") > 1).alias("non_unanimous_actions"))
    return agg.withColumn("non_unanimous_pct", pct("non_unanimous_actions", "actions"))


# ================================================================ registry ==

KPI_FUNCS: dict[str, Callable[[Datasets], DataFrame]] = {
    "k1_1_voting_turnout": k1_1_voting_turnout,
    "k1_2_active_stake_participation": k1_2_active_stake_participation,
    "k1_3_delegation_rate": k1_3_delegation_rate,
    "k1_5_delegation_churn": k1_5_delegation_churn,
    "k1_8_inactive_delegated_ada": k1_8_inactive_delegated_ada,
    "doc1_ratified_approval": doc1_ratified_approval,
    "doc2_gini_sample": doc2_gini_sample,
    "doc3_treasury_delta": doc3_treasury_delta,
    "p1_4_delegation_by_wallet_tier": p1_4_delegation_by_wallet_tier,
    "p1_6_new_wallet_delegation_rate": p1_6_new_wallet_delegation_rate,
    "p1_7_post_vote_delegation_outflow": p1_7_post_vote_delegation_outflow,
    "p2_1_drep_stake_gini": p2_1_drep_stake_gini,
    "p2_2_drep_activity_rate": p2_2_drep_activity_rate,
    "p2_3_drep_rationale_rate": p2_3_drep_rationale_rate,
    "p2_4_drep_time_to_vote": p2_4_drep_time_to_vote,
    "p2_5_drep_vote_correlation": p2_5_drep_vote_correlation,
    "p2_6_drep_lifecycle_rate": p2_6_drep_lifecycle_rate,
    "p2_7_drep_vote_changes": p2_7_drep_vote_changes,
    "p2_8_drep_seniority": p2_8_drep_seniority,
    "p2_9_drep_cc_latency": p2_9_drep_cc_latency,
    "p2_10_drep_metadata_completeness": p2_10_drep_metadata_completeness,
    "p2_11_top100_volatility": p2_11_top100_volatility,
    "p2_12_voting_seasonality": p2_12_voting_seasonality,
    "p3_1_spo_turnout": p3_1_spo_turnout,
    "p3_2_spo_silent_stake": p3_2_spo_silent_stake,
    "p3_3_default_stance_adoption": p3_3_default_stance_adoption,
    "p3_4_spo_vote_latency": p3_4_spo_vote_latency,
    "p3_5_stake_concentration": p3_5_stake_concentration,
    "p3_6_spo_vote_changes": p3_6_spo_vote_changes,
    "p3_7_spo_drep_divergence": p3_7_spo_drep_divergence,
    "p4_1_action_volume": p4_1_action_volume,
    "p4_2_contention": p4_2_contention,
    "p4_3_treasury_balance_rate": p4_3_treasury_balance_rate,
    "p4_5_time_to_enactment": p4_5_time_to_enactment,
    "p4_6_treasury_vs_ncl": p4_6_treasury_vs_ncl,
    "p4_7_zero_cc_no": p4_7_zero_cc_no,
    "p4_8_success_by_source": p4_8_success_by_source,
    "p4_9_min_attack_vector": p4_9_min_attack_vector,
    "p4_9_joint_attack_vector": p4_9_joint_attack_vector,
    "p5_1_cc_time_to_decision": p5_1_cc_time_to_decision,
    "p5_2_cc_member_participation": p5_2_cc_member_participation,
    "p5_3_cc_abstain_rate": p5_3_cc_abstain_rate,
    "p5_4_cc_non_unanimous": p5_4_cc_non_unanimous,
}

# K views as registered in the catalog (name, builder over dataset views)
_VIEW_NAMES = {
    "k1_1_voting_turnout": "kpi_1_1_voting_turnout",
    "k1_2_active_stake_participation": "kpi_1_2_active_stake_participation",
    "k1_3_delegation_rate": "kpi_1_3_delegation_rate",
    "k1_5_delegation_churn": "kpi_1_5_delegation_churn",
    "k1_8_inactive_delegated_ada": "kpi_1_8_inactive_delegated_ada",
}
KPI_VIEW_DATASETS = {
    "kpi_1_1_voting_turnout": ("gov_action_lifecycle", "epoch_summary"),
    "kpi_1_2_active_stake_participation": ("delegation_events",),
    "kpi_1_3_delegation_rate": ("epoch_summary",),
    "kpi_1_5_delegation_churn": ("delegation_events",),
    "kpi_1_8_inactive_delegated_ada": ("drep_epoch_stats",),
}
KPI_VIEWS = [(view, (lambda fn: (lambda get: fn(Datasets(get))))(KPI_FUNCS[key]))
             for key, view in _VIEW_NAMES.items()]


def _query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Datasets.from_tables(Tables.from_fixtures(spark, sf_dir)))
    run.__doc__ = fn.__doc__
    return run


KPI_QUERIES = {key: _query(fn) for key, fn in KPI_FUNCS.items()}
