"""Custom operators against brute force."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ballotlens.operators.latest import asof_latest, latest_by
from ballotlens.operators.ordered import cumulative_histogram, lag_within, value_range
from ballotlens.operators.ranges import count_active_per_epoch
from conftest import rows


def test_latest_by_null_order_ranks_lowest(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 5, "y"), ("a", 3, "z"), ("b", None, "w")],
                               "k string, slot long, v string")
    assert rows(latest_by(df, ["k"], ["slot"], ["v"]), ["k", "v"]) == [("a", "y"), ("b", "w")]


def test_asof_latest_equals_per_epoch_ranking(spark):
    rnd = random.Random(7)
    events, snaps = [], []
    for h in range(12):
        for i in range(rnd.randint(0, 6)):
            slot = rnd.choice([None, rnd.randint(0, 50)])       # not monotone in epoch, NULLs
            status = rnd.choice(["REG", "UPD", "RET", None])
            events.append((f"h{h}", rnd.randint(0, 10), slot, i, status))
        for e in range(0, 12, 2):
            snaps.append((f"h{h}" if h else None, e, f"id{h}-{e}"))
    ev = spark.createDataFrame(events, "drep_hash string, epoch int, slot long, cert int, status string")
    sn = spark.createDataFrame(snaps, "drep_hash string, epoch int, drep_id string")
    got = rows(asof_latest(sn, ev, "drep_hash", "epoch", ["slot", "cert"], "status"),
               ["drep_id", "status"])
    want = []
    for h, e, i in snaps:
        cands = [x for x in events if h is not None and x[0] == h and x[1] <= e]
        cands.sort(key=lambda x: ((x[2] is not None), x[2] or 0, x[3]), reverse=True)
        want.append((i, cands[0][4] if cands else None))
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_count_active_per_epoch_edges(spark):
    members = spark.createDataFrame(
        [("m1", 5, None), ("m2", 5, 6), ("m3", 6, 6), ("m4", 3, 5), (None, 5, None)],
        "hash string, start_epoch int, expired_epoch int")
    out = count_active_per_epoch(members, [4, 5, 6, 7], "start_epoch", "expired_epoch", "hash", "n")
    # start = e counted; expired = e not counted; expired NULL counted; NULL hash not counted
    assert rows(out, ["epoch", "n"]) == [(4, 1), (5, 2), (6, 1), (7, 1)]


def _events(spark, hot_share=0.4, n=3000, seed=3):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < hot_share else f"k{rnd.randint(0, 60)}"
        data.append((key, rnd.randint(0, 400), i, rnd.choice(["A", "B", None]), rnd.randint(1, 9)))
    return spark.createDataFrame(data, "key string, slot long, tie long, val string, amount long")


def test_lag_within_equals_plain_window(spark):
    df = _events(spark)
    w = Window.partitionBy("key").orderBy(F.col("slot").asc_nulls_last(), "tie")
    want = rows(df.withColumn("prev_val", F.lag("val").over(w)), ["tie", "prev_val"])
    for span in (1, 7, 50, 432_000):            # one slot a range, a few, all in one
        assert rows(lag_within(df, "key", ["slot", "tie"], ["val"], span=span), ["tie", "prev_val"]) == want


def test_lag_within_null_keys_orders_and_second_order_columns(spark):
    data = [("a", 1, "YES"), ("a", 1, None), ("a", 2, "NO"), (None, 3, "x"), (None, None, "y"), (None, 900, None),
            ("b", None, "p"), ("b", None, "q"), ("b", 5, None)] + [("hot", i // 3, str(i % 3)) for i in range(300)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "key string, slot long, val string, id long")
    w = Window.partitionBy("key").orderBy(F.col("slot").asc_nulls_last(), F.col("val").asc_nulls_last())
    want = rows(df.withColumn("prev_val", F.lag("val").over(w)).withColumn("prev_id", F.lag("id").over(w)))
    for parts in (1, 8):
        for span in (1, 10, 1000):
            got = lag_within(df.repartition(parts), "key", ["slot", "val"], ["val", "id"], span=span)
            assert rows(got) == want


def test_plans_run_no_job_while_built(spark):
    df = _events(spark)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    lag_within(df, "key", ["slot", "tie"], ["val"])
    cumulative_histogram(df, "key", "amount")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


def test_value_range_is_monotone(spark):
    values = sorted({s * v for v in [*range(0, 2000, 7), 10**9, 10**9 + 1, 999_999, 10**17] for s in (1, -1)})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r.r for r in df.select("v", value_range(F.col("v")).alias("r")).orderBy("v").collect()]
    assert got == sorted(got)


def test_cumulative_histogram_equals_plain_window(spark):
    df = _events(spark, seed=11).unionByName(spark.createDataFrame(
        [("k1", 1, -1, None, None), (None, 1, -2, None, 5), (None, 1, -3, None, -50), ("neg", 1, -4, None, -7), ("neg", 1, -5, None, 8)],
        "key string, slot long, tie long, val string, amount long"))
    smaller = Window.partitionBy("key").orderBy(F.col("amount").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("key")
    want = df.select("key", "amount", F.count("*").over(Window.partitionBy("key", "amount")).alias("n"),
                     F.count("*").over(smaller).alias("upto"), F.sum("amount").over(smaller).alias("sums"),
                     F.count("*").over(whole).alias("n_all"), F.coalesce(F.sum("amount").over(whole), F.lit(0)).alias("sum_all")).distinct()
    want = want.select("key", "amount", "n", (F.col("upto") - F.col("n")).alias("n_before"),
                       (F.col("sums") - F.coalesce(F.col("amount") * F.col("n"), F.lit(0))).cast("long").alias("sum_before"), "n_all", "sum_all")
    got = cumulative_histogram(df, "key", "amount").withColumns(
        {c: F.col(c).cast("long") for c in ("sum_before", "sum_all")})
    assert rows(got) == rows(want)


def test_exact_median_equals_builtin_median(spark):
    from ballotlens.operators.quantiles import count_and_median, exact_median
    rnd = random.Random(5)
    data = [("hot" if rnd.random() < 0.5 else f"g{rnd.randint(0, 9)}",
             rnd.choice([None, rnd.randint(-50, 500)])) for _ in range(2001)]
    data += [("single", 7), ("pair", 1), ("pair", 4), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, x long")
    plain = df.groupBy("g").agg(F.count("*").alias("n"), F.median("x").alias("m"))
    assert rows(count_and_median(df, "g", "x", "n", "m"), ["g", "n", "m"]) == rows(plain, ["g", "n", "m"])
    assert rows(exact_median(df, "g", "x", "m"), ["g", "m"]) == rows(plain.filter("m is not null"), ["g", "m"])


def test_asof_latest_ignores_events_without_epoch(spark):
    ev = spark.createDataFrame([("d", 5, 1, "REG"), ("d", None, 9, "RET")], "k string, epoch int, slot long, status string")
    sn = spark.createDataFrame([("d", 6, "s"), (None, 6, "n")], "k string, epoch int, id string")
    assert rows(asof_latest(sn, ev, "k", "epoch", ["slot"], "status"), ["id", "status"]) == [("n", None), ("s", "REG")]
