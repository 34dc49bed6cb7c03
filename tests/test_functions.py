"""Scalar rules D1, D3, D4, ratio (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from ballotlens.functions import epoch_seconds, json_num, parse_json_strings, pct, ratio, seconds_between


def test_epoch_seconds_round_half_even(spark):
    base = dt.datetime(1970, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(microseconds=m),) for m in (500_000, 1_500_000, 700_000)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(epoch_seconds("ts")).collect()]
    assert got == [0, 2, 1]


def test_seconds_between_rounds_after_subtracting(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 1, 400_000)
    b = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b")).first()[0] == 0      # 0.5 -> 0 (half-even)


def test_json_num_matches_numeric_text_casts(spark):
    vals = ["12.6", "12.5", "-12.5", "1.0", "1.23E10", "", "abc", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(json_num("v", "bigint")).collect()]
    assert got == [13, 13, -13, 1, 12300000000, None, None, None]
    assert [r[0] for r in df.select(json_num("v", "int")).collect()][:4] == [13, 13, -13, 1]


def test_parse_json_missing_null_malformed(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": null, "b": 2}',), ("{not json",)], "s string")
    p = df.select(parse_json_strings("s", {"a": None, "b": None}).alias("p"))
    got = [(r.p.a if r.p else None, r.p.b if r.p else None) for r in p.collect()]
    assert got == [("1", None), (None, "2"), (None, None)]


def test_ratio_and_pct_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "n long, d long")
    assert [r[0] for r in df.select(ratio("n", "d")).collect()] == [None, 0.25, None]
    assert [r[0] for r in df.select(pct("n", "d")).collect()] == [None, 25.0, None]
    assert df.select(pct(F.lit(1), F.lit(3))).first()[0] == 33.3333
