import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.functions.arithmetic import cagr, growth, ratio, ratio_if_positive, weighted_mean
from marlstone.operators import cross_section as cs
from marlstone.operators import relational as rel
from marlstone.operators import series as ts
from marlstone.operators.asof import asof_join

D = dt.date(2024, 1, 1)


def one(spark, c):
    return spark.range(1).select(c.alias("c")).first()[0]


@pytest.mark.parametrize(("text", "whole", "strict", "number"), [("123.9", 123, None, 123.9), ("7", 7, 7, 7.0), ("None", None, None, None), ("", None, None, None), ("null", None, None, None), ("1e3", 1000, None, 1000.0), ("abc", None, None, None), (" 5 ", 5, 5, 5.0), (None, None, None, None)])
def test_cleaners(spark, text, whole, strict, number):
    c = F.lit(text).cast("string")
    assert (one(spark, clean.to_long(c)), one(spark, clean.to_long_strict(c)), one(spark, clean.to_double(c))) == (whole, strict, number)


def test_dates_and_labels(spark):
    assert one(spark, clean.compact_timestamp(F.lit("20240105T1530"))) == one(spark, clean.compact_timestamp(F.lit("20240105T153000"))) == dt.datetime(2024, 1, 5, 15, 30)
    assert one(spark, clean.to_date(F.lit("2024-13-01"))) is None and one(spark, clean.quarter_label(F.lit(D))) == "2024Q1"
    assert [one(spark, clean.short_number(F.lit(x))) for x in (1.5e12, -2.5e9, 3e6, 4e3, 5.0)] == ["1.5T", "-2.5B", "3.0M", "4.0K", "5.0"]


def test_weekdays(spark):
    r = random.Random(1)
    for _ in range(15):
        lo, hi = D + dt.timedelta(days=r.randrange(60)), D + dt.timedelta(days=r.randrange(60))
        want = sum((lo + dt.timedelta(days=i)).weekday() < 5 for i in range(1, (hi - lo).days + 1))
        assert one(spark, clean.weekdays_between(F.lit(lo), F.lit(hi))) == want


def test_jitter_is_fixed_and_bounded(spark):
    import zlib

    for s in ("AAA", "ZZZ", "Q-B"):
        assert one(spark, clean.jitter_days(F.lit(s), 60)) == zlib.crc32(s.encode()) % 19 - 9
        assert one(spark, clean.jitter_days(F.lit(s), 6)) == 0


def test_guards(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None and one(spark, ratio_if_positive(F.lit(1), F.lit(-1))) is None
    assert one(spark, growth(F.lit(1.0), F.lit(-2.0))) == -1.5
    assert one(spark, cagr(F.lit(1.0), F.lit(8.0), 3)) == pytest.approx(1.0) and one(spark, cagr(F.lit(-1.0), F.lit(8.0), 3)) is None
    w = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (3.0, None)], "x double, w double").select(weighted_mean(F.col("x"), F.col("w"))).first()[0]
    assert w == 0.5  # a null value keeps its weight, a null weight is none


def test_asof(spark):
    r = random.Random(4)
    right = {("A", D + dt.timedelta(days=r.randrange(60))): i for i in range(15)}
    left = [(r.choice(["A", "B", None]), D + dt.timedelta(days=r.randrange(60)) if r.random() > 0.1 else None, i) for i in range(80)]
    rdf = spark.createDataFrame([(k, d, v, None if v % 2 else v) for (k, d), v in right.items()] + [(None, D, 99, 99), ("A", None, 98, 98)], "k string, d date, v int, w int")
    for equal in (True, False):
        out = asof_join(spark.createDataFrame(left, "k string, t date, id int"), rdf, ["k"], "t", "d", ["v", "w"], equal).collect()
        assert len(out) == len(left)
        for x in out:
            ok = [(d, v) for (k, d), v in right.items() if k == x.k and x.t and (d <= x.t if equal else d < x.t)]
            v = max(ok)[1] if ok else None
            assert (x.v, x.w) == (v, None if v is None or v % 2 else v)


def test_upsert_is_idempotent(spark, tmp_path):
    path, order = str(tmp_path / "t"), [F.desc("pulled")]
    def batch(rows, schema="k int, pulled int, v string"):
        return spark.createDataFrame(rows, schema)
    rel.upsert_parquet(batch([(1, 1, "a"), (2, 1, "b"), (2, 1, "b")]), path, ["k"], order)
    for _ in range(2):
        rel.upsert_parquet(batch([(1, 2, "A"), (2, 0, "old"), (3, 1, "c")]), path, ["k"], order)
        assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, "A"), (2, "b"), (3, "c")}
    rel.upsert_parquet(batch([(4, 1, "d", 5)], "k int, pulled int, v string, extra int"), path, ["k"], order)
    assert spark.read.parquet(path).where("extra is null").count() == 3


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 2022, 1, "a"), (2, 2023, 1, "b"), (3, 2024, 1, "c")]
    rel.overwrite(spark.createDataFrame(rows, "k int, year int, pulled int, v string"), path, "year")
    before = (tmp_path / "t" / "year=2022").stat().st_mtime_ns
    assert rel.upsert_partitions(spark.createDataFrame([(3, 2024, 2, "C"), (4, 2024, 1, "d")], "k int, year int, pulled int, v string"), path, ["k"], [F.desc("pulled")], "year") == [2024]
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "b"), (3, "C"), (4, "d")}
    assert (tmp_path / "t" / "year=2022").stat().st_mtime_ns == before


def test_latest_dominant_and_match(spark):
    df = spark.createDataFrame([(None, 1, "n"), (None, 2, "m"), (1, 1, "a"), (1, None, "z")], "k int, o int, v string")
    assert {(r.k, r.v) for r in rel.latest_by(df, ["k"], [F.desc_nulls_last("o")]).collect()} == {(None, "m"), (1, "a")}
    e = spark.createDataFrame([("a", "12-31"), ("a", "12-31"), ("a", "06-30"), ("b", "01-01"), ("b", "02-02"), ("c", "03-31"), ("c", "04-30"), ("c", "05-31")], "s string, md string")
    assert sorted((r.s, r.md) for r in rel.dominant(e, ["s"], F.col("md"), F.col("md")).collect()) == [("a", "12-31"), ("a", "12-31"), ("b", "01-01"), ("b", "02-02"), ("c", "03-31")]
    left, right = spark.createDataFrame([("A.B",), ("X-Y",), ("Q",), (None,)], "a string"), spark.createDataFrame([("AB",), ("X.Y",), ("XY",), ("Q",)], "b string")
    assert {r.a: (r.matched, r.how) for r in rel.match_symbols(left, right, "a", "b").collect()} == {"A.B": ("AB", "flat"), "X-Y": (None, "gap"), "Q": ("Q", "exact"), None: (None, "gap")}


def test_incremental(spark):
    new, done = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    assert sorted(r.k for r in rel.not_yet(new, done, ["k"]).collect()) == [1, 3]
    assert [r.k for r in rel.above_high_water(new, done, "k").collect()] == [3]
    assert rel.above_high_water(new, done.limit(0), "k").count() == 3


def prices(n=120, seed=3):
    r = random.Random(seed)
    out, x = [], 100.0
    for i in range(n):
        x *= 1 + r.uniform(-0.03, 0.03)
        out.append(("A", D + dt.timedelta(days=i), round(x, 4), round(x * 1.01, 4), round(x * 0.99, 4)))
    return out + [("B", D, 5.0, 6.0, 4.0)] + [("C", D + dt.timedelta(days=i), 10.0 + i, 11.0 + i, 9.0 + i) for i in range(40)]


def test_indicators_equal_pandas(spark):
    data = prices()
    df = spark.createDataFrame(data, "s string, d date, c double, h double, l double")
    got = {(r.s, r.d): r for r in ts.with_indicators(df, "s", "d", "c", "h", "l", "c").collect()}
    x = pd.Series([p[2] for p in data if p[0] == "A"])
    e12 = x.ewm(span=12, adjust=False, min_periods=12).mean()
    e26 = x.ewm(span=26, adjust=False, min_periods=26).mean()
    macd = e12 - e26
    signal = macd.ewm(span=9, adjust=False, min_periods=9).mean()
    for i in range(120):
        r = got["A", D + dt.timedelta(days=i)]
        for mine, want in ((r.ema_12, e12[i]), (r.macd, macd[i]), (r.macd_signal, signal[i])):
            assert (mine is None and want != want) or mine == pytest.approx(want)
    assert [i for i in range(120) if got["A", D + dt.timedelta(days=i)].rsi_14 is not None][0] == 14
    assert all(got["C", D + dt.timedelta(days=i)].rsi_14 is None for i in range(40))  # only gains
    assert got["B", D].ema_12 is None and got["A", D + dt.timedelta(days=13)].atr_14 is not None


def test_rolling_and_densify(spark):
    df = spark.createDataFrame([("a", D + dt.timedelta(days=i), v) for i, v in ((0, 1.0), (1, None), (4, 3.0))] + [("b", D, 7.0)], "k string, d date, v double")
    w = ts.series("k", "d")
    got = {(r.k, r.d): r.m for r in df.withColumn("m", ts.rolling(F.sum, F.col("v"), w, 3, 2)).collect()}
    assert got["a", D] is None and got["a", D + dt.timedelta(days=4)] == 4.0
    dense = ts.densify(df, "k", "d", {"v": F.lit(0.0)}).collect()
    assert len(dense) == 6 and {r.d: r.v for r in dense if r.k == "a"}[D + dt.timedelta(days=2)] == 0.0


def test_lookback(spark):
    r = random.Random(9)
    spine = [(r.choice("ab"), D + dt.timedelta(days=r.randrange(100))) for _ in range(40)] + [("none", D)]
    facts = [(r.choice("ab"), D + dt.timedelta(days=r.randrange(100)), i) for i in range(150)]
    out = cs.lookback(spark.createDataFrame(spine, "k string, at date").distinct(), spark.createDataFrame(facts, "k string, d date, i int"), "k", "at", "d", 10)
    want = {(k, t, i) for k, t in set(spine) for k2, d, i in facts if k == k2 and 0 <= (t - d).days <= 10}
    rows = out.collect()
    assert {(x.k, x["at"], x.i) for x in rows if x.i is not None} == want and sum(x.i is not None for x in rows) == len(want)
    assert {x.k for x in rows if x.i is None} >= {"none"}


def test_standing_of_one_and_of_ties(spark):
    long = spark.createDataFrame([("g", "m", 1.0), ("g", "m", 1.0), ("g", "m", 3.0), ("h", "m", 5.0), (None, "m", 2.0), (None, "m", 4.0)], "s string, metric string, value double")
    got = {(r.s, r.value): r for r in cs.relative_standing(long, "s").collect()}
    assert got["h", 5.0].pct_rank == 0.0 and got["h", 5.0].z is None and got["g", 1.0].pct_rank == 0.0 and got["g", 3.0].pct_rank == 1.0
    assert got[None, 2.0].pct_rank is None and got[None, 2.0].z is not None


def test_peers_prefer_the_narrow_group_when_it_suffices(spark):
    m = [(f"n{i}", "S", "I", 10.0 + i) for i in range(4)] + [(f"w{i}", "S", "J", 10.0) for i in range(3)] + [("big", "S", "I", 10.0 * 1e4)]
    df = spark.createDataFrame(m, "k string, s string, i string, cap double")
    x = spark.createDataFrame([], "k string, t date, x double")
    def of(most):
        rows = cs.peers(df, x, "k", "t", "x", "cap", ("s", "i"), most, 2.0, 5, (0.6, 0.4)).where("key = 'n0'").orderBy("rank").collect()
        return [r.peer for r in rows]
    assert of(3) == ["n1", "n2", "n3"]
    assert of(5) == ["n1", "n2", "n3", "w0", "w1"]


def test_top_share(spark):
    df = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 3.0), ("a", "z", 3.0), ("a", "n", None)], "s string, h string, v double")
    r = cs.top_share(df, ["s"], "v", [1, 2], [F.col("h")]).first()
    assert (r.top1, r.top2, r.total, r.members) == (5.0, 8.0, 11.0, 3)


def test_sample_is_reproducible(spark):
    df = spark.range(1000)
    a, b = (sorted(r.id for r in rel.sample_rows(x, ["id"], 20, 7).collect()) for x in (df, df.repartition(13)))
    assert a == b and len(a) == 20 and a != sorted(r.id for r in rel.sample_rows(df, ["id"], 20, 8).collect())
