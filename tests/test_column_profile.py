import random
import statistics

import pytest
from pyspark.sql import functions as F

from marlstone.operators import column_profile as cp

SCHEMA = "load int, x double, s string, big1 int, nulls1 string"


def data(seed=2):
    r = random.Random(seed)
    return [(r.choice([1, 1, 2, 3, None]), r.choice([None, float("nan"), -1.0, round(r.lognormvariate(3, 1), 4)]), r.choice(["AB", "AB-C", "ab", None, "A\n"]), 1, "") for _ in range(900)]


def checks(distinct=True):
    x, s = F.col("x"), F.col("s")
    bad = x.isNotNull() & (F.isnan(x) | (x <= 0))
    return [cp.Check("x", x, number=F.when(~bad, x), violations={"range": bad}, distinct=distinct), cp.Check("s", s, violations={"pattern": ~s.rlike("^[A-Z-]+$")})]


def profiles(df, distinct=True):
    return {(r.load, r.column_name): r for r in cp.moments(cp.profile(cp.cells(df, ["load"], checks(distinct)), ["load"])).collect()}


@pytest.mark.parametrize("distinct", [True, False])
def test_counts_and_exact_sums(spark, distinct):
    rows = data()
    out = profiles(spark.createDataFrame(rows, SCHEMA), distinct)
    for load in (1, 2, 3, None):
        mine = [r for r in rows if r[0] == load]
        good = [r[1] for r in mine if r[1] is not None and r[1] > 0]
        p = out[load, "x"]
        assert (p.n, p.nulls, p.v_range, p.s0, p.big) == (len(mine), sum(r[1] is None for r in mine), sum(r[1] is not None and not r[1] > 0 for r in mine), len(good), 0)
        ticks = [round(v * 10000) for v in good]
        assert [int(p.s1), int(p.s2), int(p.s3)] == [sum(t**k for t in ticks) for k in (1, 2, 3)]
        mean, sd = statistics.mean(good), statistics.pstdev(good)
        assert p["mean"] == pytest.approx(mean) and p.sd == pytest.approx(sd) and p["skew"] == pytest.approx(sum(((v - mean) / sd) ** 3 for v in good) / len(good))
        assert (p.lo, p.hi) == (min(good), max(good)) and p.med_lo <= statistics.median(good) <= p.med_hi <= p.med_lo * 1.11
        assert p.n_distinct == (len({str(r[1]) for r in mine if r[1] is not None}) if distinct else None)
        texts = [r[2] for r in mine if r[2] is not None]
        t = out[load, "s"]
        assert (t.nulls, t.n_distinct, t.lo_text, t.hi_text) == (len(mine) - len(texts), len(set(texts)), min(texts), max(texts))


def test_large_numbers_are_not_left_out(spark):
    df = spark.createDataFrame([(1, 2e7, "a", 1, ""), (1, 3e7, "a", 1, ""), (1, 5.0, "a", 1, ""), (2, 5e22, "a", 1, ""), (2, float("inf"), "a", 1, "")], SCHEMA)
    out = profiles(df)
    p = out[1, "x"]
    assert (p.s0, p.big, p.hi) == (3, 2, 3e7) and p["mean"] == pytest.approx(50000005 / 3) and p.sd == pytest.approx(statistics.pstdev([2e7, 3e7, 5.0]))
    assert (out[2, "x"].n, out[2, "x"].s0) == (2, 1) and out[2, "x"]["mean"] == pytest.approx(5e22)


def test_merge_equals_whole(spark):
    df = spark.createDataFrame(data(), SCHEMA).where("load is not null")
    halves = [cp.cells(df.where(F.col("load") == k).withColumn("all", F.lit(1)), ["all"], checks()) for k in (1, 2, 3)]
    merged = cp.profile(cp.merge(halves[0].unionByName(halves[1]).unionByName(halves[2]), ["all"]), ["all"])
    whole = cp.profile(cp.cells(df.withColumn("all", F.lit(1)), ["all"], checks()), ["all"])
    cols = sorted(whole.columns)
    assert sorted(map(str, merged.select(cols).collect())) == sorted(map(str, whole.select(cols).collect()))


def test_medians(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    number = F.when(F.col("x") > 0, F.col("x"))
    parts = cp.cells(df, ["load"], checks()).where("column_name = 'x'")
    wanted = cp.middle(parts, ["load"])
    for values in (cp.cell_values(parts, ["load"]), cp.number_values(df, ["load"], number)):
        got = {r.load: r.median for r in cp.settle(values, wanted, ["load"]).collect()}
        for load in (1, 2, 3):
            assert got[load] == pytest.approx(statistics.median(r[1] for r in rows if r[0] == load and r[1] is not None and r[1] > 0), abs=0)


def test_bounds_never_contradict_the_medians(spark):
    r = random.Random(5)
    loads = [[r.choice([-1, 1]) * r.lognormvariate(r.uniform(-3, 6), r.uniform(0, 2)) if k % 3 == 0 else r.lognormvariate(r.uniform(-1, 3), 1) for _ in range(r.randrange(1, 60))] for k in range(120)]
    df = spark.createDataFrame([(k, x, "", 1, "") for k, xs in enumerate(loads) for x in xs], SCHEMA)
    x = F.col("x")
    rows = cp.moments(cp.profile(cp.cells(df, ["load"], [cp.Check("x", x, number=x)]), ["load"]))
    surely, unsure = cp.median_moved(4.0, 0.25)
    out = cp.against_previous(rows, "load", ["column_name"], ["mean", "sd", "med_lo", "med_hi"]).where("has_prev").select("load", cp.may_differ(4.0, 0.25).alias("may"), surely.alias("sure"), unsure.alias("open")).collect()
    moved = 0
    for row in out:
        now, before = statistics.median(loads[row.load]), statistics.median(loads[row.load - 1])
        truth = now > 4 * before or now < before / 4
        moved += truth
        assert not (truth and not row.may) and not (row.sure and not truth) and not (truth and not row.sure and not row.open)
    assert len(out) == 119 and moved > 10


def test_against_previous_and_shift(spark):
    df = spark.createDataFrame([("t", 1, 1.0, 1.0), ("t", 2, 3.0, 1.0), ("t", 4, 3.0, 1.0)], "t string, load int, mean double, sd double")
    out = {r.load: r for r in cp.against_previous(df, "load", ["t"], ["mean", "sd"]).withColumn("d", cp.standardised_difference()).collect()}
    assert (out[1].d, out[2].d, out[4].d, out[4].has_prev) == (None, 2.0, None, None)


def test_empty_and_reserved(spark):
    empty = spark.createDataFrame([], SCHEMA)
    parts = cp.cells(empty, ["load"], checks())
    assert cp.profile(parts, ["load"]).count() == 0 and cp.settle(cp.cell_values(parts, ["load"]), cp.middle(parts, ["load"]), ["load"]).count() == 0
    with pytest.raises(ValueError, match="load"):
        cp.cells(empty.withColumnRenamed("load", "key"), ["key"], checks())
