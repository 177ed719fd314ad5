import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import log_sketch as ls

ACC = 0.01


def data(n=4000, seed=3):
    r = random.Random(seed)
    # a third of all rows in one group; negative, tiny, huge, null and NaN values
    vals = [r.lognormvariate(0, 4) * r.choice([1, 1, -1]) for _ in range(n)] + [0.0] * 50 + [None, float("nan")] * 20
    return [(r.choice(["a", "b", "b", None]), v, 1) for v in vals]


def test_error_bound_and_merge(spark):
    rows = data()
    df = spark.createDataFrame(rows, "g string, x double, n int")
    qs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    parts = [ls.sketch(df.where(F.pmod(F.hash("x"), F.lit(3)) == i), ["g"], F.col("x"), ACC) for i in range(3)]
    merged = ls.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g"])
    for source in (merged, ls.sketch(df, ["g"], F.col("x"), ACC)):
        for r in ls.quantiles(source, ["g"], qs, ACC).collect():
            xs = sorted(v for g, v, _ in rows if g == r.g and v is not None and not math.isnan(v))
            assert r.n == len(xs)
            for name, q in qs.items():
                exact = xs[math.floor(q * (len(xs) - 1))]
                assert abs(r[name] - exact) <= ACC * abs(exact) * (1 + 1e-9)


def test_buckets_sort_as_values(spark):
    xs = sorted([*np.random.default_rng(1).normal(0, 1e3, 500).tolist(), 0.0, 1e-300, -1e-300, 1e300, -1e300, float("inf"), float("-inf")])
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", ls.bucket(F.col("x"), ACC).alias("b")).orderBy("x", "b")
    got = [r.b for r in df.collect()]
    assert got == sorted(got) and None not in got


@pytest.mark.parametrize("rows", [[], [("a", None, 1)], [("a", float("nan"), 1)]])
def test_no_values(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double, n int")
    assert ls.quantiles(ls.sketch(df, ["g"], F.col("x"), ACC), ["g"], {"m": 0.5}, ACC).count() == 0


def test_one_value_and_infinity(spark):
    df = spark.createDataFrame([("a", 5.0, 1), ("b", float("inf"), 1), ("b", float("-inf"), 1)], "g string, x double, n int")
    got = {r.g: r for r in ls.quantiles(ls.sketch(df, ["g"], F.col("x"), ACC), ["g"], {"lo": 0.0, "hi": 1.0}, ACC).collect()}
    assert abs(got["a"].lo - 5) <= 0.05 and (got["b"].lo, got["b"].hi) == (float("-inf"), float("inf"))


def test_reserved_names(spark):
    df = spark.createDataFrame([("a", 5.0, 1)], "bucket string, x double, n int")
    with pytest.raises(ValueError, match="names"):
        ls.sketch(df, ["bucket"], F.col("x"), ACC)
    assert ls.sketch(df, [F.col("bucket").alias("g")], F.col("x"), ACC).count() == 1


@pytest.mark.parametrize("acc", [1e-6, 1e-4, 0.5])
def test_finest_and_coarsest(spark, acc):
    xs = [-1e308, -1.0, -1e-250, -5e-324, 0.0, 5e-324, 1e-250, 1e-6, 1.0, 1.7e308]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", ls.bucket(F.col("x"), acc).alias("b")).select("x", "b", ls.midpoint(F.col("b"), acc).alias("m")).orderBy("x")
    got = df.collect()
    assert [r.b for r in got] == sorted({r.b for r in got})
    for r in got:
        if abs(r.x) > 2.3e-308:
            assert abs(r.m - r.x) <= acc * abs(r.x) * (1 + 1e-3) + abs(r.x) * 1e-9


@pytest.mark.parametrize("acc", [1e-7, 0.0, -1.0, 0.6])
def test_accuracy_out_of_range(acc):
    with pytest.raises(ValueError, match="accuracy"):
        ls.bucket(F.lit(1.0), acc)
