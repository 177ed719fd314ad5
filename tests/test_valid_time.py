import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators import valid_time as vt

D = dt.date(2024, 1, 1)


def day(i):
    return D + dt.timedelta(days=i)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 500), st.integers(0, 500))
def test_cover_is_exact(a, b):
    """The decomposition in plain numbers: each point of [lo, hi) has one enclosing node, others none."""
    lo, hi = min(a, b), max(a, b)
    nodes = []
    for k in range(10):
        left, right = (lo + (1 << k) - 1) >> k, hi >> k
        if left < right:
            nodes += [(k, left)] if left % 2 else []
            nodes += [(k, right - 1)] if right % 2 else []
    for t in range(0, 512):
        assert sum((k, t >> k) in nodes for k in range(10)) == (lo <= t < hi)


def versions(spark, data):
    return spark.createDataFrame(data, "e string, as_of date, pulled date, v bigint, node string")


def run(spark, events, vers):
    ev = spark.createDataFrame(events, "e string, t date, lo int, entity string")
    iv = vt.first_known(versions(spark, vers), "e", F.greatest("as_of", "pulled"), [F.col("as_of"), F.col("pulled")], [F.col("v")])
    return vt.as_of(ev, "e", "t", {"known": iv})


def brute(e, t, vers):
    ok = [(a, p, v) for s, a, p, v, _ in vers if s == e and e is not None and t and a and p and a <= t and p <= t]
    return max(ok)[2] if ok else None


def test_against_brute_force(spark):
    r = random.Random(5)
    vers = [(r.choice(["A", "A", "B", None]), day(r.randrange(100)), day(r.randrange(120)), r.randrange(1000), "") for _ in range(120)]
    vers += vers[:5]
    events = [(r.choice(["A", "A", "B", "Z", None]), day(r.randrange(140)) if r.random() > 0.1 else None, 7, "x") for _ in range(300)]
    out = run(spark, events, vers).collect()
    assert len(out) == len(events)
    for x in out:
        assert (x.known.v if x.known else None) == brute(x.e, x.t, vers)
        assert (x.lo, x.entity) == (7, "x")


def test_empty_sides(spark):
    assert run(spark, [], [("A", D, D, 1, "")]).count() == 0
    assert run(spark, [("A", D, 1, "")], []).collect()[0].known is None
    assert run(spark, [(None, None, 1, "")], [("A", D, D, 1, "")]).collect()[0].known is None


def test_half_open_and_precedence(spark):
    vers = [("A", day(0), day(5), 1, ""), ("A", day(3), day(8), 2, ""), ("A", day(1), day(20), 3, "")]
    out = {x.t: x.known and x.known.v for x in run(spark, [("A", day(i), 0, "") for i in (4, 5, 7, 8, 20, 30)], vers).collect()}
    assert out == {day(4): None, day(5): 1, day(7): 1, day(8): 2, day(20): 2, day(30): 2}


def test_values_of_later_the_same_day_are_not_known(spark):
    at = lambda i, h: dt.datetime(2024, 1, 1 + i, h)
    iv = vt.first_known(spark.createDataFrame([("A", at(1, 15), 1), ("A", at(1, 8), 0)], "e string, k timestamp, v int"), "e", F.col("k"), [F.col("k")], [F.col("v")])
    for kind, times in (("timestamp", [at(1, 7), at(1, 9), at(1, 15), at(2, 0)]), ("timestamp_ntz", [at(1, 7), at(1, 9), at(1, 15), at(2, 0)]), ("date", [day(1), day(1), day(2), day(2)])):
        ev = spark.createDataFrame([("A", t, i) for i, t in enumerate(times)], f"e string, t {kind}, i int")
        got = [r.known and r.known.v for r in vt.as_of(ev, "e", "t", {"known": iv}).orderBy("i").collect()]
        assert got == ([None, 0, 1, 1] if kind != "date" else [None, None, 1, 1])


def test_timestamps_against_brute_force(spark):
    r = random.Random(8)
    base = dt.datetime(2023, 12, 25)
    moment = lambda: base + dt.timedelta(seconds=r.randrange(20 * 86400))
    vers = [(r.choice(["A", "A", "B"]), moment(), r.randrange(100)) for _ in range(300)]
    events = [(r.choice(["A", "A", "B", "Z"]), r.choice(vers)[1] if r.random() < 0.3 else moment()) for _ in range(400)]
    iv = vt.first_known(spark.createDataFrame(vers, "e string, k timestamp, v int"), "e", F.col("k"), [F.col("v")], [F.col("v").alias("v")])
    for grain in (vt.DAY, 3600):
        for x in vt.as_of(spark.createDataFrame(events, "e string, t timestamp"), "e", "t", {"known": iv}, grain).collect():
            ok = [v for e, k, v in vers if e == x.e and k <= x.t]
            assert (x.known and x.known.v) == (max(ok) if ok else None)
