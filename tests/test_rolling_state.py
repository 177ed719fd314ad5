import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marlstone.operators import rolling_state as rs
from marlstone.operators.rolling_state import Measure

D = dt.date(2024, 1, 1)
SCHEMA = "sym string, d date, v bigint, x double, pulled date, entity string, day string"


def measures():
    return [Measure("v", F.col("v"), (3, 7), F.col("v") > 0, scale=0), Measure("x", F.col("x"), (5,))]


def rows(n=300, seed=1):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        d = D + dt.timedelta(days=r.randrange(40))
        # one key holds about half of all rows; some values are null, NaN or repeated
        out.append((r.choice(["A", "A", "B", "C", None]), d if r.random() > 0.03 else None, r.choice([None, 0, 5, 7]), r.choice([None, 1.25, -2.5, float("nan"), float("inf")]), d + dt.timedelta(days=r.choice([0, 1, 20])), "clash", "clash"))
    return out + out[:10]


def expected(data):
    best, use = {}, {}
    for s, d, v, x, p, *_ in data:
        if s is None or d is None:
            continue
        x_ok = None if x is None or x != x or x in (float("inf"),) else Decimal(str(x))
        rank = (p, v is not None, v or 0, x_ok is not None, x_ok or 0)
        if (s, d) not in best or rank > best[s, d][0]:
            best[s, d] = (rank, v, x_ok)
        u = use.setdefault((s, d), [0, 0])
        u[0] += bool(v and v > 0)
        u[1] += x is not None
    out = {}
    for s in {k[0] for k in best}:
        days = [d for k, d in best if k == s]
        d = min(days)
        while d <= max(days):
            row = []
            for i, w in ((0, 3), (0, 7), (1, 5)):
                inside = [d - dt.timedelta(days=k) for k in range(w)]
                vals = [best[s, e][1 + i] for e in inside if (s, e) in best]
                vals = [y for y in vals if y is not None]
                row += [Decimal(sum(vals)), len(vals), sum(use[s, e][i] for e in inside if (s, e) in use), 0]
            out[s, d] = tuple(row)
            d += dt.timedelta(days=1)
    return out


def got(state):
    cols = rs.state_columns(measures())
    return {(r.entity, r.day): tuple(r[c] for c in cols) for r in state.where("live").collect()}


def book(df):
    return rs.ledger(df, "sym", "d", measures(), [F.col("pulled")], F.col("pulled"))


@pytest.mark.parametrize("seed", [1, 2])
def test_build_equals_windows(spark, seed):
    data = rows(seed=seed)
    assert got(rs.build(book(spark.createDataFrame(data, SCHEMA)), measures())) == expected(data)


def test_corrections_reach_the_same_state(spark):
    data = rows()
    late = F.datediff("pulled", "d") > 10
    df = spark.createDataFrame(data, SCHEMA)
    assert got(rs.maintain(df, "sym", "d", measures(), [F.col("pulled")], F.col("pulled"), late)) == expected(data)


def test_corrections_touch_only_reached_dates(spark):
    data = [("A", D + dt.timedelta(days=i), 1, 1.0, D, "", "") for i in range(30)]
    fix = ("A", D + dt.timedelta(days=10), 9, 1.0, D + dt.timedelta(days=40), "", "")
    before, after = book(spark.createDataFrame(data, SCHEMA)), book(spark.createDataFrame([*data, fix], SCHEMA))
    new = rs.correct(rs.build(before, measures()), before, after, measures()).where("live")
    touched = {r.day for r in new.where(F.col("version") == fix[4]).collect()}
    assert touched == {D + dt.timedelta(days=i) for i in range(10, 17)}
    assert got(new) == expected([*data, fix])


def test_advance_is_one_step_of_build(spark):
    data = [r for r in rows() if r[0] and r[1]]
    b = book(spark.createDataFrame(data, SCHEMA))
    state = rs.build(b, measures())
    want = {k: v for k, v in expected(data).items()}
    for i in (1, 8, 30):
        d = D + dt.timedelta(days=i)
        step = got(rs.advance(state, b, F.lit(d), measures()))
        for (s, e), v in want.items():
            if e == d and (s, d) in step:
                assert step[s, d] == v
        assert {s for s, e in want if e == d} >= {s for s, _ in step} >= {r[0] for r in data if r[1] == d}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rs.build(book(df), measures()).count() == 0
    assert rs.maintain(df, "sym", "d", measures(), [F.col("pulled")], F.col("pulled"), F.lit(None).cast("boolean")).count() == 0


def test_corrections_of_spans(spark):
    """Entities that begin earlier, end later (beyond the expiry of what was there), come or go."""
    day = lambda i: D + dt.timedelta(days=i)
    def rows_of(pairs):
        return [(e, day(i), 5, 1.0, day(60), "", "") for e, i in pairs]
    old = rows_of([("A", 10), ("A", 12), ("B", 3), ("C", 5), ("C", 6), ("F", 1)])
    new = rows_of([("A", 4), ("A", 12), ("A", 40), ("B", 3), ("C", 6), ("N", 9)])
    before, after = (book(spark.createDataFrame(x, SCHEMA)) for x in (old, new))
    assert got(rs.correct(rs.build(before, measures()), before, after, measures())) == expected(new)


def test_large_amounts(spark):
    big = [Measure("x", F.col("x"), (3,))]
    data = [("A", D + dt.timedelta(days=i), 1, x, D, "", "") for i, x in enumerate([5e22, 1.0, 1e30, 2.0, 3.0, 4.0, None])]
    b = rs.ledger(spark.createDataFrame(data, SCHEMA), "sym", "d", big, [F.col("pulled")], F.col("pulled"))
    got = {r.day.day: (float(r.sum_x_3), r.n_x_3, r.over_x_3) for r in rs.build(b, big).where("live").collect()}
    assert got[1] == (5e22, 1, 0) and got[2] == (5e22 + 1, 2, 0) and got[3][1:] == (2, 1) and got[6] == (9.0, 3, 0) and got[7] == (7.0, 2, 0)


def test_unreached_rows_pass_without_a_shuffle(spark):
    late = F.datediff("pulled", "d") > 10
    out = rs.maintain(spark.createDataFrame(rows(), SCHEMA), "sym", "d", measures(), [F.col("pulled")], F.col("pulled"), late)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and re.search(r"DataFilters: \[[^\]]*NOT stale", line))
    depth = scan.index("FileScan")
    above = [line for line in plan[: plan.index(scan)].splitlines() if "Exchange" in line and len(line) - len(line.lstrip(" :+-")) < depth]
    assert not above
