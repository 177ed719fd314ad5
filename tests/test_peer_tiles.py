import math
import random

import numpy as np
import pyarrow as pa
import pytest

from marlstone.operators import cross_section as cs
from marlstone.operators import peer_tiles


def one(x, y):
    x, y = np.asarray(x), np.asarray(y)
    if not (np.isfinite(x).all() and np.isfinite(y).all()) or np.ptp(x) == 0 or np.ptp(y) == 0:
        return math.nan
    x, y = x - x.mean(), y - y.mean()
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()))


def table(members, series):
    return pa.table({
        "key": pa.array([m[0] for m in members], pa.string()), "n": pa.array([m[1] for m in members], pa.string()), "s": pa.array([m[2] for m in members], pa.float64()),
        "ts": pa.array([list(series[m[0]]) if m[0] in series else None for m in members], pa.list_(pa.int32())), "xs": pa.array([list(series[m[0]].values()) if m[0] in series else None for m in members], pa.list_(pa.float64())),
    })


@pytest.mark.parametrize("times", [40, 3 * peer_tiles.TIMES + 5])
def test_correlations_pair_by_pair(times):
    """Gaps, flat series, levels that shift between the times two members share, far outliers, values that are not finite."""
    r = random.Random(times)
    def shape(i, t):
        z = r.gauss(0, 1)
        return (z, 1e6 + z, 3.25, z + (1e7 if t > times // 2 else 0.0), 1e12 if t == 3 else z, 1e200 * z, math.nan if t == 5 else z, 0.0 if t > 8 else z)[i % 8]
    names = [f"k{i:02d}" for i in range(40)]
    series = {k: {t: shape(i, t) for t in r.sample(range(times), times) if r.random() > 0.3 and (i < 20 or t > times // 2 + 1)} for i, k in enumerate(names) if i != 9}
    rows = table([(k, "n", 1.0) for k in names], series)
    a, b, shared = peer_tiles.sides(rows, rows)
    c, has = peer_tiles.correlations(a, b, shared, slice(0, 40), np.ones((40, 40), bool), 12)
    for i, k in enumerate(names):
        for j, p in enumerate(names):
            both = sorted(set(series.get(k, {})) & set(series.get(p, {})))
            assert has[i, j] == (len(both) >= 12)
            if has[i, j]:
                assert c[i, j] == pytest.approx(one([series[k][t] for t in both], [series[p][t] for t in both]), abs=1e-10, nan_ok=True)


def frames(spark, count, times, r, narrow="abc"):
    firms = [(f"k{i:03d}", r.choice("XY"), r.choice(narrow), 10 ** r.uniform(0, 3)) for i in range(count)]
    days = [(k, t, r.gauss(0, 1)) for k, *_ in firms for t in range(times) if r.random() > 0.1]
    return spark.createDataFrame(firms, "k string, w string, n string, s double"), spark.createDataFrame(days, "k string, t int, x double")


def found(m, x):
    return sorted(tuple(r) for r in cs.peers(m, x, "k", "t", "x", "s", ("w", "n"), 5, 2.0, 6, (0.6, 0.4)).selectExpr("key", "rank", "peer", "narrow_match", "round(score, 9)", "round(correlation, 9)").collect())


def test_no_pairs_are_stored(spark, monkeypatch):
    """Only the best of each member leave a task: what is written grows with the members, not with their pairs."""
    stored, plain = [], cs.materialise
    def counted(df, name):
        out = plain(df, name)
        stored.append(out.count())
        return out
    monkeypatch.setattr(cs, "materialise", counted)
    m, x = frames(spark, 200, 10, random.Random(1))
    assert len(found(m, x)) == 200 * 5
    assert max(stored) <= 200 * 5


def test_small_tiles_give_the_same_peers(spark, monkeypatch):
    m, x = frames(spark, 60, 10, random.Random(2), narrow="abcdefghijklmno")
    whole = found(m, x)
    monkeypatch.setattr(cs, "TILE", 7)
    assert found(m, x) == whole and {r[3] for r in whole} == {True, False}


def test_ratio_at_the_limit_and_ties_by_key(spark):
    m = spark.createDataFrame([("b", "X", "a", 3.0), ("a", "X", "a", 3.0), ("d", "X", "a", 300.0), ("c", "X", "a", 3.0), ("e", "X", "a", 300.1), ("nan", "X", "a", math.nan), ("inf", "X", "a", math.inf)], "k string, w string, n string, s double")
    x = spark.createDataFrame([], "k string, t int, x double")
    got = found(m, x)
    assert [r[2] for r in got if r[0] == "a"] == ["b", "c", "d"] and [r[2] for r in got if r[0] == "e"] == ["d"] and not {"nan", "inf"} & {k for r in got for k in (r[0], r[2])}


def test_flat_series_correlate_as_in_sql(spark):
    """corr() in SQL is NaN for a series that doesn't vary, and NaN sorts first."""
    m = spark.createDataFrame([(k, "X", "a", 10.0) for k in ("flat", "one", "two")], "k string, w string, n string, s double")
    x = spark.createDataFrame([(k, t, 2.0 if k == "flat" else float(t * t if k == "one" else t)) for k in ("flat", "one", "two") for t in range(10)], "k string, t int, x double")
    got = [r for r in found(m, x) if r[0] == "one"]
    assert [r[2] for r in got] == ["flat", "two"] and math.isnan(got[0][4]) and got[1][5] > 0.9


def test_suppliers_of_one_nation_as_in_sql_without_stored_pairs(spark, monkeypatch, tmp_path):
    """peer_sets_topk over 150 suppliers of one nation, and some of small ones: the answer of its SQL, and never more rows written than suppliers times five."""
    import duckdb

    from marlstone.plans.table_queries import query

    c = duckdb.connect()
    nation = "case when i < 150 then 0 else i % 24 + 1 end"
    made = {
        "region": "select i r_regionkey, 'R' || i r_name from range(5) t(i)", "nation": "select i n_nationkey, 'N' || i n_name, i % 5 n_regionkey from range(25) t(i)",
        "supplier": f"select i s_suppkey, {nation} s_nationkey, case when i % 17 = 0 then -5.0 else round(10 + (hash(i) % 90000) / 10.0, 2) end s_acctbal from range(200) t(i)",
        "lineitem": "select k l_suppkey, timestamp '2020-01-15' + to_months(m::int) l_shipdate, round((hash(k, m) % 100000) / 10.0, 2) l_extendedprice from range(200) s(k), range(40) t(m) where hash(m, k) % 5 > 0",
    }
    for name, sql in made.items():
        c.sql(f"copy ({sql}) to '{tmp_path}/{name}.parquet' (format parquet)")
        c.sql(f"create view {name} as from '{tmp_path}/{name}.parquet'")
    stored, plain = [], cs.materialise
    def counted(df, name):
        out = plain(df, name)
        stored.append(out.count())
        return out
    monkeypatch.setattr(cs, "materialise", counted)
    got = [tuple(r) for r in query.queries["peer_sets_topk"](spark, str(tmp_path)).collect()]
    want = c.sql(query.sql["peer_sets_topk"]).fetchall()
    assert sorted(got, key=lambda r: (r[0], r[2])) == sorted(want, key=lambda r: (r[0], r[2])) and len(got) > 900 and {r[3] for r in got} == {True, False}
    assert max(stored) <= 200 * 5
