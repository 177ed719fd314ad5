"""Percentiles by sketch against sorted values, on the small tables."""

import math
import os

import pyarrow.parquet as pq
import pytest

from marlstone.llm import percentiles

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def rows(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def test_percentiles_within_their_bound(spark):
    once = {}
    for r in rows("fact_valuation_daily"):
        k = (r["universe"], r["symbol"], r["trade_date"])
        if k not in once or r["gold_built_utc"] >= once[k]["gold_built_utc"]:
            once[k] = r
    values = {}
    for r in once.values():
        q = f"{r['trade_date'].year}Q{(r['trade_date'].month - 1) // 3}"
        for level in percentiles.LEVELS:
            for m in percentiles.METRICS:
                if r[level] is not None and r[m] is not None and not math.isnan(r[m]):
                    for scope in ((None, None), (r["universe"], q)):
                        values.setdefault((*scope, level, r[level], m), []).append(r[m])
    got = percentiles.p4_percentiles(spark, DATA).collect()
    assert len(got) == len(values)
    for r in got:
        quarter = r.as_of_date and f"{r.as_of_date[:4]}Q{(int(r.as_of_date[5:7]) - 1) // 3}"
        xs = sorted(values[r.universe, quarter, r.grouping_level, r.group_value, r.metric])
        assert r.n == len(xs)
        for name, q in percentiles.STATISTICS.items():
            exact = xs[math.floor(q * (len(xs) - 1))]
            assert abs(r[name] - exact) <= percentiles.FINE * abs(exact) * (1 + 1e-9) + 1e-9
