"""What the queries without SQL must hold, on the small tables."""

import json
import os

import pyarrow.parquet as pq
import pytest

from marlstone.plans import problems

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def rows(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


def test_holdings_are_whole_and_filled(spark):
    want = {}
    for f in rows("bronze_holdings_files"):
        try:
            n = len(json.loads(f["body"])["holdings"] or [])
        except (TypeError, ValueError, KeyError):
            n = 0
        if n:
            want[f["file_id"]] = n
    got = problems.p3_holdings(spark, DATA).toPandas()
    assert got.groupby("file_id").size().to_dict() == want
    assert not got[["holder_name", "shares_held", "report_date"]].isna().any().any()
    assert list(got.columns) == ["symbol", "holder_name", "shares_held", "shares_change", "pct_of_portfolio", "market_value", "report_date", "pull_date", "file_id"]


def test_every_change_has_its_version(spark):
    report = problems.p3_change_report(spark, DATA).toPandas()
    assert (report.schema_version > 1).all()
    assert sorted(report[["file_id", "field", "change"]].itertuples(index=False, name=None)) == sorted(map(tuple, problems.p3_found(spark, DATA).collect()))


def test_profile_agrees_with_the_table(spark):
    got = {(r.table_name, r.column_name, r.load_id): r for r in problems.p7_profile(spark, DATA).collect()}
    prices = rows("fact_daily_prices")
    for load in {r["load_id"] for r in prices}:
        mine = [r["adjusted_close"] for r in prices if r["load_id"] == load]
        p = got["fact_daily_prices", "adjusted_close", load]
        good = [x for x in mine if x is not None and 0 < x < 100000]
        assert (p.n, p.nulls, p.v_range) == (len(mine), mine.count(None), len(mine) - mine.count(None) - len(good))
        assert p["mean"] == pytest.approx(sum(good) / len(good), abs=1e-4)
        distinct = {"nan" if x != x else x for x in mine if x is not None}
        assert p.n_distinct == len(distinct)
