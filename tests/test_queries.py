"""Every query beside its SQL, on the small tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(t)[:-8]} as select * from '{t}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 8)
    return round(float(v), 8) if hasattr(v, "quantize") else tuple(map(plain, v)) if isinstance(v, list) else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    rows = df.select(cols).collect()
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        rel = duck.sql(sql)
        assert sorted(rel.columns) == cols
        assert ordered(rows) == ordered(rel.select(*[f'"{c}"' for c in cols]).fetchall())
