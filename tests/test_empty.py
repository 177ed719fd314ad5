"""Every query over tables without rows."""

import glob
import os

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in glob.glob(f"{DATA}/*.parquet"):
        pq.write_table(pq.read_schema(t).empty_table(), folder / os.path.basename(t))
    return str(folder)


# aggregates without a group, and counts per set or column, have rows whatever they read
WHOLE = {"set_operations", "top_slice_coverage", "dq_measures", "none_token_scan"}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_rows(spark, empty, name):
    df = entry.queries()[name](spark, empty)
    assert df.columns and (df.count() == 0 or name in WHOLE)
