"""What the plans must look like: pruned, pushed down, no needless exchange or pair of loops."""

import os
import re

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plan(spark, name):
    return entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "exchanges"), [("period_returns", 1), ("rolling_volatility", 1), ("sma_bollinger", 1), ("range_52w_drawdown", 1), ("ttm_rolling_sum", 1), ("growth_yoy_qoq", 1), ("ema_macd", 2), ("pricing_summary", 1), ("latest_snapshot_dedup", 1)])
def test_one_exchange(spark, name, exchanges):
    assert len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan(spark, name))) == exchanges


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(spark, "pricing_summary")
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in text
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text)[1]
    assert "l_quantity" in columns and "l_orderkey" not in columns and "l_partkey" not in columns


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not re.match(r"p\d+_", n)))
def test_no_cartesian_product_of_tables(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
