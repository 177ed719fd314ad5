import glob
import os

import pytest
from pyspark.sql import functions as F

from marlstone.operators import compaction as c
from marlstone.sources.price_files import price_records


def rows(spark, n=5000):
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("v"), F.array("id").alias("a"), F.lit("x").alias("odd name.1"))
    return df.unionByName(df.limit(100))


def test_all_rows_in_few_files(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    rows(spark).repartition(64).write.parquet(source)
    df = spark.read.parquet(source)
    out = c.compact(df, target, by=["k"], sort=["k"], target_bytes=8 << 20)
    assert c.multiset_checksum(out) == c.multiset_checksum(df)
    assert len(glob.glob(os.path.join(source, "*.parquet"))) == 64 and len(c.file_sizes(spark, target)) <= 2
    again = c.compact(spark.read.parquet(target), target, by=["k"], target_bytes=8 << 20)  # in place, over the old files
    assert c.multiset_checksum(again) == c.multiset_checksum(df)


def test_checksum_sees_loss_repeat_and_change(spark):
    df = rows(spark, 500)
    base = c.multiset_checksum(df)
    assert c.multiset_checksum(df.repartition(7)) == base
    assert c.multiset_checksum(df.limit(599)) != base
    assert c.multiset_checksum(df.unionByName(df.limit(1))) != base
    assert c.multiset_checksum(df.withColumn("v", F.when(F.col("v") == 1, 2).otherwise(F.col("v")))) != base
    two = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert c.multiset_checksum(two) != c.multiset_checksum(spark.createDataFrame([(1, 1), (None, None)], "a int, b int"))


def test_nothing_is_published_if_checksums_differ(spark, tmp_path, monkeypatch):
    sums = iter([(100, 2, 3), (100, 2, 4)])  # of what was written, then, as that isn't what was observed, of the input
    monkeypatch.setattr(c, "multiset_checksum", lambda df: next(sums))
    with pytest.raises(c.ChecksumMismatch):
        c.compact(spark.range(100), str(tmp_path / "t"))
    assert not os.path.exists(tmp_path / "t")


def test_empty(spark, tmp_path):
    assert c.compact(rows(spark, 0).limit(0), str(tmp_path / "e"), by=["k"]).count() == 0


KEYS = ["1. open", "2. high", "3. low", "4. close", "5. adjusted close", "6. volume", "7. dividend amount", "8. split coefficient"]


def series(**days):
    import json

    return json.dumps({"Time Series (Daily)": {d.replace("_", "-")[1:]: dict(zip(KEYS, v, strict=True)) for d, v in days.items()}})


def test_price_records(spark):
    good = series(d2024_01_02=["1.50", 2, 1, 1.5, 1.5, "7", 0, 1], d2024_01_03=[None, "x", 1, 1, 1, 1, 0, 1])
    bodies = [good, good + "}", good + good, good + "x", good + ',{"a":1}', good + "],[1", good[:-1], good + "]", good[:40], None, "", "{}", '{"Note": "later"}', '{"Time Series (Daily)": {}}', "[]", '{"Time Series (Daily)": null}']
    df = spark.createDataFrame([(i, "S", None, b, "clash") for i, b in enumerate(bodies)], "file_id int, symbol string, pull_date date, body string, open string")
    got = price_records(df).orderBy("trade_date").collect()
    assert [(r.file_id, str(r.trade_date), r.open, r.high, r.volume) for r in got] == [(0, "2024-01-02", 1.5, 2.0, 7.0), (0, "2024-01-03", None, None, 1.0)]


def test_a_target_size_is_no_other_query_s(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    monitor = []
    df = spark.range(10).select("id")
    c.compact(df, str(tmp_path / "t"), target_bytes=1 << 20)
    monitor.append(spark.conf.get(key))
    assert monitor == [before]


def test_whole_documents(spark):
    import json

    import duckdb

    from marlstone.functions import whole_json

    bodies = ['{"a": 1}', ' {"a": 1}\n', '{"a": 1}}', '{"a": 1}{"a": 1}', '{"a": 1} x', '{"a": 1', "", " ", None, "[1]", '{"a": 1}],[1', '{"a": 1},{"a": 1}', '{"a": 1},"b"', "nul", '{"a": 01}', '{"a": "\\u00e9"}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select("body", whole_json.wrapped(F.col("body")).alias("w")).select(whole_json.member(F.col("w"), F.col("body"), "$.a", "string")).collect()]
    con = duckdb.connect()
    want = [con.execute("select case when json_valid($1) then json_extract_string($1, '$.a') end", [b]).fetchone()[0] if b is not None else None for b in bodies]
    assert got == want and json.loads(bodies[-1])["a"] == got[-1]
