import datetime as dt

from pyspark.sql import functions as F

from marlstone.streaming import aggregates as agg

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def write(spark, path, start, n):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), i % 5, "ab"[i % 2], float(i)) for i in range(start, start + n)]
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "src"), []
    write(spark, src, 0, 300)
    def sink(df, _):
        out.extend(df.collect())
    for more in (True, False):  # the second run takes only what came since
        agg.drain(agg.windowed(agg.read_events(spark, src, SCHEMA)), sink, str(tmp_path / "cp"), "update")
        if more:
            write(spark, src, 300, 100)
    last = {(r.event_type, r.start.replace(tzinfo=None)): (r.n, r.total) for r in out}
    batch = {(r.event_type, r.start): (r.n, r.total) for r in agg.hourly(spark.read.parquet(src)).collect()}
    assert last == batch


def test_upserting_sink_is_repeatable(spark, tmp_path):
    src, path = str(tmp_path / "src"), str(tmp_path / "t")
    write(spark, src, 0, 50)
    sink = agg.upserting(path, ["user_id"], [F.desc("ts")])
    agg.drain(agg.read_events(spark, src, SCHEMA), sink, str(tmp_path / "cp"))
    agg.drain(agg.read_events(spark, src, SCHEMA), sink, str(tmp_path / "cp2"))  # all of it once more
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == [45, 46, 47, 48, 49]


def test_first_seen(spark, tmp_path):
    src, out = str(tmp_path / "src"), []
    write(spark, src, 0, 20)
    write(spark, src, 0, 20)
    agg.drain(agg.first_seen(agg.read_events(spark, src, SCHEMA), ["event_id"]), lambda df, _: out.extend(df.collect()), str(tmp_path / "cp"))
    assert len(out) == 20
