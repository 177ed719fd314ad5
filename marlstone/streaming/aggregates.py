"""Structured Streaming twins of batch operators. An extension: batch and stream give equal rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators.relational import upsert_parquet


def hourly(events: DataFrame) -> DataFrame:
    """Count and sum per type and hour."""
    start = F.date_trunc("hour", "ts")
    return events.groupBy("event_type", start.cast(dict(events.dtypes)["ts"]).alias("start")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def read_events(spark: SparkSession, path: str, schema: str, files: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed(events: DataFrame, late: str = "2 hours", size: str = "1 hour") -> DataFrame:
    """Tumbling windows behind a watermark: rows later than `late` are dropped, closed windows leave the state."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy("event_type", F.window("ts", size)).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select("event_type", F.col("window.start").alias("start"), "n", "total")


def first_seen(events: DataFrame, keys: Sequence[str], late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


def drain(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now, then stop; the next call takes only what came since (the checkpoint is the high-water mark)."""
    q = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def upserting(path: str, keys: Sequence[str], order: Sequence[Column]) -> Callable[[DataFrame, int], None]:
    """A sink that is safe to repeat: a batch delivered twice leaves the table as once."""
    def sink(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_parquet(batch, path, keys, order)
    return sink
