"""Many tiny files into few well-sized ones, losing and repeating nothing.

The rows pass one shuffle under a REBALANCE hint: adaptive execution then merges
small and splits large output partitions by their measured size, so
files come out near the target whatever the skew of the keys. The new files are
written to a staging folder and published only once a checksum of the written
rows equals that of the rows that went in.

The checksum is one of multisets: the number of rows and, for two independently
seeded 64-bit row hashes, their sums, which rows in any order share and a lost,
repeated or altered row changes (two wrong rows cancelling out in both sums
have a chance of 2^-128). That of the input is observed while it is written, so the input
is evaluated once. Tasks that run again after a lost executor may be observed twice:
only if the sums differ is the input evaluated again for a sum of its own.

The target size counts shuffled bytes; columnar files come out smaller, by how well the columns
compress. It is set in a session cloned for the write, so no other query sees it.

All rows are kept, equal ones and those with nulls included. No rows give one
empty file. Columns may have any names; maps are hashed by their sorted entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from marlstone.session import fresh_path, observed
from marlstone.sources.storage import delete, file_system, rename_into_place

TARGET_BYTES = 128 << 20


class ChecksumMismatch(RuntimeError):
    pass


def _row_hash(df: DataFrame, seed: int) -> Column:
    """Null counts as a value of its own: each column brings whether it is null."""
    parts: list[Column] = [F.lit(seed)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [c.isNull(), F.array_sort(F.map_entries(c)) if isinstance(f.dataType, MapType) else c]
    return F.xxhash64(*parts)


def _sums(df: DataFrame) -> list[Column]:
    hashes = {"a": _row_hash(df, 17), "b": _row_hash(df, 7919)}
    return [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).alias(k) for k, h in hashes.items()]]


def multiset_checksum(df: DataFrame) -> tuple[int, int, int]:
    return tuple(int(x) for x in df.agg(*_sums(df)).first())


def _sized(df: DataFrame, target_bytes: int) -> DataFrame:
    """df in a clone of its session whose shuffle partitions aim at target_bytes."""
    spark = df.sparkSession
    clone = spark._jsparkSession.cloneSession()
    clone.conf().set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    plan = df._jdf.queryExecution().analyzed()
    return DataFrame(spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(clone, plan), SparkSession(spark.sparkContext, clone))


def compact(df: DataFrame, path: str | None = None, by: Sequence[str] = (), sort: Sequence[str] = (), target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Write df to few files clustered by `by` and sorted within by `sort`; returns the published table."""
    spark = df.sparkSession
    staged = fresh_path(spark, "staged")
    path = path or fresh_path(spark, "compact")
    seen = Observation()
    out = _sized(df.observe(seen, *_sums(df)), target_bytes).hint("rebalance", *by)
    if sort:
        out = out.sortWithinPartitions(*sort)
    out.write.parquet(staged)
    now = multiset_checksum(spark.read.schema(df.schema).parquet(staged))
    was = tuple(int(x) for x in observed(seen).values())
    if was != now and (was := multiset_checksum(df)) != now:
        delete(spark, staged)
        raise ChecksumMismatch(f"read {was}, wrote {now}; nothing was published")
    rename_into_place(spark, staged, path)
    return spark.read.schema(df.schema).parquet(path)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    fs, P = file_system(spark, path)
    files = fs.listFiles(P(path), True)
    sizes = []
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().endswith(".parquet"):
            sizes.append(int(f.getLen()))
    return sizes
