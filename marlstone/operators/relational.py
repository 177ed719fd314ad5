"""Keyed tables: latest rows, upserts, matching, and what is new.

Null keys group together in `latest_by`, as they do in GROUP BY, and match
nothing in joins. Ties are broken by the order columns given; with equal order
any one of the tied rows is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.session import fresh_path, observed
from marlstone.sources.storage import recover, rename_into_place
from marlstone.sources.tables import table_exists


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cluster: Sequence[str] = ()) -> DataFrame:
    """The first row of each key in the given order. One exchange on the keys; the rank limit is
    applied before it too, so a key's many rows don't travel.

    With `cluster`, some of the keys, the exchange is on those: windows over them that follow share
    it. For series whose rows are bounded by their calendar.
    """
    if cluster:
        df = df.repartition(*cluster)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def assemble(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of all parts on the keys. Parts must hold a key once, or rows multiply."""
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), parts)


def upsert(existing: DataFrame | None, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Old and new rows, one per key: the first in `order`, of equal ones a new row.
    Columns on one side only are null on the other."""
    tagged = new.withColumn("_batch", F.lit(1))
    if existing is not None:
        tagged = existing.withColumn("_batch", F.lit(0)).unionByName(tagged, allowMissingColumns=True)
    return latest_by(tagged, keys, [*order, F.desc("_batch")]).drop("_batch")


def upsert_parquet(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column]) -> None:
    """Upsert into a Parquet folder: staged beside, then swapped in. Doing it again changes nothing."""
    spark = new.sparkSession
    recover(spark, path)
    old = spark.read.option("mergeSchema", True).parquet(path) if table_exists(spark, path) else None
    staged = fresh_path(spark, "upsert")
    upsert(old, new, keys, order).write.parquet(staged)
    rename_into_place(spark, staged, path)


def upsert_partitions(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column], partition: str) -> list:
    """Upsert reading and rewriting only the partitions that `new` touches; returns those.

    The touched values come to the driver; partitions are years or days, so they are few.
    """
    spark = new.sparkSession
    recover(spark, path)
    touched = [r[0] for r in new.select(partition).distinct().collect()]
    old = None
    if table_exists(spark, path):
        old = spark.read.option("mergeSchema", True).parquet(path).where(F.col(partition).isin(touched))
    merged = upsert(old, new, keys, order)
    staged = fresh_path(spark, "upsert")
    merged.write.partitionBy(partition).parquet(staged)
    overwrite_partitions(spark.read.schema(merged.schema).parquet(staged), path, partition)
    return touched


def dedup_rewrite(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column]) -> tuple[int, int]:
    """Rewrite a Parquet folder with one row per key; returns the rows before and after. Doing it again changes nothing."""
    recover(spark, path)
    old = spark.read.option("mergeSchema", True).parquet(path)
    seen = Observation()
    staged = fresh_path(spark, "dedup")
    latest_by(old.observe(seen, F.count(F.lit(1)).alias("n")), keys, order).write.parquet(staged)
    after = spark.read.parquet(staged).count()
    rename_into_place(spark, staged, path)
    return int(observed(seen).get("n", 0)), after


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions present in df, leave the others. One file per
    partition and task: rows are clustered by the partition first."""
    df.repartition(partition).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(partition).parquet(path)


def overwrite(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a table as a whole, so no stale partition outlives a rebuild."""
    staged = fresh_path(df.sparkSession, "overwrite")
    (df.repartition(partition).write.partitionBy(partition) if partition else df.write).parquet(staged)
    rename_into_place(df.sparkSession, staged, path)


def not_yet(new: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key was not processed."""
    return new.join(done.select(*keys).distinct(), list(keys), "left_anti")


def deep_enough(first: DataFrame, listed: DataFrame, key: str, first_date: str, listing_date: str, floor: str) -> DataFrame:
    """first with listing_date and skip: whether a series reaches back to `floor` or to its listing, so a full load has nothing to add."""
    out = first.join(listed.select(key, listing_date), key, "left")
    deep = (F.col(first_date) <= F.lit(floor).cast("date")) | F.coalesce(F.col(first_date) <= F.col(listing_date), F.lit(False))
    return out.withColumn("skip", deep)


def above_high_water(new: DataFrame, done: DataFrame, mark: str) -> DataFrame:
    """Rows beyond the greatest mark so far; all, if there is none. The mark is a scalar subquery's
    one row, so nothing is read twice and no value travels through the driver."""
    top = done.agg(F.max(mark).alias("_top"))
    return new.crossJoin(F.broadcast(top)).where(F.col("_top").isNull() | (F.col(mark) > F.col("_top"))).drop("_top")


def flat_symbol(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", ""))


def match_symbols(left: DataFrame, right: DataFrame, key: str, other: str) -> DataFrame:
    """left with `matched` and `how`: exact, else by letters and digits alone where that
    names exactly one row of right, else null (gap). right's keys count once."""
    names = right.select(F.col(other).alias("_o")).where("_o is not null").distinct()
    flat = names.groupBy(flat_symbol("_o").alias("_flat")).agg(F.count(F.lit(1)).alias("_n"), F.min("_o").alias("_one")).where("_n = 1")
    out = left.join(names, F.col(key) == F.col("_o"), "left").join(flat, flat_symbol(key) == F.col("_flat"), "left")
    how = F.when(F.col("_o").isNotNull(), "exact").when(F.col("_one").isNotNull(), "flat").otherwise("gap")
    return out.withColumn("matched", F.coalesce("_o", "_one")).withColumn("how", how).drop("_o", "_flat", "_n", "_one")


def dominant(df: DataFrame, group: Sequence[str], value: Column, first: Column, least: int = 3) -> DataFrame:
    """Rows whose value is the most frequent one of its group (ties: the one seen first); groups of fewer than `least` rows stay whole."""
    counts = df.groupBy(*group, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"))
    w = Window.partitionBy(*group)
    best = counts.withColumn("_all", F.sum("_n").over(w)).withColumn("_rank", F.row_number().over(w.orderBy(F.desc("_n"), "_first")))
    best = best.select(*group, F.col("_v").alias("_keep"), "_all").where("_rank = 1")
    return df.join(best, list(group)).where((F.col("_all") < least) | value.eqNullSafe(F.col("_keep"))).drop("_keep", "_all")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """n rows at random, the same for the same rows and seed however they are partitioned."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def key_range(spark: SparkSession, first: str, last: str, step: str) -> DataFrame:
    """The dates from first to last in steps such as '3 months', as `at`."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)), F.expr(f"interval {step}"))).alias("at"))
