"""The latest row at or before, by sorting blocks of time instead of a range join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.session import guard

BLOCK_DAYS = 366


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, payload: Sequence[str], allow_equal: bool = True, block_days: int | None = BLOCK_DAYS) -> DataFrame:
    """left with right's payload of the greatest right_on <= left_on (or <, without allow_equal).

    Both sides pass one exchange on `by` and the block of time, and one sort, so a key with a third of all rows is sorted in as many
    tasks as its history has blocks. Each block that left has rows in begins with the last row of right from before it; these are
    found among one row per key and block, for which left is looked at twice. Where each key has a row a day at most, block_days may be None: one block. The payload is carried forward as one struct, so columns of different rows never mix.

    Times are dates or timestamps. Left rows with a null key or time, or before any right row, get nulls; right rows with a null
    key or time match nothing. right should hold (by, right_on) once: of equal
    ones the one with the greatest payload counts.
    """
    guard(left.sparkSession)
    row = F.struct(*payload)
    keys = [*by, "_block"]
    def block(c: str):
        return F.floor(F.unix_date(F.col(c).cast("date")) / block_days) if block_days else F.when(F.col(c).isNotNull(), 0)
    given = right.select(*by, F.col(right_on).alias("_at"), block(right_on).alias("_block"), F.lit(0 if allow_equal else 1).alias("_side"), row.alias("_pay"), F.lit(None).cast(left.schema).alias("_row"))
    kind = given.schema["_pay"].dataType
    asked = left.select(*by, F.col(left_on).alias("_at"), block(left_on).alias("_block"), F.lit(1 if allow_equal else 0).alias("_side"), F.lit(None).cast(kind).alias("_pay"), F.struct(*left.columns).alias("_row"))
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*by, "_at")])
    given, wanted = given.where(usable), asked.where(usable)
    met = given.unionByName(wanted)
    if block_days:
        met = met.unionByName(_carried(given, wanted, left, by))
    # the carried rows have no time and so come first
    w = Window.partitionBy(*keys).orderBy("_at", "_side", "_pay").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.withColumn("_last", F.last("_pay", ignorenulls=True).over(w)).where("_row is not null")
    rest = asked.where(~F.coalesce(usable, F.lit(False))).withColumn("_last", F.lit(None).cast(kind))
    return met.unionByName(rest).select("_row.*", *[F.col(f"_last.{p}").alias(p) for p in payload])


def _carried(given: DataFrame, wanted: DataFrame, left: DataFrame, by: Sequence[str]) -> DataFrame:
    """For each block that is asked for, the last row given before it, as a row without a time."""
    keys = [*by, "_block"]
    ends = given.groupBy(*keys).agg(F.max(F.struct("_at", "_pay")).alias("_end")).unionByName(wanted.select(*keys).distinct(), allowMissingColumns=True)
    ends = ends.groupBy(*keys).agg(F.max("_end").alias("_end"), F.max(F.col("_end").isNull()).alias("_asked"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("_end", before).where(F.col("_asked") & F.col("_end").isNotNull())
    return carried.select(*by, F.lit(None).cast(given.schema["_at"].dataType).alias("_at"), "_block", F.lit(-1).alias("_side"), F.col("_end._pay").alias("_pay"), F.lit(None).cast(left.schema).alias("_row"))
