"""Percentiles of very large columns from counts in signed logarithmic buckets.

Bucket i > 0 holds the values in (g^(i-1-c), g^(i-c)], g = (1+a)/(1-a), where the constant c keeps i
positive for the smallest double; negative values mirror it at -i and zero is bucket 0, so bucket numbers
sort as the values do. A percentile is read from the bucket that holds its
rank, as the point whose relative distance to any value in there is at most a.
Sketches of partitions, days or groups merge by adding the counts of equal
buckets, and the result doesn't depend on how rows were spread: a row
count per bucket is all that is ever shuffled, summed before the shuffle.

The accuracy may be from 1e-6 to 0.5; any other is refused, as bucket numbers of finer ones would carry the
rounding of the logarithm. Nulls and NaN are no values. Infinities have buckets of their own and come out
as infinities. Values below 2.3e-308 have fewer digits than the accuracy may ask for and keep only the double's own rounding.
Null group keys are a group. An empty input gives no rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINEST, COARSEST = 1e-6, 0.5
INFINITE = 1 << 40
SMALLEST = 5e-324


def gamma(accuracy: float) -> float:
    if not FINEST <= accuracy <= COARSEST:
        raise ValueError(f"accuracy must lie in [{FINEST}, {COARSEST}]")
    return (1 + accuracy) / (1 - accuracy)


def offset(accuracy: float) -> int:
    """Greater than the number of any bucket below 1."""
    return math.ceil(-math.log(SMALLEST) / math.log(gamma(accuracy))) + 2


def bucket(x: Column, accuracy: float) -> Column:
    """The bucket number of x (long), null for no value."""
    size = F.abs(x)
    finite = F.ceil(F.log(size) / F.lit(math.log(gamma(accuracy)))).cast("long") + offset(accuracy)
    magnitude = F.when(size == float("inf"), F.lit(INFINITE)).otherwise(finite)
    signed = F.when(size == 0, F.lit(0).cast("long")).when(x > 0, magnitude).otherwise(-magnitude)
    return F.when(x.isNotNull() & ~F.isnan(x), signed)


def midpoint(b: Column, accuracy: float) -> Column:
    """The value that stands for a bucket."""
    g = gamma(accuracy)
    power = (F.abs(b) - offset(accuracy)).cast("double")
    # in two factors, as the upper end of the last bucket is beyond the doubles
    half = F.pow(F.lit(g), power / 2)
    size = F.when(F.abs(b) == INFINITE, F.lit(float("inf"))).otherwise(F.least(half * F.lit(2 / (g + 1)) * half, F.lit(sys.float_info.max)))
    return F.when(b == 0, F.lit(0.0)).when(b > 0, size).otherwise(-size)


def sketch(df: DataFrame, by: Sequence[str | Column], value: Column, accuracy: float) -> DataFrame:
    """by..., bucket, n. The groups can't be named as the result is; other columns may have any name."""
    out = df.select(*by, bucket(value.cast("double"), accuracy).alias("bucket"))
    names = out.columns[:-1]
    if {"bucket", "n"} & set(names):
        raise ValueError("bucket and n are the names of the result")
    return out.where("bucket is not null").groupBy(*names, "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds sketches up to coarser groups, or those of several loads to one."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def ranked(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds below (values in lower buckets), upto (and in this one) and total."""
    group = Window.partitionBy(*by)
    upto = F.sum("n").over(group.orderBy("bucket").rangeBetween(Window.unboundedPreceding, 0))
    out = sketches.withColumn("upto", upto).withColumn("total", F.sum("n").over(group.orderBy("bucket").rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return out.withColumn("below", F.col("upto") - F.sum("n").over(group.orderBy("bucket").rangeBetween(0, 0)))


def quantiles(sketches: DataFrame, by: Sequence[str], qs: dict[str, float], accuracy: float) -> DataFrame:
    """by..., total, one column per entry of qs: the value of rank floor(q*(n-1)), within accuracy of it."""
    r = ranked(sketches, by)
    at = {name: F.floor(F.lit(q) * (F.col("total") - 1)) for name, q in qs.items()}
    held = {name: (F.col("below") <= rank) & (rank < F.col("upto")) for name, rank in at.items()}
    return r.groupBy(*by).agg(
        F.max("total").alias("n"), *[F.max(F.when(here, midpoint(F.col("bucket"), accuracy))).alias(name) for name, here in held.items()]
    )
