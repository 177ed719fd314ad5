"""Mergeable quality profiles of columns, per load, and what moved between loads.

One scan makes `cells`: per load and column, the counts of each distinct value or, for a number
whose distinct values aren't asked for, of each logarithmic bucket. A cell holds rows, nulls,
violations, the range and power sums (of x, x^2, x^3), all of which merge by adding, over
partitions or days, in any order. `profile` adds cells up to one row per load and column.

Power sums of values up to 10^(9-scale) in size are exact: whole numbers of 10^-scale added
as decimals. Larger values are added as doubles, exact to their rounding; `big` counts them. Mean, deviation
and skewness come from the sums; the standardised difference of two loads is the difference of means over
the pooled deviation. A median isn't a function of power sums, but lies within one deviation of the mean:
`may_differ` tells from the sums alone which loads can't have moved by a factor. For the others the
bucket of the middle ranks bounds the median by its least and greatest value (lo, hi), and only if those leave it open
`settle` ranks the distinct values of that one bucket.

Nulls are counted; NaN and infinities are in no sum, bucket or range of numbers. An empty load doesn't
exist; a column of only nulls has null range, mean and median. Rows with a null load are a load of their
own. All sums are partial before the shuffle, so one load may hold a third of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POWERS = (1, 2, 3)
#: Relative width of a bucket, and what keeps the bucket numbers of small values positive.
WIDTH = 0.05
SHIFT = 1 << 20
COUNTED = ("n", "nulls", "s0", "big")
RESERVED = {"column_name", "bucket", "key", "lo", "hi", *COUNTED}


@dataclass(frozen=True)
class Check:
    """What one column is checked for; conditions are over the table's row.

    number: the value entering sums, null where it is not in range; only its range is a range of numbers.
    violations: name -> condition true for an offending row.
    distinct: whether a number's distinct values are counted; others' always are.
    """

    column: str
    value: Column
    number: Column | None = None
    violations: dict[str, Column] = field(default_factory=dict)
    distinct: bool = True
    scale: int = 4


def bucket(x: Column) -> Column:
    """Bucket numbers rise with x: the logarithm, the division and the rounding down never fall."""
    size = F.floor(F.log(F.abs(x)) / math.log(1 + WIDTH)) + SHIFT
    return F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size).cast("long")


def _names(checks: Sequence[Check]) -> list[str]:
    return sorted({f"v_{v}" for c in checks for v in c.violations})


def cells(df: DataFrame, by: Sequence[str], checks: Sequence[Check], names: Sequence[str] = ()) -> DataFrame:
    """by..., column_name, bucket, key, n, nulls, v_<violation>..., lo, hi, s0 (numbers), s1..s3, big, r1..r3: one pass over df.

    names: further violation columns to have, for cells that are put beside others.
    """
    if RESERVED & set(by):
        raise ValueError("a load can't be named as a column of the profile")
    names = sorted({*_names(checks), *names})
    rows = []
    for c in checks:
        x = F.lit(None).cast("double")
        if c.number is not None:
            x = c.number.cast("double")
            x = F.when(F.abs(x) < float("inf"), x)
        value = c.value + F.lit(0.0) if c.number is not None else c.value  # one zero only
        key = value.cast("string") if c.distinct or c.number is None else F.lit(None).cast("string")
        # the number of 10^-scale, where its third power leaves room for 10^11 rows
        t = F.when(F.abs(x) <= 10.0 ** (9 - c.scale), F.round(x * 10**c.scale).cast("long"))
        flags = [F.coalesce(c.violations.get(v.removeprefix("v_"), F.lit(False)), F.lit(False)).alias(v) for v in names]
        rows.append(F.struct(F.lit(c.column).alias("column_name"), F.lit(c.scale if c.number is not None else None).cast("int").alias("scale"), bucket(x).alias("bucket"), key.alias("key"), c.value.isNull().alias("_null"), x.alias("_x"), t.alias("_t"), *flags))
    flat = df.select(*by, F.inline(F.array(*rows)))
    t, far = F.col("_t"), F.when(F.col("_t").isNull(), F.col("_x"))
    square = (t * t).cast("decimal(19,0)")
    powers = {"s1": t.cast("decimal(10,0)"), "s2": square, "s3": square * t.cast("decimal(10,0)")}
    return flat.groupBy(*by, "column_name", "scale", "bucket", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_null").alias("nulls"), *[F.count_if(v).alias(v) for v in names], F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("_x").alias("s0"),
        *[F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)").alias(s) for s, p in powers.items()],
        F.count(far).alias("big"), F.coalesce(F.sum(far), F.lit(0.0)).alias("r1"), F.coalesce(F.sum(far * far), F.lit(0.0)).alias("r2"), F.coalesce(F.sum(far * far * far), F.lit(0.0)).alias("r3"),
    )


def _added(df: DataFrame) -> list[Column]:
    plain = [c for c in df.columns if c in COUNTED or c.startswith("v_") or c in ("r1", "r2", "r3")]
    return [*[F.sum(c).alias(c) for c in plain], F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(f"s{k}").cast("decimal(38,0)").alias(f"s{k}") for k in POWERS]]


def merge(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells of several partitions, days or finer groups added up."""
    return parts.groupBy(*by, "column_name", "scale", "bucket", "key").agg(*_added(parts))


def middle(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by..., column_name, bucket, below, total, lo, hi, first, second: the buckets that hold the two middle ranks.
    Buckets per load are bounded by the width, so a load's few thousand meet in one window."""
    group = [*by, "column_name"]
    counts = parts.where("bucket is not null").groupBy(*group, "bucket").agg(F.sum("s0").alias("k"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    w = Window.partitionBy(*group)
    upto = F.sum("k").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    out = counts.withColumns({"below": upto - F.col("k"), "total": F.sum("k").over(w)})
    held = [(F.col("below") <= r) & (r < F.col("below") + F.col("k")) for r in (F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2))]
    return out.withColumns({"first": held[0], "second": held[1]}).where("first or second").drop("k")


def profile(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by..., column_name and the cells' sums, n_distinct (null if not asked for), lo_text, hi_text, med_lo, med_hi: one row per load and column."""
    group = [*by, "column_name"]
    total = parts.groupBy(*group, "scale").agg(*_added(parts), F.count("key").alias("_keys"), *[F.when(F.col("scale").isNull(), f("key")).alias(c) for f, c in ((F.min, "lo_text"), (F.max, "hi_text"))], F.max(F.col("key").isNotNull() | (F.col("n") == F.col("nulls"))).alias("_asked"))
    total = total.withColumn("n_distinct", F.when(F.col("_asked"), F.col("_keys"))).drop("_keys", "_asked")
    ends = middle(parts, by).groupBy(*group).agg(*[((F.max(F.when(F.col("first"), F.col(c))) + F.max(F.when(F.col("second"), F.col(c)))) / 2).alias(f"med_{c}") for c in ("lo", "hi")])
    renamed = ends.withColumnsRenamed({k: f"_m_{k}" for k in group})
    same = F.lit(True)
    for k in group:
        same = same & total[k].eqNullSafe(renamed[f"_m_{k}"])
    return total.join(renamed, same, "left").drop(*[f"_m_{k}" for k in group])


def settle(values: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """by..., median: exact. values holds (by..., bucket, x, k), wanted is `middle` of one column; the
    values that meet it are ranked within their bucket. Null loads meet no values."""
    met = values.join(wanted.select(*by, "bucket", "below", "total"), [*by, "bucket"]).groupBy(*by, "bucket", "below", "total", "x").agg(F.sum("k").alias("k"))
    upto = F.sum("k").over(Window.partitionBy(*by, "bucket").orderBy("x")) + F.col("below")
    met = met.withColumn("_upto", upto).withColumn("_from", upto - F.col("k"))
    ranks = [F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)]
    found = [F.max(F.when((F.col("_from") <= r) & (r < F.col("_upto")), F.col("x"))) for r in ranks]
    return met.groupBy(*by).agg(((found[0] + found[1]) / 2).alias("median"))


def number_values(df: DataFrame, by: Sequence[str], number: Column) -> DataFrame:
    """(by..., bucket, x, k) of a table's column, for `settle`."""
    x = number.cast("double")
    rows = df.select(*by, F.when(F.abs(x) < float("inf"), x).alias("x")).where("x is not null")
    return rows.select(*by, bucket(F.col("x")).alias("bucket"), "x", F.lit(1).alias("k"))


def cell_values(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same from cells of distinct values, whose range is one value."""
    return parts.where("bucket is not null and key is not null").select(*by, "bucket", F.col("lo").alias("x"), F.col("s0").alias("k"))


def moments(profiles: DataFrame) -> DataFrame:
    """Adds mean, sd (of the population) and skew (null without deviation)."""
    n = F.col("s0").cast("double")
    m = {k: F.try_divide(F.col(f"s{k}").cast("double") * F.pow(F.lit(10.0), -F.col("scale") * k) + F.col(f"r{k}"), n) for k in POWERS}
    out = profiles.withColumns({"mean": m[1], "_m2": m[2], "_m3": m[3]})
    var = F.col("_m2") - F.col("mean") * F.col("mean")
    out = out.withColumn("sd", F.when(var.isNotNull(), F.sqrt(F.greatest(var, F.lit(0.0)))))
    mu, sd = F.col("mean"), F.col("sd")
    return out.withColumn("skew", F.when(sd > 0, (F.col("_m3") - 3 * mu * F.col("_m2") + 2 * mu * mu * mu) / (sd * sd * sd))).drop("_m2", "_m3")


def against_previous(df: DataFrame, load: str, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """df with prev_<c> from the row of equal keys whose load is smaller by 1, null if there is none."""
    before = df.select(*keys, (F.col(load) + 1).alias(load), *[F.col(c).alias(f"prev_{c}") for c in carry], F.lit(True).alias("has_prev"))
    return df.join(before, [*keys, load], "left")


def standardised_difference(now: str = "mean", sd: str = "sd") -> Column:
    pooled = F.sqrt((F.col(sd) * F.col(sd) + F.col(f"prev_{sd}") * F.col(f"prev_{sd}")) / 2)
    return F.when(pooled > 0, (F.col(now) - F.col(f"prev_{now}")) / pooled)


def may_differ(up: float, down: float, unit: float = 1e-4) -> Column:
    """False where power sums alone show that the median isn't over `up` times, nor under `down` times, the
    one before: each lies within one deviation of its mean. unit is the rounding of the sums' numbers."""
    def side(p: str, sign: int) -> Column:
        mean, sd = F.col(f"{p}mean"), F.col(f"{p}sd")
        return mean + sign * (sd + unit + 1e-6 * (F.abs(mean) + sd))
    possible = (side("", 1) > F.least(side("prev_", -1) * up, side("prev_", 1) * up)) | (side("", -1) < F.greatest(side("prev_", 1) * down, side("prev_", -1) * down))
    return F.coalesce(possible, F.lit(True))


def median_moved(up: float, down: float) -> tuple[Column, Column]:
    """(surely, open) from the bounds of both medians; positive medians are compared as factors."""
    lo, hi, plo, phi = (F.col(c) for c in ("med_lo", "med_hi", "prev_med_lo", "prev_med_hi"))
    surely = (lo > F.greatest(plo * up, phi * up)) | (hi < F.least(plo * down, phi * down))
    possibly = (hi > F.least(plo * up, phi * up)) | (lo < F.greatest(plo * down, phi * down))
    return F.coalesce(surely, F.lit(False)), F.coalesce(possibly & ~surely, F.lit(False))
