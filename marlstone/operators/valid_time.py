"""Events joined with the attributes that were known at their time.

An attribute version holds on a half-open interval [lo, hi) of microseconds. A range join would
compare every event of an entity with every version. Here time is cut into leaves of `grain` seconds
(a day, unless said otherwise), the leaves an interval touches fall
apart into at most two dyadic nodes per level (node i of level k covers
leaves [i*2^k, (i+1)*2^k)), each leaf with events names the one enclosing node of every level,
and both sides meet in an equi-join on (entity, node). Each interval meets each leaf it touches once;
an event then takes, of the intervals of its leaf, those that hold its exact time, and of these the one of
highest precedence. A busy entity spreads over as many keys as it has nodes and leaves.

`first_known` turns versions that become known at some time, each with a
precedence, into disjoint intervals; `as_of` also accepts overlapping ones.

Times are dates or timestamps; a date is the first moment of its day, for events and for versions. A value that becomes
known at 15:00 isn't seen by an event at 09:00 or by one dated that day. The intervals that touch one leaf are handed to
its events as one list: with many versions a day, take a finer grain.

Input that isn't clean: events with a null entity or time, and intervals with a
null entity, null lo or no length, match nothing; such events come out with
null attributes. A null hi means without end. Equal precedence is decided by the
greatest payload. Repeated events stay repeated, repeated intervals count
once. An empty side gives null attributes or no rows. Further columns of the
events are kept; a column named as an attribute is an error of the caller's.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVEL_SHIFT = 52
DAY = 86_400
#: Leaves that travel as one row on their way to being exploded.
PACK_BITS = 6


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a date or timestamp."""
    return F.unix_micros(at.cast("timestamp"))


def first_known(
    versions: DataFrame, entity: str, known: Column, precedence: Sequence[Column], payload: Sequence[Column]
) -> DataFrame:
    """(entity, lo, hi, prec, value): each version from when it is known (a date or timestamp) until one of
    higher precedence is. Versions that were never the best known are left out.
    """
    rows = versions.select(
        F.col(entity).alias("entity"),
        micros(known).alias("lo"),
        F.struct(*[p.alias(f"p{i}") for i, p in enumerate(precedence)]).alias("prec"),
        F.struct(*payload).alias("value"),
    ).where("entity is not null and lo is not null").groupBy("entity", "lo").agg(F.max(F.struct("prec", "value")).alias("best"))
    rows = rows.select("entity", "lo", "best.prec", "best.value")
    above = Window.partitionBy("entity").orderBy(F.desc("prec"), F.desc("value"), F.desc("lo")).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("hi", F.min("lo").over(above))
    return out.where(F.col("hi").isNull() | (F.col("lo") < F.col("hi"))).select("entity", "lo", "hi", "prec", "value")


def node(level: int, index: Column) -> Column:
    return index.cast("long") + F.lit(level << LEVEL_SHIFT)


def dyadic_nodes(lo: Column, hi: Column, levels: int) -> Column:
    """The fewest nodes of levels 0..levels-1 that together cover [lo, hi), 0 <= lo."""
    nodes = []
    for k in range(levels):
        left = F.shiftright(lo + F.lit((1 << k) - 1), k)
        right = F.shiftright(hi, k)
        some = left < right
        nodes.append(F.when(some & (left % 2 == 1), node(k, left)))
        nodes.append(F.when(some & (right % 2 == 1), node(k, right - 1)))
    return F.array_compact(F.array(*nodes))


def enclosing_nodes(at: Column, levels: int) -> Column:
    return F.array(*[node(k, F.shiftright(at, k)) for k in range(levels)])


def as_of(events: DataFrame, entity: str, at: str, attributes: Mapping[str, DataFrame], grain: int = DAY) -> DataFrame:
    """events with one struct column per attribute: the value valid at the time `at`, or null.

    attributes maps a name to intervals as `first_known` gives them. All are joined
    in one pass. The range of event times is read first (one pruned column) and
    the intervals are cut to it, which bounds the levels by its logarithm.
    """
    spark, unit = events.sparkSession, grain * 1_000_000
    def leaf(t: Column) -> Column:
        return F.call_function("div", t - F.pmod(t, F.lit(unit)), F.lit(unit))  # rounds down, before 1970 too
    keys = events.select(F.col(entity).alias("entity"), leaf(micros(F.col(at))).alias("leaf")).where("entity is not null and leaf is not null")
    span = keys.agg(F.min("leaf"), F.max("leaf")).first()
    if span[0] is None:
        return events.select("*", *[F.lit(None).cast(dict(i.dtypes)["value"]).alias(a) for a, i in attributes.items()])
    start, width = span[0], span[1] - span[0] + 1
    levels = max(1, math.floor(math.log2(width)) + 1)
    pieces = None
    for i, (name, intervals) in enumerate(attributes.items()):
        held = intervals.where(F.col("entity").isNotNull() & F.col("lo").isNotNull() & (F.col("hi").isNull() | (F.col("lo") < F.col("hi"))))
        held = held.select("*", (leaf(F.col("lo")) - start).alias("_from"), (leaf(F.col("hi") - 1) + 1 - start).alias("_to"))
        held = held.select("*", F.greatest("_from", F.lit(0).cast("long")).alias("_lo"), F.least(F.coalesce("_to", F.lit(width)), F.lit(width).cast("long")).alias("_hi"))
        piece = held.where("_lo < _hi").select(
            "entity", F.explode(dyadic_nodes(F.col("_lo"), F.col("_hi"), levels)).alias("node"), *[(F.struct("prec", "value", "lo", "hi") if n == name else F.lit(None).cast(_kind(other))).alias(f"m{j}") for j, (n, other) in enumerate(attributes.items())]
        )
        pieces = piece if pieces is None else pieces.unionByName(piece)
    # a leaf is asked for once, however many events it holds; sorted leaves of an entity make keys that lie side by side.
    # The packs are small and what comes out of them isn't: the exchange is sized for that
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = keys.groupBy("entity", F.shiftright("leaf", PACK_BITS).alias("pack")).agg(F.array_sort(F.collect_set("leaf")).alias("leaf")).repartition(tasks, F.xxhash64("entity", "pack"))
    asked = packs.select("entity", F.explode("leaf").alias("leaf"))
    asked = asked.select("entity", "leaf", F.explode(enclosing_nodes(F.col("leaf") - start, levels)).alias("node"))
    # no side is to be broadcast for being small before it was exploded
    met = asked.join(pieces.hint("merge"), ["entity", "node"]).groupBy(F.col("entity").alias("_entity"), F.col("leaf").alias("_leaf")).agg(*[F.collect_set(f"m{j}").alias(f"_m{j}") for j in range(len(attributes))])
    time = micros(F.col(at))
    out = events.withColumn("_at", time)
    out = out.join(met.hint("merge"), (F.col(entity) == F.col("_entity")) & (leaf(F.col("_at")) == F.col("_leaf")), "left")
    def best(j: int) -> Column:
        valid = F.filter(f"_m{j}", lambda v: (v["lo"] <= F.col("_at")) & (v["hi"].isNull() | (F.col("_at") < v["hi"])))
        return F.array_max(F.transform(valid, lambda v: F.struct(v["prec"].alias("prec"), v["value"].alias("value"))))["value"]
    return out.select(*[F.col(f"`{c}`") for c in events.columns], *[best(j).alias(n) for j, n in enumerate(attributes)])


def _kind(intervals: DataFrame) -> str:
    kinds = dict(intervals.dtypes)
    return f"struct<prec:{kinds['prec']},value:{kinds['value']},lo:bigint,hi:bigint>"
