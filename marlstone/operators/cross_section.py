"""Comparisons within groups at one time: percentiles, ranks, scores, peers, concentration."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators import peer_tiles
from marlstone.operators.column_profile import bucket
from marlstone.session import materialise, sized

#: Members and candidates of a tile of `peers`, about; a pair of tiles fits one Python worker.
TILE = 3072


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Long form (ids, metric, value) in one scan; nulls and NaN are left out."""
    out = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(list(ids), list(values), "metric", "value")
    return out.where("value is not null and not isnan(value)")


def percentiles_by_level(long: DataFrame, levels: Sequence[str], qs: dict[str, float], keep: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles per level and metric by one expansion into grouping sets. A null group is no group."""
    cells = F.array(*[F.struct(F.lit(g).alias("grouping_level"), F.col(g).alias("group_value")) for g in levels])
    rows = long.select(*keep, F.inline(cells), "metric", "value").where("group_value is not null")
    return exact_quantiles(rows, [*keep, "grouping_level", "group_value", "metric"], F.col("value"), qs)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: Column, qs: dict[str, float]) -> DataFrame:
    """by..., n, mean and the interpolated quantiles of the values that are neither null, NaN nor infinite.

    No group's values meet in one task: counts of buckets tell which hold the ranks asked for, and only the values of
    those buckets, each once with its count, are ranked. df is read twice. Groups with a null key are left out.
    """
    x = value.cast("double")
    xs = df.select(*by, F.when(F.abs(x) < float("inf"), x).alias("_x")).where(" and ".join(f"`{c}` is not null" for c in (*by, "_x"))).withColumn("_b", bucket(F.col("_x")))
    counts = xs.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_k"), F.sum("_x").alias("_s"))
    w = Window.partitionBy(*by)
    counts = counts.withColumns({"_below": F.sum("_k").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_k"), "n": F.sum("_k").over(w), "mean": F.sum("_s").over(w)})
    counts = counts.withColumn("mean", F.col("mean") / F.col("n"))
    place = {name: F.lit(q) * (F.col("n") - 1) for name, q in qs.items()}
    ends = [(name, side, r(p).cast("long")) for name, p in place.items() for side, r in (("lo", F.floor), ("hi", F.ceil))]
    asked = F.lit(False)
    for _, _, r in ends:
        asked = asked | ((F.col("_below") <= r) & (r < F.col("_below") + F.col("_k")))
    met = xs.join(counts.where(asked).select(*by, "_b", "_below", "n", "mean"), [*by, "_b"]).groupBy(*by, "_b", "_below", "n", "mean", "_x").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*by, "_b").orderBy("_x")) + F.col("_below")
    met = met.withColumn("_upto", upto).withColumn("_from", upto - F.col("_k"))
    found = met.groupBy(*by).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), *[F.max(F.when((F.col("_from") <= r) & (r < F.col("_upto")), F.col("_x"))).alias(f"{name}|{side}") for name, side, r in ends])
    between = {name: F.col(f"{name}|lo") + (F.col(f"{name}|hi") - F.col(f"{name}|lo")) * (place[name] - F.floor(place[name])) for name in qs}
    return found.select(*by, "n", "mean", *[v.alias(name) for name, v in between.items()])


def relative_standing(long: DataFrame, group: str) -> DataFrame:
    """Percent rank, group mean and deviation, and z-score per (group, metric). The rank is null without a
    group; a deviation of 0 or of one member gives no score."""
    g = Window.partitionBy(group, "metric")
    mu, sd = F.avg("value").over(g), F.stddev_samp("value").over(g)
    rank = F.when(F.col(group).isNotNull(), F.percent_rank().over(g.orderBy("value")))
    return long.withColumns({"pct_rank": rank, "n": F.count("value").over(g), "mean": mu, "sd": sd, "z": F.when(sd > 0, (F.col("value") - mu) / sd)})


def peers(members: DataFrame, series: DataFrame, key: str, time: str, value: str, size: str, groups: tuple[str, str], most: int, max_log_ratio: float, least_overlap: int, weights: tuple[float, float]) -> DataFrame:
    """(key, peer, rank, narrow_match, log_ratio, correlation, score): the most similar members.

    Candidates share the narrow group and are of like size; a member whose narrow group offers fewer than
    `most` takes those of the wide one instead, matches in the narrow group first. Members have one row a key, series one value a key and
    time. Groups fall into tiles of at most some TILE members and as many candidates, each with its packed series; all pairs of a tile
    are compared within its task (`peer_tiles`), and only each member's best leave it. Members without a positive size or a wide group
    have no peers and are none.
    """
    wide, narrow = groups
    a = members.select(F.col(key).alias("key"), F.col(wide).alias("w"), F.col(narrow).alias("n"), F.col(size).cast("double").alias("s")).where("s > 0 and w is not null")
    x = series.select(F.col(key).alias("key"), F.col(time).alias("t"), F.col(value).cast("double").alias("x")).where("key is not null and t is not null and x is not null")
    a = materialise(a.join(x.groupBy("key").agg(F.collect_list("t").alias("ts"), F.collect_list("x").alias("xs")), "key", "left"), "members")
    by_key = Window.partitionBy("key")
    def ranked(of: DataFrame, group: str) -> DataFrame:
        met = _tiles(of, a, group, most, max_log_ratio, least_overlap, weights)
        place = F.row_number().over(by_key.orderBy(F.desc("narrow_match"), F.desc(F.round("score", 9)), "peer"))
        return met.withColumns({"rank": place, "_k": F.count(F.lit(1)).over(by_key)}).where(F.col("rank") <= most)
    close = materialise(ranked(a, "n").where(F.col("_k") >= most), "close-peers")
    thin = a.join(sized(close.where("rank = 1").select("key")), "key", "left_anti")
    return close.unionByName(ranked(thin, "w")).select("key", "peer", "rank", "narrow_match", "log_ratio", F.col("c").alias("correlation"), "score")


def _tiles(of: DataFrame, others: DataFrame, group: str, most: int, max_log_ratio: float, least: int, weights: tuple[float, float]) -> DataFrame:
    """(key, peer, narrow_match, log_ratio, c, score): the best candidates of each member of `of`, from each tile of its group. A row of
    either side is copied once for each part that its group has on the other side."""
    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(group).alias("g")).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name)).where("g is not null")
    counts = sized(materialise(parts(of, "_of").join(parts(others, "_others"), "g"), "tiles"))
    def dealt(df: DataFrame, mine: str, theirs: str) -> DataFrame:
        own = F.pmod(F.xxhash64("key"), F.col(mine)).cast("int").alias(f"{mine}_at")
        named = [F.col(c).alias(c) for c in ("g", "key", "n", "s", "ts", "xs")]  # columns of their own, as both sides can be one frame
        return df.withColumn("g", F.col(group)).join(counts, "g").select(*named, own, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)).alias(f"{theirs}_at"))
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            return pa.table(peer_tiles.best(left, right, most, max_log_ratio, least, weights))
        kind = (left if left.num_rows else right).schema.field("key").type
        return pa.table({"key": pa.array([], kind), "peer": pa.array([], kind), "narrow_match": pa.array([], pa.bool_()), **{c: pa.array([], pa.float64()) for c in ("log_ratio", "c", "score")}})
    tile = ("g", "_of_at", "_others_at")
    kind = dict(of.dtypes)["key"]
    return dealt(of, "_of", "_others").groupBy(*tile).cogroup(dealt(others, "_others", "_of").groupBy(*tile)).applyInArrow(run, f"key {kind}, peer {kind}, narrow_match boolean, log_ratio double, c double, score double")


def top_share(df: DataFrame, by: Sequence[str], value: str, tops: Sequence[int], tie: Sequence[Column]) -> DataFrame:
    """Per group the sum of the n greatest values, for each n, beside the whole sum and count."""
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last(value), *tie)
    ranked = df.where(F.col(value).isNotNull()).withColumn("_rank", F.row_number().over(w))
    return ranked.groupBy(*by).agg(
        *[F.sum(F.when(F.col("_rank") <= n, F.col(value)).otherwise(0.0)).alias(f"top{n}") for n in tops], F.sum(value).alias("total"), F.count(F.lit(1)).alias("members")
    )


def lookback(spine: DataFrame, facts: DataFrame, key: str, at: str, when: str, days: int) -> DataFrame:
    """spine LEFT JOIN facts of the same key with when in [at - days, at], and their age in days.

    A fact is placed in the two blocks of days+1 days that can reach it, a spine row in its own, so the
    join is an equi-join on (key, block) and no key's whole history meets itself. The block comes
    out as `block`: aggregations that name it beside key and at need no further exchange.
    """
    block = days + 1
    s = spine.withColumn("_block", F.floor(F.unix_date(at) / block))
    rest = [c for c in facts.columns if c not in (key, when)]
    f = facts.select(
        F.col(key).alias("_fkey"), F.col(when).alias("_fwhen"), *rest, F.explode(F.array(F.floor(F.unix_date(when) / block), F.floor(F.unix_date(when) / block) + 1)).alias("_fblock")
    )
    age = F.datediff(F.col(at), F.col("_fwhen"))
    on = (F.col(key) == F.col("_fkey")) & (F.col("_block") == F.col("_fblock")) & age.between(0, days)
    # each spine row meets many facts: a merge join spreads that work by key and block, whatever the sides' sizes
    return s.join(f.hint("merge"), on, "left").withColumn("age", age).withColumnRenamed("_fwhen", when).drop("_fblock", "_fkey").withColumnRenamed("_block", "block")
