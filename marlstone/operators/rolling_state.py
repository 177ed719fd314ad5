"""Totals over trailing calendar periods, held as a versioned daily state.

The state has one row per entity and calendar day; its version is the greatest of the ledger rows up to that day,
or of a later correction that reached it. Day d follows from day d-1 by one step:

    total(d) = total(d-1) + arrival(d) - arrival(d-W)

`advance` takes that step for one day, by joining yesterday's state with the
day's arrivals and the expiring day's amounts. `build` replays it over all days
at once, for a first load: arrivals and expiring amounts become one signed flow per day, summed
in day order. `correct` adds the effect of late or changed arrivals to exactly
the dates whose windows hold them, and gives those rows the new version; all other rows
pass as they are. `maintain` keeps a stored state: a first load up to yesterday, the step of
today, then the correction by what came late. Stored rows carry whether a known late arrival
reaches them (`stale`), so the correction reads those alone and the rest passes without a shuffle.

Amounts are decimals, so adding and later subtracting one leaves nothing
behind, and any order of steps gives equal totals.

Input that isn't clean: rows with a null entity or day can't be placed and are
left out. Of several rows of one entity and day the one with the greatest
`order` counts (ties: the greatest amounts), while `usable` is counted over all
of them. Null, NaN and infinite amounts add nothing. An amount of 10^(34-scale) or more
can't be added exactly: it is counted under `over`, and a total with over > 0 is not the whole one.
Further columns are ignored. An empty input gives an empty state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marlstone.session import fresh_path, observed, sized

KEYS = ["entity", "day"]


@dataclass(frozen=True)
class Measure:
    """amount is summed over `windows` days; usable tells rows that count as activity.

    parts are the totals to keep: the sum, the number of amounts, the usable rows, the amounts too large to add.
    """

    name: str
    amount: Column
    windows: tuple[int, ...]
    usable: Column | None = None
    scale: int = 6
    parts: tuple[str, ...] = ("sum", "n", "use", "over")

    def kind(self, part: str) -> str:
        return f"decimal(38,{self.scale})" if part == "sum" else "long"


def _ticks(m: Measure) -> Column:
    """The amount as a decimal with room for ten thousand of them, and whether it is too large for that."""
    x, size = m.amount, F.abs(m.amount.cast("double"))
    most = 10.0 ** (34 - m.scale)
    fits = ~F.isnan(size) & (size < most)
    return F.struct(F.when(fits, x).cast(m.kind("sum")).alias("a"), F.coalesce((size >= most) & (size < float("inf")), F.lit(False)).alias("x"))


def _columns(m: Measure) -> str:
    """The ledger's columns for m, by their first letters."""
    return "u" if set(m.parts) == {"use"} else "axu"


def ledger(df: DataFrame, entity: str, day: str, measures: Sequence[Measure], order: Sequence[Column], version: Column, late: Column | None = None) -> DataFrame:
    """One row per entity and day: a_<m> amount or null, x_<m> whether it is too large, u_<m> usable rows, version.

    a_ and x_ are there for measures that total more than usable rows. With `late`, these stand for all rows, and before_<column> for those that weren't late; `had` tells
    whether there was one. Aggregates before the shuffle, so an entity with a third of all rows sends
    at most one row per day and task.
    """
    usable = {m.name: m.usable if m.usable is not None else m.amount.isNotNull() for m in measures}
    summed = [m for m in measures if _columns(m) != "u"]
    best = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[_ticks(m).alias(m.name) for m in summed])
    in_time = F.lit(True) if late is None else ~F.coalesce(late, F.lit(False))
    scopes = {"": F.lit(True)} | ({} if late is None else {"before_": in_time})
    aggs = []
    for prefix, scope in scopes.items():
        aggs += [F.max(F.when(scope, best)).alias(f"{prefix}best")] if summed else []
        aggs.append(F.max(F.when(scope, version)).alias(f"{prefix}version"))
        aggs += [F.count_if(scope & usable[m.name]).alias(f"{prefix}u_{m.name}") for m in measures]
    rows = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull()).groupBy(F.col(entity).alias("entity"), F.col(day).cast("date").alias("day"))
    out = rows.agg(*aggs, *([] if late is None else [F.max(in_time).alias("had")]))
    taken = []
    for prefix in scopes:
        taken += [F.col(f"{prefix}best.{m.name}.{c}").alias(f"{prefix}{c}_{m.name}") for m in summed for c in "ax"]
        taken += [F.col(f"{prefix}u_{m.name}") for m in measures]
        taken.append(F.col(f"{prefix}version"))
    return out.select(*KEYS, *taken, *([] if late is None else ["had"]))


def _parts(m: Measure, prefix: str = "") -> list[tuple[str, Column]]:
    """What is totalled for a measure: amounts, how many there are, usable rows, amounts too large."""
    a, x, u = (F.col(f"{prefix}{c}_{m.name}") for c in "axu")
    every = {
        "sum": F.coalesce(a, F.lit(0).cast(m.kind("sum"))), "n": F.when(a.isNotNull(), 1).otherwise(0).cast("long"),
        "use": F.coalesce(u, F.lit(0)).cast("long"), "over": F.coalesce(x, F.lit(False)).cast("long"),
    }
    return [(p, every[p]) for p in m.parts]  # columns that aren't asked for needn't exist


def _totals(measures: Sequence[Measure]) -> list[tuple[Measure, int, str, str]]:
    """(measure, window, part, column) of every total."""
    return [(m, w, p, f"{p}_{m.name}_{w}") for m in measures for w in m.windows for p in m.parts]


def state_columns(measures: Sequence[Measure]) -> list[str]:
    return [c for *_, c in _totals(measures)]


def _reach(measures: Sequence[Measure]) -> int:
    return max(w for m in measures for w in m.windows)


def build(book: DataFrame, measures: Sequence[Measure], through: Column | None = None, stale: Column | None = None) -> DataFrame:
    """The state of every day from an entity's first to its last date, and of
    the days after until the last amount has expired (live = false there); up to the day `through`, if given.

    stale, over the book, marks its rows that a later correction will change: the state then has a
    column `stale`, true where such a row is in reach.

    One exchange by entity, shared by all windows; the rows of an entity are
    bounded by its calendar. Days without a row are filled in between a ledger
    day and its successor, so no calendar is joined.
    """
    by_day = Window.partitionBy("entity").orderBy("day")
    reach = _reach(measures)
    following = F.lead("day").over(by_day)
    until = F.coalesce(F.date_sub(following, 1), F.date_add("day", reach - 1))
    # a ledger is small beside the days it spans: the exchange is sized for what comes after it
    tasks = int(book.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dense = book.repartition(tasks, "entity").withColumn("_until", until if through is None else F.least(until, through)).withColumn("_ends", following.isNull())
    if through is not None:
        dense = dense.where(F.col("day") <= through)
    dense = dense.withColumn("_day", F.explode(F.sequence("day", "_until")))
    arrived = F.col("_day") == F.col("day")
    flows_in = [(m, p, f"{m.name}|{p}", c) for m in measures for p, c in _parts(m)]
    marks = [F.when(arrived & stale, F.col("_day")).alias("_stale")] if stale is not None else []
    dense = dense.select(
        "entity",
        F.col("_day").alias("day"),
        (~F.col("_ends") | arrived).alias("live"),
        F.when(arrived, F.col("version")).alias("_v"),
        *marks,
        *[F.when(arrived, c).otherwise(F.lit(0).cast(m.kind(p))).alias(k) for m, p, k, c in flows_in],
    )
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flows = [(F.col(f"{m.name}|{p}") - F.coalesce(F.lag(f"{m.name}|{p}", w).over(by_day), F.lit(0).cast(m.kind(p)))).cast(m.kind(p)).alias(f"flow_{c}") for m, w, p, c in _totals(measures)]
    totals = [F.sum(f"flow_{c}").over(running).cast(m.kind(p)).alias(c) for m, w, p, c in _totals(measures)]
    # only frames that grow: one that slides is added up anew for each row
    reached = [F.coalesce(F.datediff("day", F.max("_stale").over(running)) < reach, F.lit(False)).alias("stale")] if stale is not None else []
    return dense.select("*", *flows).select(*KEYS, "live", F.max("_v").over(running).alias("version"), *totals, *reached)


def advance(state: DataFrame, book: DataFrame, day: Column, measures: Sequence[Measure], stale: Column | None = None) -> DataFrame:
    """The state of one day from that of the day before.

    Joins yesterday's totals with the day's arrivals and, for each window, with
    the amounts of the day that expires. Entities seen first today start at zero; live tells those
    with a row today, so days of a gap are not live until `correct` learns that it ended. stale is as in `build`.
    """
    today = day.cast("date")
    windows = sorted({w for m in measures for w in m.windows})
    arrives = F.col("day") == today
    def net(m: Measure, w: int, c: Column) -> Column:
        return F.sum(F.when(arrives, c).when(F.col("day") == F.date_sub(today, w), -c)).cast(m.kind("sum"))
    near = F.col("day").between(F.date_sub(today, _reach(measures) - 1), today)
    marks = [] if stale is None else [F.max(near & stale).alias("_stale")]
    needed = F.col("day").isin(today, *[F.date_sub(today, w) for w in windows])
    moves = book.where(needed if stale is None else needed | (near & stale)).groupBy("entity").agg(
        *marks, F.max(arrives).alias("_has"), F.max(F.when(arrives, F.col("version"))).alias("_new"),
        *[net(m, w, c).alias(f"net_{p}_{m.name}_{w}") for m in measures for w in m.windows for p, c in _parts(m)],
    )
    yesterday = state.where(F.col("day") == F.date_sub(today, 1)).select("entity", F.col("version").alias("_old"), *state_columns(measures))
    out = yesterday.join(moves, "entity", "full_outer")
    out = out.where(F.col("_old").isNotNull() | F.coalesce("_has", F.lit(False)) | F.coalesce(*[F.col(c) for c in state_columns(measures)]).isNotNull())
    totals = [(F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"net_{c}"), F.lit(0))).cast(m.kind(p)).alias(c) for m, _, p, c in _totals(measures)]
    return out.select("entity", today.alias("day"), F.coalesce("_has", F.lit(False)).alias("live"), F.coalesce(F.greatest("_old", "_new"), "_old", "_new").alias("version"), *totals, *[F.coalesce("_stale", F.lit(False)).alias("stale") for _ in marks])


def _effects(change: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """entity, day, version and what to add to each total: every changed ledger day sent to the dates whose windows hold it, and to no others."""
    reach = _reach(measures)
    aged = change.select("entity", "version", F.posexplode(F.expr(f"sequence(day, date_add(day, {reach - 1}))")).alias("_age", "day"), *[f"{p}|{m.name}" for m in measures for p in m.parts])
    def part(m: Measure, p: str, w: int) -> Column:
        return F.sum(F.when(F.col("_age") < w, F.col(f"{p}|{m.name}"))).cast(m.kind(p)).alias(f"{p}_{m.name}_{w}")
    return aged.groupBy(*KEYS).agg(F.max("version").alias("version"), *[part(m, p, w) for m, w, p, _ in _totals(measures)])


def _moved(measures: Sequence[Measure]) -> Column:
    out = F.lit(False)
    for m in measures:
        for p in m.parts:
            out = out | (F.col(f"{p}|{m.name}") != 0)
    return out


def _amended(effects: DataFrame, rows: DataFrame, measures: Sequence[Measure], how: str) -> DataFrame:
    """The reached rows with the effects added and the new version."""
    old = rows.select(*KEYS, F.col("live"), F.col("version").alias("_v"), *[F.col(c).alias(f"old_{c}") for c in state_columns(measures)])
    # days of an entity shrink to little when shuffled: no side is to be broadcast for that
    met = effects.join(old.hint("merge"), KEYS, how)
    def added(m: Measure, p: str, c: str) -> Column:
        return (F.coalesce(F.col(f"old_{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0))).cast(m.kind(p)).alias(c)
    return met.select(*KEYS, "live", F.coalesce(F.greatest("version", "_v"), "version", "_v").alias("version"), *[added(m, p, c) for m, _, p, c in _totals(measures)])


def correct(state: DataFrame, before: DataFrame, after: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """The state once the ledger `before` has become `after`.

    Totals are linear in the ledger, so the difference of each changed ledger day is added to the dates
    it reaches. Entities that now begin earlier or end later get the missing dates; only
    entities whose span changed have their rows looked at for that.
    """
    reach, cols = _reach(measures), state_columns(measures)
    signed = [
        book.select(*KEYS, F.lit(sign).alias("sign"), F.when(F.lit(sign > 0), F.col("version")).alias("version"), *[(c * sign).alias(f"{p}|{m.name}") for m in measures for p, c in _parts(m)])
        for book, sign in ((after, 1), (before, -1))
    ]
    change = signed[0].unionByName(signed[1]).groupBy(*KEYS).agg(
        F.max("version").alias("version"), F.sum("sign").alias("_rows"), *[F.sum(f"{p}|{m.name}").alias(f"{p}|{m.name}") for m in measures for p in m.parts]
    ).where((F.col("_rows") != 0) | _moved(measures))
    effects = _effects(change, measures)
    spans = [book.groupBy("entity").agg(F.min("day").alias(f"f{i}"), F.max("day").alias(f"l{i}")) for i, book in enumerate((before, after))]
    span = spans[1].join(spans[0], "entity", "full_outer").where(~F.col("f0").eqNullSafe(F.col("f1")) | ~F.col("l0").eqNullSafe(F.col("l1")))
    missing = F.expr(
        f"""case when f1 is null then array() when f0 is null then sequence(f1, date_add(l1, {reach - 1}))
            else concat(if(f1 < f0, sequence(f1, date_sub(f0, 1)), array()),
                        if(l1 > l0, sequence(date_add(l0, {reach}), date_add(l1, {reach - 1})), array())) end"""
    )
    kinds = {c: m.kind(p) for m, _, p, c in _totals(measures)}
    blank = [F.lit(0).cast(kinds[c]).alias(c) for c in cols]
    kept = state.select(*KEYS, "live", "version", *cols)
    added = span.select("entity", F.explode(missing).alias("day"), F.lit(True).alias("live"), F.lit(None).cast(dict(state.dtypes)["version"]).alias("version"), *blank)
    rows = kept.unionByName(added)
    keys = effects.select(*KEYS)
    amended = _amended(effects, rows.join(sized(keys), KEYS, "left_semi"), measures, "left").withColumn("live", F.coalesce("live", F.lit(True)))
    out = rows.join(sized(keys), KEYS, "left_anti").unionByName(amended)
    ends = out.join(sized(span.select("entity", "f1", "l1", F.lit(True).alias("_new"))), "entity", "left")
    inside = F.col("_new").isNull() | F.col("day").between(F.col("f1"), F.date_add("l1", reach - 1))
    live = F.when(F.col("_new"), F.col("day") <= F.col("l1")).otherwise(F.col("live"))
    return ends.where(inside).select(*KEYS, live.alias("live"), "version", *cols)


def maintain(df: DataFrame, entity: str, day: str, measures: Sequence[Measure], order: Sequence[Column], version: Column, late: Column) -> DataFrame:
    """The corrected state of all days, from a state stored in the shared folder.

    The rows that came in time are loaded up to the day before the last one, the last day is a step from the stored
    state of its yesterday, and the rows that came late correct the dates they reach.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "state")
    seen = Observation()
    book = ledger(df, entity, day, measures, order, version, late).observe(seen, F.max("day").alias("last"))
    # a change of the ledger: the rows of a day that came late alter what the rows in time gave
    delta = [(pc[1] - pb[1]).alias(f"{pc[0]}|{m.name}") for m in measures for pc, pb in zip(_parts(m), _parts(m, "before_"), strict=True)]
    book = book.select("*", *delta)
    book = book.withColumn("changed", ~F.col("had") | _moved(measures))
    book.write.parquet(f"{path}/ledger")
    last = observed(seen).get("last")
    book = spark.read.schema(book.schema).parquet(f"{path}/ledger")
    in_time = book.select(*KEYS, *[F.col(f"before_{c}_{m.name}").alias(f"{c}_{m.name}") for m in measures for c in _columns(m)], F.col("before_version").alias("version"), "changed")
    if last is None:
        return build(in_time, measures)
    today = F.lit(last).cast("date")
    rows = f"{path}/rows"
    first = build(in_time, measures, F.date_sub(today, 1), F.col("changed"))
    first.write.parquet(rows)
    stored = spark.read.schema(first.schema).parquet(rows)
    step = advance(stored, in_time, today, measures, F.col("changed"))
    step.select(*first.columns).write.mode("append").parquet(rows)
    effects = _effects(book.where("changed"), measures)
    cols = [*KEYS, "live", "version", *state_columns(measures)]
    stored = spark.read.schema(first.schema).parquet(rows)
    return stored.where("not stale").select(*cols).unionByName(_amended(effects, stored.where("stale"), measures, "inner").select(*cols))
