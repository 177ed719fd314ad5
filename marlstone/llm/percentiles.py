"""Percentiles per sector and industry, and published statistics held against them: p4_ queries with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import log_sketch
from marlstone.session import materialise, sized
from marlstone.sources.tables import table

# The columns, levels and statistics of the published table.
METRICS = ("pe_ttm", "ps_ttm", "pb")
LEVELS = ("sector", "industry")
STATISTICS = {"p25": 0.25, "median": 0.5, "p75": 0.75}
FINE = 0.002


def _valued_once(spark: SparkSession, d: str) -> DataFrame:
    """Each (universe, symbol, trade_date) once, its latest built row."""
    rows = table(spark, d, "fact_valuation_daily").where("symbol is not null and trade_date is not null")
    best = F.max(F.struct("gold_built_utc", *METRICS, *LEVELS))
    out = rows.groupBy("universe", "symbol", "trade_date").agg(best.alias("b"))
    quarter = F.last_day(F.add_months(F.trunc("trade_date", "quarter"), 2))
    return out.select("universe", quarter.alias("as_of_date"), *[F.col(f"b.{c}").alias(c) for c in (*METRICS, *LEVELS)])


def _by_level(rows: DataFrame) -> DataFrame:
    """universe, as_of_date, grouping_level, group_value, metric, x: six rows per input row."""
    cells = F.array(*[F.struct(F.lit(g).alias("grouping_level"), F.col(g).alias("group_value"), F.lit(m).alias("metric"), F.col(m).alias("x")) for g in LEVELS for m in METRICS])
    return rows.select("universe", "as_of_date", F.inline(cells)).where("group_value is not null and x is not null and not isnan(x)")


GROUP = ["universe", "as_of_date", "grouping_level", "group_value", "metric"]


def _name() -> Column:
    """Groups travel as 64-bit hashes of their names, in which a null differs from any name and by its place."""
    return F.xxhash64(*[x for c in GROUP for x in (F.col(c).isNull(), F.col(c))])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Sketches tell for nearly all published statistics whether they are wrong: the counts below and
    through the bucket of v bound the shares of values < v and <= v. Only where the
    bounds leave it open are the values of that one bucket compared with v."""
    rows = materialise(_valued_once(spark, d), "valued")
    values = _by_level(rows).select(_name().alias("g"), "x")
    published = table(spark, d, "fact_sector_aggregates").select(
        F.struct(*GROUP).alias("names"), _name().alias("g"), F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.col(s).cast("double").alias("v")) for s, q in STATISTICS.items()]))
    ).where("v is not null and not isnan(v)").distinct()
    published = published.withColumn("bucket", log_sketch.bucket(F.col("v"), FINE))
    sketch = log_sketch.sketch(values, ["g"], F.col("x"), FINE)
    # published values go in as rows of their own bucket that count nothing
    marks = sketch.unionByName(published.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    ranked = log_sketch.ranked(marks, ["g"]).where("v is not null and total > 0")
    slack = F.lit(1.0) / F.col("total") + 0.02
    high = lambda below: F.col(below) / F.col("total") > F.col("q") + slack
    low = lambda upto: F.col(upto) / F.col("total") < F.col("q") - slack
    judged = ranked.withColumn("wrong", high("below") | low("upto")).withColumn("open", ~F.col("wrong") & (high("upto") | low("below")))
    judged = materialise(judged, "judged")
    asked = judged.where("open").select("names", "g", "bucket", "q", "v", "below", "total")
    near = values.withColumn("bucket", log_sketch.bucket(F.col("x"), FINE)).join(sized(asked.select("g", "bucket").distinct()), ["g", "bucket"], "left_semi")
    counted = near.join(asked, ["g", "bucket"]).groupBy("names", "q", "v").agg(
        F.first("total").alias("total"),
        (F.first("below") + F.count_if(F.col("x") < F.col("v"))).alias("lt"),
        (F.first("below") + F.count_if(F.col("x") <= F.col("v"))).alias("le"),
    )
    # a bucket without values leaves nothing open: its bounds are equal
    settled = counted.where(high("lt") | low("le"))
    return judged.where("wrong").select("names.*").unionByName(settled.select("names.*")).distinct().withColumn("as_of_date", F.col("as_of_date").cast("string"))


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """p25, median and p75 within 0.2 % per sector and industry: of each quarter and universe, and of all."""
    base = materialise(log_sketch.sketch(_by_level(_valued_once(spark, d)), GROUP, F.col("x"), FINE), "sketches")
    single = log_sketch.quantiles(base, GROUP, STATISTICS, FINE)
    rest = ["grouping_level", "group_value", "metric"]
    whole = log_sketch.quantiles(log_sketch.merge(base, rest), rest, STATISTICS, FINE)
    whole = whole.withColumns({"universe": F.lit(None).cast("string"), "as_of_date": F.lit(None).cast("date")})
    out = single.unionByName(whole).withColumn("as_of_date", F.col("as_of_date").cast("string"))
    return out.withColumns({name: F.round(name, 9) for name in STATISTICS})


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """What the sketches count, exactly comparable: values per group, from merged bucket counts."""
    base = log_sketch.sketch(_by_level(_valued_once(spark, d)), GROUP, F.col("x"), 0.01)
    total = log_sketch.merge(base, ["grouping_level", "group_value", "metric"])
    return total.groupBy("grouping_level", "group_value", "metric").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bucket") < 0, F.col("n")).otherwise(0)).alias("negative"))


QUERIES = {f.__name__: f for f in (p4_found, p4_percentiles, p4_counts)}

_LAST_VALUED = """
 once as (select universe, symbol, trade_date, sector, industry, pe_ttm, ps_ttm, pb from fact_valuation_daily
   where symbol is not null and trade_date is not null
   qualify row_number() over (partition by universe, symbol, trade_date order by gold_built_utc desc) = 1),
 cells as (
   select universe, trade_date, level, val, metric, x from (
     select universe, trade_date, unnest(['sector', 'industry']) level, unnest([sector, industry]) val, pe_ttm, ps_ttm, pb from once)
     unpivot (x for metric in (pe_ttm, ps_ttm, pb))
   where val is not null and not isnan(x))
"""



SQL = {
    "p4_found": f"""
with {_LAST_VALUED},
 stats as (select universe, as_of_date, grouping_level, group_value, metric, unnest([0.25, 0.5, 0.75]) q, unnest([p25, median, p75]) v from fact_sector_aggregates),
 counts as (select s.universe, s.as_of_date, s.grouping_level, s.group_value, s.metric, q, v, count(*) n,
    count(*) filter (x < v) lt, count(*) filter (x <= v) le
  from stats s join cells c on c.universe = s.universe and c.level = s.grouping_level and c.val = s.group_value and c.metric = s.metric
   and date_trunc('quarter', c.trade_date) = date_trunc('quarter', s.as_of_date)
  where v is not null and not isnan(v) group by all)
select distinct universe, strftime(as_of_date, '%Y-%m-%d') as as_of_date, grouping_level, group_value, metric from counts
where lt / n > q + 1.0 / n + 0.02 or le / n < q - 1.0 / n - 0.02
""",
    "p4_counts": f"""
with {_LAST_VALUED}
select level as grouping_level, val as group_value, metric, count(*) as n, count(*) filter (x < 0) as negative from cells group by all
""",
}

# gamma of a relative error of 0.002, as the sketch has it
_G = repr((1 + 0.002) / (1 - 0.002))
_MIDDLE = f"round(case when {{0}} = 0 then 0.0 else sign({{0}}) * pow({_G}::double, ceil(ln(abs({{0}})) / ln({_G}::double))) * (2 / ({_G}::double + 1)) end, 9)"
SQL["p4_percentiles"] = f"""
with {_LAST_VALUED},
 dated as (select universe, strftime(last_day(date_trunc('quarter', trade_date) + interval 2 month), '%Y-%m-%d') as_of_date, level, val, metric, x from cells),
 both_scopes as (select * from dated union all select null, null, level, val, metric, x from dated),
 ranked as (select universe, as_of_date, level grouping_level, val group_value, metric, count(*) n, list_sort(list(x)) xs from both_scopes group by all)
select universe, as_of_date, grouping_level, group_value, metric, n, {', '.join(f"{_MIDDLE.format(f'xs[floor({q} * (n - 1))::int + 1]')} as {name}" for name, q in (('p25', 0.25), ('median', 0.5), ('p75', 0.75)))} from ranked
"""
