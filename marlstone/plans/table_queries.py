"""Relational, cross-sectional, cleaning, quality and incremental queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.functions.arithmetic import ratio, weighted_mean
from marlstone.operators import cross_section as cs
from marlstone.operators import relational as rel
from marlstone.plans.registry import Registry
from marlstone.plans.series_queries import DP, FW, PX, fundamentals, prices
from marlstone.session import materialise
from marlstone.sources.tables import table

query = Registry()

# joins --------------------------------------------------------------------------------------------

_TXN = "t as (select l_suppkey k, l_shipdate::date d, l_partkey who, case when l_returnflag = 'A' then l_quantity else -l_quantity end q, case when l_returnflag = 'A' then l_extendedprice else -l_extendedprice end usd from lineitem)"


@query(
    f"""with {_TXN}, spine as (select distinct k, date_trunc('month', d)::date as_of from t),
 j as (select s.k, s.as_of, t.* exclude (k), s.as_of - t.d age from spine s left join t on t.k = s.k and t.d between s.as_of - 180 and s.as_of)
select k as supplier, as_of as as_of_date, {', '.join(f"round(sum(case when age <= {n} then {c} else 0 end), 2) as net_{c}_{n}d" for c in ('q', 'usd') for n in (30, 90, 180))},
 count(distinct case when q > 0 then who end) as buyers_180d, count(distinct case when q < 0 then who end) as sellers_180d, count(distinct case when age <= 30 and q > 0 then who end) >= 3 as cluster_30d from j group by 1, 2"""
)
def lookback_signals(spark, d):
    """Signed totals and distinct actors over three look-back periods; an empty period gives zeros."""
    buy = F.col("l_returnflag") == "A"
    t = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("d"), F.col("l_partkey").alias("who"),
        F.when(buy, F.col("l_quantity")).otherwise(-F.col("l_quantity")).alias("q"), F.when(buy, F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("usd"),
    )
    spine = t.select("k", F.trunc("d", "month").alias("at")).distinct()
    j = cs.lookback(spine, t, "k", "at", "d", 180)
    # per actor first: distinct actors are then a count of flags, with no row copied for each distinct
    def near(c: str, n: int):
        return F.sum(F.when(F.col("age") <= n, F.col(c)).otherwise(0.0)).alias(f"{c}_{n}")
    sums = [(c, n) for c in ("q", "usd") for n in (30, 90, 180)]
    who = j.groupBy("k", "block", "at", "who").agg(*[near(c, n) for c, n in sums], F.max(F.col("q") > 0).alias("b"), F.max(F.col("q") < 0).alias("s"), F.max((F.col("age") <= 30) & (F.col("q") > 0)).alias("b30"))
    return who.groupBy("k", "block", "at").agg(
        *[F.round(F.sum(f"{c}_{n}"), 2).alias(f"net_{c}_{n}d") for c, n in sums], F.count_if("b").alias("buyers_180d"), F.count_if("s").alias("sellers_180d"), (F.count_if("b30") >= 3).alias("cluster_30d")
    ).withColumnsRenamed({"k": "supplier", "at": "as_of_date"}).drop("block")


DIM = """dim as (select * from (select *, upper(trim(symbol)) key from dim_company) where key is not null and key not in ('', 'NONE', 'NULL')
 qualify row_number() over (partition by key order by snapshot_date desc, last_updated desc, load_id desc, name desc nulls last) = 1)"""


def companies(spark, d) -> DataFrame:
    df = table(spark, d, "dim_company").withColumn("key", F.upper(clean.token("symbol"))).where("key is not null")
    return rel.latest_by(df, ["key"], [F.desc("snapshot_date"), F.desc("last_updated"), F.desc("load_id"), F.desc_nulls_last("name")])


@query(
    f"""with {DIM}, {PX}, last as (select symbol, max(trade_date) d, max_by(close, trade_date) c from px group by 1)
select key as symbol, coalesce(case when upper(trim(name)) not in ('', 'NONE', 'NULL') then trim(name) end, key) as name, c * shares_outstanding as cap, l.d as priced_on from dim left join last l on l.symbol = key"""
)
def dimension_spine(spark, d):
    """The dimension, kept whole, beside the latest price; blanks filled from a second source."""
    last = prices(spark, d).groupBy(F.col("symbol").alias("key")).agg(F.max("trade_date").alias("priced_on"), F.max_by("close", "trade_date").alias("c"))
    return companies(spark, d).join(last, "key", "left").select(F.col("key").alias("symbol"), F.coalesce(clean.first_truthy("name"), "key").alias("name"), (F.col("c") * F.col("shares_outstanding")).alias("cap"), "priced_on")


@query("select * from (select symbol, snapshot_date, name from dim_company where ipo_date <= snapshot_date and (delisted_date is null or delisted_date > snapshot_date))")
def point_in_time_universe(spark, d):
    at = F.col("snapshot_date")
    return table(spark, d, "dim_company").where((F.col("ipo_date") <= at) & (F.col("delisted_date").isNull() | (F.col("delisted_date") > at))).select("symbol", "snapshot_date", "name")


@query(
    """with h as (select distinct o_custkey, o_orderdate::date as day from orders where o_orderdate < timestamp '1998-01-01'), n as (select o_orderkey, o_custkey, o_orderdate::date as day from orders)
select o_orderkey, o_custkey, day from n where not exists (select 1 from h where h.o_custkey = n.o_custkey and h.day = n.day)"""
)
def anti_join_incremental(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return rel.not_yet(o, o.where("day < date '1998-01-01'"), ["o_custkey", "day"])


@query("select o_orderkey, o_orderdate::date as day from orders where o_orderdate::date > (select max(o_orderdate::date) from orders where o_orderdate < timestamp '2000-01-01')")
def high_water_mark(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return rel.above_high_water(o, o.where("day < date '2000-01-01'"), "day").select("o_orderkey", "day")


@query(
    """with names(a) as (select distinct upper(trim(symbol)) from dim_company where symbol is not null and trim(symbol) <> ''), known as (select distinct symbol from fact_prices_enriched),
 flat as (select regexp_replace(symbol, '[^A-Za-z0-9]', '', 'g') f, min(symbol) one from known group by 1 having count(*) = 1)
select a as symbol, coalesce(k.symbol, flat.one) as matched, case when k.symbol is not null then 'exact' when flat.one is not null then 'flat' else 'gap' end as how
from names left join known k on k.symbol = a left join flat on flat.f = regexp_replace(a, '[^A-Za-z0-9]', '', 'g')"""
)
def fuzzy_symbol_match(spark, d):
    names = table(spark, d, "dim_company").select(F.upper(F.trim("symbol")).alias("symbol")).where("symbol != ''").distinct()
    return rel.match_symbols(names, table(spark, d, "fact_prices_enriched").select(F.col("symbol").alias("k")), "symbol", "k").select("symbol", "matched", "how")


@query(
    """with f as (select symbol, fiscal_date_ending, max(pull_date) p, arg_max_null(estimated_eps, (pull_date, coalesce(estimated_eps, -1e9))) e from fact_earnings where pull_date <= date '2023-12-31' and period_type = 'quarterly' group by 1, 2)
select symbol, fiscal_date_ending, p as known_pull, e as estimate from f"""
)
def snapshot_asof(spark, d):
    """Each period as it was known on a day: the last pull up to then."""
    s = table(spark, d, "fact_earnings").where("pull_date <= date '2023-12-31' and period_type = 'quarterly'")
    last = F.max(F.struct("pull_date", F.coalesce("estimated_eps", F.lit(-1e9)).alias("o"), "estimated_eps"))
    return s.groupBy("symbol", "fiscal_date_ending").agg(last.alias("l")).select("symbol", "fiscal_date_ending", F.col("l.pull_date").alias("known_pull"), F.col("l.estimated_eps").alias("estimate"))


# aggregation, reshaping, ranks --------------------------------------------------------------------

_SNAP = """, v as (select * from fact_valuation_daily where trade_date = (select max(trade_date) from fact_valuation_daily)
  qualify row_number() over (partition by universe, symbol order by gold_built_utc desc) = 1),
 long as (select * from (select universe, symbol, sector, industry, pe_ttm, ps_ttm, pb from v) unpivot (value for metric in (pe_ttm, ps_ttm, pb)) where not isnan(value))"""


def _latest_valuation(spark, d) -> DataFrame:
    v = table(spark, d, "fact_valuation_daily")
    # a one-row side, so a broadcast of proven size; the date never leaves the plan
    newest = v.agg(F.max("trade_date").alias("trade_date"))
    return rel.latest_by(v.join(F.broadcast(newest), "trade_date"), ["universe", "symbol"], [F.desc("gold_built_utc")])


def _long(spark, d) -> DataFrame:
    return cs.melt(_latest_valuation(spark, d), ["universe", "symbol", "sector", "industry"], ["pe_ttm", "ps_ttm", "pb"])


@query(
    "with x as (select 1)" + _SNAP + """ select level as grouping_level, val as group_value, metric, count(*) as n, round(avg(value), 9) as mean, round(quantile_cont(value, 0.25), 9) as p25, round(quantile_cont(value, 0.5), 9) as median, round(quantile_cont(value, 0.75), 9) as p75
 from (select unnest(['sector', 'industry']) level, unnest([sector, industry]) val, metric, value from long) where val is not null group by 1, 2, 3"""
)
def sector_percentiles(spark, d):
    out = cs.percentiles_by_level(materialise(_long(spark, d), "long"), ["sector", "industry"], {"p25": 0.25, "median": 0.5, "p75": 0.75})
    return out.select("grouping_level", "group_value", "metric", "n", *[F.round(c, 9).alias(c) for c in ("mean", "p25", "median", "p75")])


@query(
    "with x as (select 1)" + _SNAP + """ select symbol, universe, metric, sector, round(case when sector is not null then percent_rank() over (partition by sector, metric order by value) end, 8) as pct_rank, count(*) over g as n,
 round((value - avg(value) over g) / case when stddev_samp(value) over g > 0 then stddev_samp(value) over g end, 6) as z from long window g as (partition by sector, metric)"""
)
def peer_relative_ranks(spark, d):
    r = cs.relative_standing(_long(spark, d), "sector")
    return r.select("symbol", "universe", "metric", "sector", F.round("pct_rank", 8).alias("pct_rank"), "n", F.round("z", 6).alias("z"))


@query(
    """with m as (select s_suppkey k, r_name w, n_name n, s_acctbal s from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where s_acctbal > 0),
 x as (select l_suppkey k, date_trunc('month', l_shipdate)::date t, sum(l_extendedprice) x from lineitem group by 1, 2),
 c as (select a.k, b.k peer, log10(b.s / a.s) lr, a.n = b.n nm from m a join m b on a.w = b.w and a.k <> b.k where abs(log10(b.s / a.s)) <= 2),
 p as (select *, sum(nm::int) over (partition by k) >= 5 narrow from c), q as (select * from p where not narrow or nm),
 r as (select q.k, q.peer, corr(a.x, b.x) c, count(*) cnt from q join x a on a.k = q.k join x b on b.k = q.peer and b.t = a.t group by 1, 2 having count(*) >= 24),
 s as (select q.*, r.c, 0.6 * (1 - abs(lr) / 2) + 0.4 * coalesce(c, 0) score from q left join r using (k, peer))
select k as supplier, peer, row_number() over (partition by k order by nm desc, round(score, 9) desc, peer) as rank, nm as narrow_match, round(lr, 8) as log_ratio, round(c, 6) as correlation, round(score, 6) as score from s qualify rank <= 5"""
)
def peer_sets_topk(spark, d):
    """Top peers by size and co-movement. The order of scores that agree to nine digits is by key."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    m = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("k"), "r_name", "n_name", "s_acctbal")
    x = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.trunc(F.to_date("l_shipdate"), "month").alias("t")).agg(F.sum("l_extendedprice").alias("x"))
    out = cs.peers(m, x, "k", "t", "x", "s_acctbal", ("r_name", "n_name"), 5, 2.0, 24, (0.6, 0.4))
    return out.select(F.col("key").alias("supplier"), "peer", F.col("rank").cast("long").alias("rank"), "narrow_match", F.round("log_ratio", 8).alias("log_ratio"), F.round("correlation", 6).alias("correlation"), F.round("score", 6).alias("score"))


@query(
    """with h as (select distinct symbol, pull_date, holder_name, shares_held from fact_institutional_holdings where shares_held is not null and holder_name is not null),
 r as (select *, row_number() over (partition by symbol, pull_date order by shares_held desc, holder_name) rk from h),
 g as (select symbol, pull_date, sum(case when rk <= 3 then shares_held else 0 end) top3, sum(case when rk <= 5 then shares_held else 0 end) top5, sum(shares_held) total, count(*) members from r group by 1, 2)
select symbol, pull_date, round(top3 / nullif(total, 0), 8) as top3_share, round(top5 / nullif(total, 0), 8) as top5_share, members, members - lag(members) over w as members_delta, total - lag(total) over w as total_delta from g window w as (partition by symbol order by pull_date)"""
)
def topn_concentration_delta(spark, d):
    h = table(spark, d, "fact_institutional_holdings").where("shares_held is not null and holder_name is not null").select("symbol", "pull_date", "holder_name", "shares_held").distinct()
    g = cs.top_share(h, ["symbol", "pull_date"], "shares_held", [3, 5], [F.col("holder_name")])
    w = Window.partitionBy("symbol").orderBy("pull_date")
    return g.select("symbol", "pull_date", F.round(ratio("top3", "total"), 8).alias("top3_share"), F.round(ratio("top5", "total"), 8).alias("top5_share"), "members", (F.col("members") - F.lag("members").over(w)).alias("members_delta"), (F.col("total") - F.lag("total").over(w)).alias("total_delta"))


@query(
    """select event_type, ts::date as day, count(*) as n, round(avg(value), 6) as mean, round(sum(value * k) / nullif(sum(k), 0), 6) as weighted, count(*) filter (value > 50) as high, count(*) filter (value <= 50) as low
from (select *, (props->>'$.k')::double / 100 k from events) group by 1, 2"""
)
def weighted_sentiment_daily(spark, d):
    w = F.get_json_object("props", "$.k").try_cast("double") / 100
    high = F.col("value") > 50
    return table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(weighted_mean(F.col("value"), w), 6).alias("weighted"), F.count_if(high).alias("high"), F.count_if(~high).alias("low")
    )


@query(
    """with t as (select *, case when source is null then 'unknown' when source ilike '%transcripts%' then 'operator' when doc_type ilike '%research%' then 'analyst' else 'management' end r, length(text) w, length(text) % 7 - 3 s from documents where text is not null)
select symbol, count(*) as turns, round(avg(s) filter (r = 'analyst'), 6) as analyst_mean, round(sum(s * w) filter (r = 'management') / nullif(sum(w) filter (r = 'management'), 0), 6) as management_weighted,
 round(avg(s) filter (r = 'management') - avg(s) filter (r = 'analyst'), 6) as spread, count(*) filter (r = 'operator') as operator_turns from t group by 1"""
)
def role_sentiment(spark, d):
    """Roles by ordered rules, then filtered and length-weighted means; the score stands in by arithmetic on the length."""
    role = F.when(F.col("source").isNull(), "unknown").when(F.col("source").ilike("%transcripts%"), "operator").when(F.col("doc_type").ilike("%research%"), "analyst").otherwise("management")
    t = table(spark, d, "documents").where("text is not null").select("symbol", role.alias("r"), F.length("text").alias("w")).withColumn("s", (F.col("w") % 7 - 3).cast("double"))
    def of(role: str, c):
        return F.when(F.col("r") == role, c)
    s, w = F.col("s"), F.col("w")
    analyst, management = F.avg(of("analyst", s)), F.avg(of("management", s))
    return t.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("turns"), F.round(analyst, 6).alias("analyst_mean"), F.round(weighted_mean(of("management", s), of("management", w)), 6).alias("management_weighted"),
        F.round(management - analyst, 6).alias("spread"), F.count_if(F.col("r") == "operator").alias("operator_turns"),
    )


@query(
    r"""select doc_id, regexp_matches(text, '\b(chief financial officer|CFO)\b', 'i') as names_cfo, regexp_extract(text, '[0-9]{4}Q[1-4]') as first_quarter, regexp_full_match(symbol, '[A-Z]+(-[A-Z])?') as symbol_ok,
 case when text ilike '%dividend%' then 'dividend' when text ilike '%guidance%' or text ilike '%expects%' then 'outlook' else 'other' end as topic from documents where text is not null"""
)
def regex_classify(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", t.rlike(r"(?i)\b(chief financial officer|CFO)\b").alias("names_cfo"), F.regexp_extract(t, "[0-9]{4}Q[1-4]", 0).alias("first_quarter"), F.col("symbol").rlike("^[A-Z]+(-[A-Z])?$").alias("symbol_ok"),
        F.when(t.ilike("%dividend%"), "dividend").when(t.ilike("%guidance%") | t.ilike("%expects%"), "outlook").otherwise("other").alias("topic"),
    )


@query("select n_name, metric, round(sum(value), 2) as total from (select n_name, c_acctbal, c_custkey::double k from customer join nation on c_nationkey = n_nationkey) unpivot (value for metric in (c_acctbal, k)) group by 1, 2")
def melt_unpivot(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_acctbal", F.col("c_custkey").alias("k"))
    return cs.melt(c, ["n_name"], ["c_acctbal", "k"]).groupBy("n_name", "metric").agg(F.round(F.sum("value"), 2).alias("total"))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("select o_orderdate::date as day, " + ", ".join(f"round(avg(o_totalprice) filter (o_orderpriority = '{p}'), 8) as p{p[0]}" for p in PRIORITIES) + " from orders group by 1")
def pivot_wide(spark, d):
    """Values of the pivot are given, so the plan is one pass and its columns are fixed."""
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).pivot("o_orderpriority", list(PRIORITIES)).agg(F.avg("o_totalprice"))
    return o.select("day", *[F.round(f"`{p}`", 8).alias(f"p{p[0]}") for p in PRIORITIES])


@query(
    """with q as (select unnest(generate_series(date '2023-01-01', date '2024-12-31', interval 3 month))::date q) select n_name, year(q) || 'Q' || quarter(q) as label from nation, q"""
)
def quarter_sequence(spark, d):
    q = rel.key_range(spark, "2023-01-01", "2024-12-31", "3 months").select(clean.quarter_label("at").alias("label"))
    return table(spark, d, "nation").select("n_name").crossJoin(F.broadcast(q))  # eight rows


@query(
    """with s as (select distinct symbol from fact_prices_enriched), v as (select distinct symbol from fact_valuation_daily), h as (select distinct symbol from shares_history)
select 'all' as side, count(*) as n from (select * from s union select * from v) union all select 'both', count(*) from (select * from s intersect select * from v) union all select 'only_prices', count(*) from (select * from s except select * from h)"""
)
def set_operations(spark, d):
    s, v, h = (table(spark, d, t).select("symbol").distinct() for t in ("fact_prices_enriched", "fact_valuation_daily", "shares_history"))
    parts = {"all": s.union(v).distinct(), "both": s.intersect(v), "only_prices": s.exceptAll(h)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    f"""with {FW}, l as (select * from fw where period_type = 'quarterly' and total_revenue is not null qualify row_number() over (partition by symbol order by fiscal_date_ending desc) = 1),
 s as (select symbol, unnest(['revenue', 'cost', 'operating_cost', 'below_line']) step, unnest([1, 2, 3, 4]) k, unnest([total_revenue, gross_profit - total_revenue, operating_income - gross_profit, net_income - operating_income]) amount from l)
select symbol, step, amount, coalesce(sum(amount) over (partition by symbol order by k rows between unbounded preceding and 1 preceding), 0)::bigint as base from s"""
)
def waterfall(spark, d):
    """Steps from revenue to income with a residual, each on the total of those before."""
    f = rel.latest_by(fundamentals(spark, d).where("period_type = 'quarterly' and total_revenue is not null"), ["symbol"], [F.desc("fiscal_date_ending")])
    c = F.col
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("step"), a.alias("amount")) for k, n, a in (
        (1, "revenue", c("total_revenue")), (2, "cost", c("gross_profit") - c("total_revenue")), (3, "operating_cost", c("operating_income") - c("gross_profit")), (4, "below_line", c("net_income") - c("operating_income")))])
    w = Window.partitionBy("symbol").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return f.select("symbol", F.inline(steps)).select("symbol", "step", "amount", F.coalesce(F.sum("amount").over(w), F.lit(0)).alias("base"))


@query(
    """with t as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::date as day, l_extendedprice usd, l_returnflag f, p_type from lineitem join part on p_partkey = l_partkey), q as (select quantile_cont(usd, 0.75) t from t where f = 'R')
select l_orderkey, l_linenumber, l_suppkey, day, usd, case when f = 'R' and usd >= q.t then 'large return' when f = 'A' and p_type ilike '%brass%' and usd > 0 then 'brass' end as label from t, q
where (f = 'R' and usd >= q.t) or (f = 'A' and p_type ilike '%brass%' and usd > 0)"""
)
def event_labels(spark, d):
    """Ordered rules, the last one winning, with a threshold taken from the data itself."""
    t = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("usd"), F.col("l_returnflag").alias("f"), "p_type")
    top = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").where("l_returnflag = 'R'")
    top = cs.exact_quantiles(top.select(F.lit(1).alias("g"), "l_extendedprice"), ["g"], F.col("l_extendedprice"), {"t": 0.75}).select("t")
    label = F.when((F.col("f") == "R") & (F.col("usd") >= F.col("t")), "large return").when((F.col("f") == "A") & F.col("p_type").ilike("%brass%") & (F.col("usd") > 0), "brass")
    return t.crossJoin(F.broadcast(top)).withColumn("label", label).where("label is not null").select("l_orderkey", "l_linenumber", "l_suppkey", "day", "usd", "label")


@query("select s_suppkey, s_acctbal, round(log10(s_acctbal / m.b), 8) as log_ratio from supplier, (select s_acctbal b, s_suppkey k from supplier where s_suppkey = 1) m where s_acctbal > 0 and m.b > 0 and s_suppkey <> m.k and abs(log10(s_acctbal / m.b)) <= 2 order by abs(log10(s_acctbal / m.b)), s_suppkey limit 20")
def one_row_cross_join(spark, d):
    """All rows against one: the top 20 by likeness of size."""
    s = table(spark, d, "supplier")
    me = s.where("s_suppkey = 1 and s_acctbal > 0").select(F.col("s_acctbal").alias("b"))
    lr = F.log10(F.col("s_acctbal") / F.col("b"))
    out = s.where("s_acctbal > 0 and s_suppkey != 1").crossJoin(F.broadcast(me)).withColumn("lr", lr).where("abs(lr) <= 2")
    return out.orderBy(F.abs("lr"), "s_suppkey").limit(20).select("s_suppkey", "s_acctbal", F.round("lr", 8).alias("log_ratio"))


@query("select sum(x)::double as top_total, (select round(sum(s_acctbal), 2) from supplier)::double as total, count(*) as n from (select round(s_acctbal, 2)::decimal(18,2) x from supplier order by s_acctbal desc nulls last, s_suppkey limit 50)")
def top_slice_coverage(spark, d):
    s = table(spark, d, "supplier")
    top = s.orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey").limit(50).agg(F.sum(F.round("s_acctbal", 2).cast("decimal(18,2)")).cast("double").alias("top_total"), F.count(F.lit(1)).alias("n"))
    return top.crossJoin(F.broadcast(s.agg(F.round(F.sum("s_acctbal"), 2).alias("total")))).select("top_total", "total", "n")


@query("select symbol, count(*) as periods, round(avg((surprise > 0)::int), 6) as beat_rate, min(fiscal_date_ending) as first_period, max(fiscal_date_ending) as last_period from fact_earnings where surprise is not null and period_type = 'quarterly' group by 1 having count(*) > 2")
def beat_rate(spark, d):
    e = table(spark, d, "fact_earnings").where("surprise is not null and period_type = 'quarterly'")
    return e.groupBy("symbol").agg(F.count(F.lit(1)).alias("periods"), F.round(F.avg((F.col("surprise") > 0).cast("int")), 6).alias("beat_rate"), F.min("fiscal_date_ending").alias("first_period"), F.max("fiscal_date_ending").alias("last_period")).where("periods > 2")


@query(
    """with e as (select distinct symbol, fiscal_date_ending f, strftime(fiscal_date_ending, '%m-%d') md from fact_earnings where period_type = 'annual'),
 c as (select symbol, md, count(*) n, min(f) first from e group by 1, 2), b as (select symbol, md, sum(n) over (partition by symbol) al from c qualify row_number() over (partition by symbol order by n desc, first) = 1)
select e.symbol, f as fiscal_date_ending from e join b using (symbol) where al < 3 or e.md = b.md"""
)
def mode_filter(spark, d):
    e = table(spark, d, "fact_earnings").where("period_type = 'annual'").select("symbol", "fiscal_date_ending").distinct()
    return rel.dominant(e, ["symbol"], F.date_format("fiscal_date_ending", "MM-dd"), F.col("fiscal_date_ending"))


@query(
    f"""with {DP} select row_id, symbol, trade_date, pull_date from dp"""
)
def upsert_idempotent(spark, d):
    """Two batches, the second given twice, end as one pass over all rows would."""
    df = table(spark, d, "fact_daily_prices").where("symbol is not null and trade_date is not null").select("row_id", "symbol", "trade_date", "pull_date")
    keys, order = ["symbol", "trade_date"], [F.desc("pull_date"), F.desc("row_id")]
    early, late = df.where("pull_date < date '2024-01-15'"), df.where("pull_date >= date '2024-01-15' or pull_date is null")
    once = rel.upsert(rel.upsert(None, early, keys, order), late, keys, order)
    return rel.upsert(once, late, keys, order)


# cleaning -----------------------------------------------------------------------------------------

_TOK = "case when upper(trim({c})) not in ('', 'NONE', 'NULL') then trim({c}) end"


@query(
    f"""select symbol, snapshot_date, load_id, {', '.join(_TOK.format(c=c) + f' as {c}' for c in ('sector', 'industry', 'currency'))}, try_cast(try_cast({_TOK.format(c='cik')} as double) as bigint) as cik_number, year(ipo_date) || 'Q' || quarter(ipo_date) as ipo_quarter from dim_company"""
)
def null_token_cleaning(spark, d):
    return table(spark, d, "dim_company").select("symbol", "snapshot_date", "load_id", *[clean.token(c).alias(c) for c in ("sector", "industry", "currency")], clean.to_long("cik").alias("cik_number"), clean.quarter_label("ipo_date").alias("ipo_quarter"))


_TEXTS = ("symbol", "name", "exchange", "asset_type", "cik", "sector", "industry", "country", "currency", "fiscal_year_end", "listing_status", "universe")


@query(" union all ".join(f"select '{c}' as column_name, count(*) filter ({c} = 'None') as n from dim_company" for c in _TEXTS))
def none_token_scan(spark, d):
    """Every text column of a table counted in one pass; the columns come from its schema."""
    df = table(spark, d, "dim_company")
    texts = [n for n, t in df.dtypes if t == "string"]
    one = df.agg(*clean.none_counts(df.dtypes))
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n")) for n in texts])))


@query("select doc_id, lower(trim(lang)) as lang, substr(source, 1, 8) as short_source, length(text) as n, split_part(symbol, '-', 1) as root, replace(doc_type, 'e', '3') as swapped, starts_with(symbol, 'Q') as q, published_at::date as day, quarter(published_at) as quarter from documents")
def scalar_functions(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.lower(F.trim("lang")).alias("lang"), F.substring("source", 1, 8).alias("short_source"), F.length("text").alias("n"), F.split_part("symbol", F.lit("-"), F.lit(1)).alias("root"),
        F.replace("doc_type", F.lit("e"), F.lit("3")).alias("swapped"), F.startswith("symbol", F.lit("Q")).alias("q"), F.to_date("published_at").alias("day"), F.quarter("published_at").alias("quarter"),
    )


# quality and coverage -----------------------------------------------------------------------------


@query(
    f"""with {DIM}, p as (select symbol, min(trade_date) lo, max(trade_date) hi, count(distinct trade_date) n from fact_daily_prices where trade_date is not null group by 1),
 a as (select key as symbol, greatest(coalesce(ipo_date, date '2023-06-01'), date '2023-06-01') wanted, lo, hi, coalesce(n, 0) n from dim left join p on p.symbol = key)
select symbol, wanted as wanted_from, lo as first_date, hi as last_date, n as observed, n = 0 as missing, greatest(coalesce(lo - wanted, 0), 0)::int as start_gap,
 case when n = 0 then 'no data' when lo > wanted + 30 then 'starts late' when hi < date '2024-06-01' then 'ends early' else 'covered' end as cause from a"""
)
def coverage_audit(spark, d):
    p = table(spark, d, "fact_daily_prices").where("trade_date is not null").groupBy(F.col("symbol").alias("key")).agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"), F.count_distinct("trade_date").alias("n"))
    floor = F.lit("2023-06-01").cast("date")
    a = companies(spark, d).join(p, "key", "left").select(F.col("key").alias("symbol"), F.greatest(F.coalesce("ipo_date", floor), floor).alias("wanted_from"), F.col("lo").alias("first_date"), F.col("hi").alias("last_date"), F.coalesce("n", F.lit(0)).alias("observed"))
    cause = F.when(F.col("observed") == 0, "no data").when(F.col("first_date") > F.date_add("wanted_from", 30), "starts late").when(F.col("last_date") < F.lit("2024-06-01").cast("date"), "ends early").otherwise("covered")
    return a.withColumns({"missing": F.col("observed") == 0, "start_gap": F.greatest(F.coalesce(F.datediff("first_date", "wanted_from"), F.lit(0)), F.lit(0)), "cause": cause})


@query("select cause, count(*) as symbols, quantile_cont(observed, 0.5) as p50, quantile_cont(observed, 0.95) as p95, sum(observed)::bigint as rows from (" + query.sql["coverage_audit"] + ") group by 1")
def coverage_summary(spark, d):
    audit = materialise(coverage_audit(spark, d).select("cause", "observed"), "audit")
    middle = cs.exact_quantiles(audit, ["cause"], F.col("observed"), {"p50": 0.5, "p95": 0.95}).select("cause", "p50", "p95")
    return audit.groupBy("cause").agg(F.count(F.lit(1)).alias("symbols"), F.sum("observed").alias("rows")).join(middle, "cause")


@query("select symbol, start_gap, row_number() over (order by start_gap desc nulls last, symbol) as place from (" + query.sql["coverage_audit"] + ") qualify place <= 25")
def coverage_triage(spark, d):
    """The 25 worst: a top-k by heap, and ranks only on those."""
    top = coverage_audit(spark, d).orderBy(F.desc_nulls_last("start_gap"), "symbol").limit(25)
    return top.select("symbol", "start_gap", F.row_number().over(Window.orderBy(F.desc_nulls_last("start_gap"), "symbol")).cast("long").alias("place"))


@query(
    """select 'null_rate' as check_name, round(100.0 * count(*) filter (adjusted_close is null) / nullif(count(*), 0), 4)::double as measure from fact_daily_prices
union all select 'unique_key', (select count(*) from (select 1 from fact_valuation_daily group by universe, symbol, trade_date having count(*) > 1))::double
union all select 'coverage', round(100.0 * count(distinct p.symbol) filter (v.symbol is not null) / nullif(count(distinct p.symbol), 0), 4)::double from (select distinct symbol from fact_prices_enriched) p left join (select distinct symbol from fact_valuation_daily) v using (symbol)
union all select 'out_of_bounds', count(*)::double from fact_institutional_holdings where pct_of_portfolio < 0 or pct_of_portfolio > 100
union all select 'row_count', count(*)::double from dim_company
union all select 'weekdays_stale', (select count(*) from (select unnest(generate_series(m + 1, date '2024-07-15', interval 1 day)) x from (select max(trade_date) m from fact_prices_enriched)) where isodow(x) < 6)::double"""
)
def dq_measures(spark, d):
    from marlstone.quality import checks

    return checks.measures(spark, {n: table(spark, d, n) for n in ("fact_daily_prices", "fact_valuation_daily", "fact_prices_enriched", "fact_institutional_holdings", "dim_company")}, "2024-07-15")


# the checksum of zip archives, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(symbol, ''), lambda c: ascii(c)::bigint)), lambda a, b:
  list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::bigint)), lambda x, y: xor(x >> 1, case when x & 1 = 1 then 3988292384::bigint else 0::bigint end))), 4294967295::bigint)"""


@query(
    f"""with l as (select regexp_extract(file_path, '/([^/]+)/\\d{{4}}-\\d{{2}}-\\d{{2}}', 1) symbol, max(try_cast(regexp_extract(file_path, '/([^/]+)/(\\d{{4}}-\\d{{2}}-\\d{{2}})', 2) as date)) as last from bronze_price_files group by 1)
select symbol, last from l where date '2024-07-15' - last <= 60 + {_CRC} % 19 - 9"""
)
def ttl_freshness_gate(spark, d):
    """Symbols whose latest file is still fresh on a day, with a term that varies by symbol."""
    files = table(spark, d, "bronze_price_files")
    stamp = F.regexp_extract("file_path", r"/([^/]+)/(\d{4}-\d{2}-\d{2})", 2).try_cast("date")
    last = files.groupBy(F.regexp_extract("file_path", r"/([^/]+)/\d{4}-\d{2}-\d{2}", 1).alias("symbol")).agg(F.max(stamp).alias("last"))
    return last.where(F.datediff(F.lit("2024-07-15").cast("date"), F.col("last")) <= 60 + clean.jitter_days("symbol", 60)).select("symbol", "last")


@query(
    """select file_id, symbol, pull_date from (select *, regexp_extract(file_path, '(\\d{4}-\\d{2}-\\d{2})', 1) stamp from bronze_price_files) where stamp <> '' qualify row_number() over (partition by symbol order by stamp desc, file_id desc) = 1"""
)
def latest_file_per_key(spark, d):
    files = table(spark, d, "bronze_price_files").withColumn("stamp", F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2})", 1)).where("stamp != ''")
    return rel.latest_by(files, ["symbol"], [F.desc("stamp"), F.desc("file_id")]).select("file_id", "symbol", "pull_date")


@query(
    """with r as (select file_id, unnest(from_json(json_extract(body, '$.holdings'), '["JSON"]')) rec, generate_subscripts(from_json(json_extract(body, '$.holdings'), '["JSON"]'), 1) - 1 as place from bronze_holdings_files where json_valid(body))
select file_id, place::int as place, coalesce(json_extract_string(rec, '$.holder_name.name'), json_extract_string(rec, '$.holder_name'), json_extract_string(rec, '$.name'), json_extract_string(rec, '$.institution')) as holder from r"""
)
def nested_explode(spark, d):
    """Array elements by place, the first of several alternate keys; an object yields its name."""
    rec = "array<struct<holder_name: variant, name: string, institution: string>>"
    files = table(spark, d, "bronze_holdings_files").select("file_id", F.posexplode(F.from_json("body", f"struct<holdings: {rec}>")["holdings"]).alias("place", "r"))
    plain = F.when(~F.schema_of_variant("r.holder_name").startswith("OBJECT"), F.try_variant_get("r.holder_name", "$", "string"))
    return files.select("file_id", "place", F.coalesce(F.try_variant_get("r.holder_name", "$.name", "string"), plain, "r.name", "r.institution").alias("holder"))


@query("select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 8) as avg_disc, count(*) as n from lineitem where l_shipdate <= timestamp '2001-06-01' group by 1, 2")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("2001-06-01").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 8).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("select universe, metric, n as group_n, count(*) as k from fact_sector_aggregates where grouping_level = 'sector' group by all")
def value_counts(spark, d):
    return table(spark, d, "fact_sector_aggregates").where("grouping_level = 'sector'").groupBy("universe", "metric", F.col("n").alias("group_n")).agg(F.count(F.lit(1)).alias("k"))


@query("select symbol, count(distinct trim(holder_name)) filter (trim(holder_name) <> '') as holders from fact_institutional_holdings group by 1")
def distinct_cleaned(spark, d):
    return table(spark, d, "fact_institutional_holdings").groupBy("symbol").agg(F.count_distinct(F.nullif(F.trim("holder_name"), F.lit(""))).alias("holders"))


@query("select e.symbol, e.fiscal_date_ending, e.estimated_eps, f.reported_eps, round(f.reported_eps - e.estimated_eps, 6) as miss from (select symbol, fiscal_date_ending, max(estimated_eps) estimated_eps from fact_earnings where period_type = 'quarterly' group by 1, 2) e join (select symbol, fiscal_date_ending, max(reported_eps) reported_eps from fact_fundamentals_wide where period_type = 'quarterly' group by 1, 2) f using (symbol, fiscal_date_ending)")
def reconcile_estimates(spark, d):
    e = table(spark, d, "fact_earnings").where("period_type = 'quarterly'").groupBy("symbol", "fiscal_date_ending").agg(F.max("estimated_eps").alias("estimated_eps"))
    f = table(spark, d, "fact_fundamentals_wide").where("period_type = 'quarterly'").groupBy("symbol", "fiscal_date_ending").agg(F.max("reported_eps").alias("reported_eps"))
    return e.join(f, ["symbol", "fiscal_date_ending"]).withColumn("miss", F.round(F.col("reported_eps") - F.col("estimated_eps"), 6))


@query("select symbol, trade_date, x as price from (select symbol, trade_date, adjusted_close x, row_number() over (partition by symbol order by trade_date desc, adjusted_close desc nulls last) r from (select distinct symbol, trade_date, adjusted_close from fact_prices_enriched)) where r <= 5")
def tail_per_group(spark, d):
    p = table(spark, d, "fact_prices_enriched").select("symbol", "trade_date", F.col("adjusted_close").alias("price")).distinct()
    return rel.top_by(p, ["symbol"], [F.desc("trade_date"), F.desc_nulls_last("price")], 5).drop("rank")


@query("select event_type, time_bucket(interval 1 hour, ts) as start, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def tumbling_windows(spark, d):
    """The batch twin of the streaming aggregate in marlstone.streaming."""
    from marlstone.streaming.aggregates import hourly

    return hourly(table(spark, d, "events"))



@query("select distinct symbol, year(fiscal_date_ending) || 'Q' || quarter(fiscal_date_ending) as label, report_date from fact_earnings where period_type = 'quarterly' and report_date between date '2024-03-01' - 60 and date '2024-03-01'")
def forward_targets(spark, d):
    """What was reported in the two months before a day, by quarter label: the targets of the next pull."""
    e = table(spark, d, "fact_earnings").where("period_type = 'quarterly' and report_date between date_sub(date '2024-03-01', 60) and date '2024-03-01'")
    return e.select("symbol", clean.quarter_label("fiscal_date_ending").alias("label"), "report_date").distinct()


@query("select l_orderkey, l_suppkey, l_extendedprice from lineitem where l_suppkey in (select s_suppkey from supplier where s_acctbal > 5000) and l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')")
def semi_and_anti_filters(spark, d):
    """Kept by membership in one set and absence from another; no column of either comes along."""
    rich = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    return li.join(rich, "l_suppkey", "left_semi").join(done, "l_orderkey", "left_anti").select("l_orderkey", "l_suppkey", "l_extendedprice")
