"""Time-series queries: returns, moving statistics, recursive indicators, growth, as-of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.functions.arithmetic import cagr, growth, ratio, ratio_if_positive
from marlstone.operators import series as ts
from marlstone.operators.asof import asof_join
from marlstone.operators.relational import latest_by
from marlstone.plans.registry import Registry
from marlstone.sources.tables import table

query = Registry()

PX = """px as (select symbol, trade_date, close, adjusted_close x, volume::double v from fact_prices_enriched
 qualify row_number() over (partition by symbol, trade_date order by pull_date desc, gold_built_utc desc) = 1)"""
FW = """fw as (select * from fact_fundamentals_wide
 qualify row_number() over (partition by symbol, fiscal_date_ending, period_type order by pull_date desc, gold_built_utc desc) = 1)"""
DP = """dp as (select * from fact_daily_prices where symbol is not null and trade_date is not null
 qualify row_number() over (partition by symbol, trade_date order by pull_date desc, row_id desc) = 1)"""
BY = "window w as (partition by symbol order by trade_date)"


def prices(spark: SparkSession, d: str) -> DataFrame:
    df = latest_by(table(spark, d, "fact_prices_enriched"), ["symbol", "trade_date"], [F.desc("pull_date"), F.desc("gold_built_utc")], cluster=["symbol"])
    return df.select("symbol", "trade_date", "close", F.col("adjusted_close").alias("x"), F.col("volume").cast("double").alias("v"))


def fundamentals(spark: SparkSession, d: str) -> DataFrame:
    return latest_by(table(spark, d, "fact_fundamentals_wide"), ["symbol", "fiscal_date_ending", "period_type"], [F.desc("pull_date"), F.desc("gold_built_utc")], cluster=["symbol"])


def daily(spark: SparkSession, d: str) -> DataFrame:
    """The last pull of each day; re-pulls are dropped before the exchange, so a symbol that holds many of them doesn't travel whole."""
    df = table(spark, d, "fact_daily_prices").where("symbol is not null and trade_date is not null")
    return latest_by(df, ["symbol", "trade_date"], [F.desc("pull_date"), F.desc("row_id")])


def _w():
    return ts.series("symbol", "trade_date")


@query(f"with {DP} select row_id, symbol, trade_date, pull_date, volume from dp")
def latest_snapshot_dedup(spark, d):
    return daily(spark, d).select("row_id", "symbol", "trade_date", "pull_date", "volume")


@query(f"with {PX} select symbol, trade_date, " + ", ".join(f"round(x / nullif(lag(x, {k}) over w, 0) - 1, 8) as return_{k}" for k in (1, 5, 21, 63, 126, 200, 252)) + f" from px {BY}")
def period_returns(spark, d):
    return prices(spark, d).select("symbol", "trade_date", *[F.round(ts.change(F.col("x"), _w(), k), 8).alias(f"return_{k}") for k in (1, 5, 21, 63, 126, 200, 252)])


@query(
    f"""with {PX}, r as (select *, x / nullif(lag(x) over w, 0) - 1 r from px {BY})
select symbol, trade_date, {', '.join(f"round(case when count(r) over w{n} >= {m} then stddev_samp(r) over w{n} end * sqrt(252.0), 6) as volatility_{n}" for n, m in ((30, 20), (90, 60)))}
from r window w30 as (partition by symbol order by trade_date rows 29 preceding), w90 as (partition by symbol order by trade_date rows 89 preceding)"""
)
def rolling_volatility(spark, d):
    r = prices(spark, d).withColumn("r", ts.change(F.col("x"), _w()))
    return r.select("symbol", "trade_date", *[F.round(ts.volatility(F.col("r"), _w(), n, m), 6).alias(f"volatility_{n}") for n, m in ((30, 20), (90, 60))])


@query(
    f"""with {PX}, a as (select *, case when count(v) over n >= 10 then avg(v) over n end m from px window n as (partition by symbol order by trade_date rows 19 preceding))
select symbol, trade_date, round(close * v, 2) as dollar_volume, round(m, 4) as volume_avg, round(v / nullif(m, 0), 6) as volume_ratio from a"""
)
def volume_ratio(spark, d):
    a = prices(spark, d).withColumn("m", ts.rolling(F.avg, F.col("v"), _w(), 20, 10))
    return a.select("symbol", "trade_date", F.round(F.col("close") * F.col("v"), 2).alias("dollar_volume"), F.round("m", 4).alias("volume_avg"), F.round(ratio("v", "m"), 6).alias("volume_ratio"))


@query(
    f"""with {PX}, a as (select *, case when count(x) over n >= 60 then max(x) over n end hi, case when count(x) over n >= 60 then min(x) over n end lo
 from px window n as (partition by symbol order by trade_date rows 251 preceding))
select symbol, trade_date, hi as high_52w, lo as low_52w, round((x - hi) / nullif(hi, 0), 8) as drawdown, round((x - lo) / nullif(lo, 0), 8) as off_low from a"""
)
def range_52w_drawdown(spark, d):
    a = prices(spark, d).withColumns({"hi": ts.rolling(F.max, F.col("x"), _w(), 252, 60), "lo": ts.rolling(F.min, F.col("x"), _w(), 252, 60)})
    return a.select("symbol", "trade_date", F.col("hi").alias("high_52w"), F.col("lo").alias("low_52w"), F.round(growth("x", "hi"), 8).alias("drawdown"), F.round(growth("x", "lo"), 8).alias("off_low"))


@query(
    f"""with {PX}, a as (select symbol, trade_date, x, {', '.join(f"case when count(x) over w{n} >= {n} then avg(x) over w{n} end sma_{n}" for n in (20, 50, 200))},
  case when count(x) over w20 >= 20 then stddev_samp(x) over w20 end sd from px
 window {', '.join(f"w{n} as (partition by symbol order by trade_date rows {n - 1} preceding)" for n in (20, 50, 200))})
select symbol, trade_date, round(sma_20, 8) as sma_20, round(sma_50, 8) as sma_50, round(sma_200, 8) as sma_200, round(sma_20 + 2 * sd, 8) as bb_upper, round(sma_20 - 2 * sd, 8) as bb_lower,
 round(case when sd > 1e-9 then (x - (sma_20 - 2 * sd)) / (4 * sd) end, 4) as bb_pct_b from a"""
)
def sma_bollinger(spark, d):
    x = F.col("x")
    bands = ts.bollinger(x, _w())
    a = prices(spark, d).withColumns({f"sma_{n}": ts.rolling(F.avg, x, _w(), n, n) for n in (20, 50, 200)} | {k: v for k, v in bands.items() if k != "bb_middle"})
    flat = F.col("bb_upper") - F.col("bb_lower") > 4e-9
    return a.select("symbol", "trade_date", *[F.round(f"sma_{n}", 8).alias(f"sma_{n}") for n in (20, 50, 200)], F.round("bb_upper", 8).alias("bb_upper"), F.round("bb_lower", 8).alias("bb_lower"), F.round(F.when(flat, F.col("bb_pct_b")), 4).alias("bb_pct_b"))


def _fold(col: str, alpha: float) -> str:
    return f"list_reduce({col}, lambda a, v: a * (1 - {alpha!r}) + {alpha!r} * v)"


_CLEAN = """c as (select symbol, trade_date, adjusted_close::double x, high h, low l, close k from dp
  where adjusted_close > 0 and adjusted_close < 100000 and not isnan(adjusted_close) and high > 0 and low > 0 and close > 0 and not isnan(high) and not isnan(low) and not isnan(close))"""


def _ohlc(spark, d):
    ok = " and ".join(f"{c} > 0 and not isnan({c})" for c in ("adjusted_close", "high", "low", "close"))
    return daily(spark, d).where(f"{ok} and adjusted_close < 100000").select("symbol", "trade_date", "adjusted_close", "high", "low", "close")


def _indicators(spark, d, *names):
    out = ts.with_indicators(_ohlc(spark, d), "symbol", "trade_date", "close", "high", "low", "adjusted_close", names=names)
    return out.select("symbol", "trade_date", *[F.round(n, 4).alias(n) for n in names])


@query(
    f"""with {DP}, {_CLEAN}, l as (select *, list(x) over w xs, row_number() over w n from c {BY}),
 e as (select *, {_fold('xs', 2 / 13)} e12, {_fold('xs', 2 / 27)} e26 from l),
 m as (select *, case when n >= 26 then e12 - e26 end macd from e),
 s as (select *, list(macd) filter (macd is not null) over w ms from m {BY}),
 t as (select *, case when n >= 34 then {_fold('ms', 2 / 10)} end sig from s)
select symbol, trade_date, round(case when n >= 12 then e12 end, 4) as ema_12, round(case when n >= 26 then e26 end, 4) as ema_26, round(macd, 4) as macd, round(sig, 4) as macd_signal, round(macd - sig, 4) as macd_hist from t"""
)
def ema_macd(spark, d):
    return _indicators(spark, d, "ema_12", "ema_26", "macd", "macd_signal", "macd_hist")


@query(
    f"""with {DP}, {_CLEAN}, s as (select *, x - lag(x) over w step, row_number() over w n from c {BY}),
 l as (select *, list(greatest(step, 0)) filter (step is not null) over w g, list(greatest(-step, 0)) filter (step is not null) over w b from s {BY}),
 e as (select *, case when n >= 15 then {_fold('g', 1 / 14)} end up, case when n >= 15 then {_fold('b', 1 / 14)} end down from l)
select symbol, trade_date, round(100 - 100 / (1 + up / nullif(down, 0)), 4) as rsi_14 from e"""
)
def rsi_wilder(spark, d):
    return _indicators(spark, d, "rsi_14")


@query(
    f"""with {DP}, {_CLEAN}, s as (select *, lag(k) over w p, row_number() over w n from c {BY}),
 t as (select *, greatest(abs(h - l), coalesce(abs(h - p), 0), coalesce(abs(l - p), 0)) tr from s),
 l as (select *, list(tr) over w ts from t {BY})
select symbol, trade_date, round(case when n >= 14 then {_fold('ts', 1 / 14)} end, 4) as atr_14 from l"""
)
def atr_true_range(spark, d):
    return _indicators(spark, d, "atr_14")


BENCHMARK = "IDXBM"


@query(
    f"""with {PX}, r as (select symbol, trade_date, {', '.join(f"x / nullif(lag(x, {k}) over w, 0) - 1 r{k}" for k in (63, 126, 252))} from px {BY}),
 b as (select trade_date, r63 b63, r126 b126, r252 b252 from r where symbol = '{BENCHMARK}')
select symbol, trade_date, round((1 + r63) / nullif(1 + b63, 0) - 1, 8) as strength_63, round((1 + r126) / nullif(1 + b126, 0) - 1, 8) as strength_126, round((1 + r252) / nullif(1 + b252, 0) - 1, 8) as strength_252 from r left join b using (trade_date)"""
)
def relative_strength(spark, d):
    r = prices(spark, d).select("symbol", "trade_date", *[ts.change(F.col("x"), _w(), k).alias(f"r{k}") for k in (63, 126, 252)])
    # one row per day, whatever the number of symbols; the planner broadcasts it when its size allows
    b = r.where(F.col("symbol") == BENCHMARK).select("trade_date", F.col("r63").alias("b63"), F.col("r126").alias("b126"), F.col("r252").alias("b252"))
    j = r.join(b, "trade_date", "left")
    return j.select("symbol", "trade_date", *[F.round(ratio(1 + F.col(f"r{k}"), 1 + F.col(f"b{k}")) - 1, 8).alias(f"strength_{k}") for k in (63, 126, 252)])


@query(f"with {PX} select symbol, trade_date, round(x / first_value(x) over (partition by symbol order by trade_date) * 100, 6) as base100 from px where x is not null")
def base100_index(spark, d):
    return prices(spark, d).where("x is not null").select("symbol", "trade_date", F.round(F.col("x") / F.first("x").over(_w()) * 100, 6).alias("base100"))


@query(
    f"""with {PX}, r as (select symbol, x, trade_date, row_number() over (partition by symbol order by trade_date desc) n from px)
select symbol, max(trade_date) as latest_date, max(x) filter (n = 1) as latest, max(x) filter (n = 21) as month_ago, max(x) filter (n = 126) as half_year_ago,
 round(max(x) filter (n = 1) / nullif(max(x) filter (n = 126), 0) - 1, 8) as half_year_return from r group by symbol"""
)
def trailing_offsets(spark, d):
    """Ranks pivot in one conditional aggregation; no slice is joined to another."""
    back = Window.partitionBy("symbol").orderBy(F.desc("trade_date"))
    r = prices(spark, d).withColumn("n", F.row_number().over(back))
    at = {k: F.max(F.when(F.col("n") == n, F.col("x"))) for k, n in (("latest", 1), ("month_ago", 21), ("half_year_ago", 126))}
    out = r.groupBy("symbol").agg(F.max("trade_date").alias("latest_date"), *[v.alias(k) for k, v in at.items()])
    return out.withColumn("half_year_return", F.round(ratio("latest", "half_year_ago") - 1, 8))


@query(
    f"""with {PX} select symbol, round(min_by(x, trade_date), 4) as start_price, round(max_by(x, trade_date), 4) as end_price, round((max_by(x, trade_date) - min_by(x, trade_date)) / nullif(min_by(x, trade_date), 0) * 100, 2) as return_pct
from px where x is not null group by symbol having count(*) > 5"""
)
def basket_return_first_last(spark, d):
    g = prices(spark, d).where("x is not null").groupBy("symbol").agg(F.min_by("x", "trade_date").alias("a"), F.max_by("x", "trade_date").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 5")
    return g.select("symbol", F.round("a", 4).alias("start_price"), F.round("b", 4).alias("end_price"), F.round(growth("b", "a") * 100, 2).alias("return_pct"))


# fundamentals -------------------------------------------------------------------------------------

def _p():
    return Window.partitionBy("symbol", "period_type").orderBy("fiscal_date_ending")


PERIOD = "window w as (partition by symbol, period_type order by fiscal_date_ending)"
KEYS = ["symbol", "fiscal_date_ending", "period_type"]


@query(
    f"""with {FW} select symbol, fiscal_date_ending, period_type, round(gross_profit::double / nullif(total_revenue, 0), 8) as gross_margin, round(operating_income::double / nullif(total_revenue, 0), 8) as operating_margin,
 round(net_income::double / nullif(total_equity, 0), 8) as roe, round(net_income::double / nullif(total_assets, 0), 8) as roa, round(case when net_income > 0 then free_cash_flow::double / net_income end, 8) as cash_conversion,
 coalesce(operating_cashflow, 0) - abs(coalesce(free_cash_flow, 0)) as residual from fw"""
)
def safe_ratios(spark, d):
    f = fundamentals(spark, d)
    return f.select(
        *KEYS, *[F.round(ratio(a, b), 8).alias(n) for n, a, b in (("gross_margin", "gross_profit", "total_revenue"), ("operating_margin", "operating_income", "total_revenue"), ("roe", "net_income", "total_equity"), ("roa", "net_income", "total_assets"))],
        F.round(ratio_if_positive("free_cash_flow", "net_income"), 8).alias("cash_conversion"), (F.coalesce("operating_cashflow", F.lit(0)) - F.abs(F.coalesce("free_cash_flow", F.lit(0)))).alias("residual"),
    )


@query(
    f"""with {FW}, g as (select *, case when period_type = 'quarterly' then lag(total_revenue, 4) over w else lag(total_revenue, 1) over w end y, case when period_type = 'quarterly' then lag(total_revenue, 1) over w end q,
  case when period_type = 'quarterly' then lag(net_income, 4) over w else lag(net_income, 1) over w end ny from fw {PERIOD})
select symbol, fiscal_date_ending, period_type, round((total_revenue - y)::double / nullif(y, 0), 8) as revenue_yoy, round((total_revenue - q)::double / nullif(q, 0), 8) as revenue_qoq, round((net_income - ny)::double / nullif(ny, 0), 8) as income_yoy from g"""
)
def growth_yoy_qoq(spark, d):
    quarterly = F.col("period_type") == "quarterly"
    def year_ago(c: str):
        return F.when(quarterly, F.lag(c, 4).over(_p())).otherwise(F.lag(c, 1).over(_p()))
    return fundamentals(spark, d).select(
        *KEYS, F.round(growth("total_revenue", year_ago("total_revenue")), 8).alias("revenue_yoy"),
        F.round(growth("total_revenue", F.when(quarterly, F.lag("total_revenue", 1).over(_p()))), 8).alias("revenue_qoq"), F.round(growth("net_income", year_ago("net_income")), 8).alias("income_yoy"),
    )


TTM = ("total_revenue", "net_income", "free_cash_flow")


@query(
    f"""with {FW} select symbol, fiscal_date_ending, {', '.join(f"case when count({c}) over n = 4 then sum({c}) over n end::bigint as {c}_ttm" for c in TTM)} from fw where period_type = 'quarterly'
window n as (partition by symbol order by fiscal_date_ending rows 3 preceding)"""
)
def ttm_rolling_sum(spark, d):
    w = ts.series("symbol", "fiscal_date_ending")
    return fundamentals(spark, d).where("period_type = 'quarterly'").select("symbol", "fiscal_date_ending", *[ts.rolling(F.sum, F.col(c), w, 4, 4).alias(f"{c}_ttm") for c in TTM])


@query(
    f"""with {FW}, c as (select symbol, fiscal_date_ending, {', '.join(f"case when lag(total_revenue, {n}) over w > 0 and total_revenue > 0 then power(total_revenue::double / lag(total_revenue, {n}) over w, 1.0 / {n}) - 1 end c{n}" for n in (1, 2))}
  from fw where period_type = 'annual' window w as (partition by symbol order by fiscal_date_ending))
select symbol, fw.fiscal_date_ending, fw.period_type, round(l.c1, 8) as cagr_1y, round(l.c2, 8) as cagr_2y, l.as_of as cagr_as_of from fw left join
 (select symbol, arg_max(c1, fiscal_date_ending) filter (c1 is not null) c1, arg_max(c2, fiscal_date_ending) filter (c2 is not null) c2, max(fiscal_date_ending) as_of from c group by symbol) l using (symbol)"""
)
def cagr_latest_non_null(spark, d):
    """The latest non-null rates of each symbol beside all its rows; as_of is the latest annual date even if its rate is null."""
    f = fundamentals(spark, d)
    w = ts.series("symbol", "fiscal_date_ending")
    r = F.col("total_revenue")
    annual = f.where("period_type = 'annual'").select("symbol", "fiscal_date_ending", *[cagr(F.lag(r, n).over(w), r, n).alias(f"c{n}") for n in (1, 2)])
    last = annual.groupBy("symbol").agg(*[F.max_by(F.when(F.col(f"c{n}").isNotNull(), F.col(f"c{n}")), F.when(F.col(f"c{n}").isNotNull(), F.col("fiscal_date_ending"))).alias(f"c{n}") for n in (1, 2)], F.max("fiscal_date_ending").alias("cagr_as_of"))
    return f.join(last, "symbol", "left").select(*KEYS, F.round("c1", 8).alias("cagr_1y"), F.round("c2", 8).alias("cagr_2y"), "cagr_as_of")


@query(
    f"""with {FW}, e as (select * from fact_earnings qualify row_number() over (partition by symbol, fiscal_date_ending, period_type order by pull_date desc, reported_eps desc nulls last, surprise desc nulls last) = 1),
 s as (select symbol, as_of_date fiscal_date_ending, 'quarterly' period_type, max(shares_outstanding) shares from shares_history group by 1, 2),
 p as (select symbol, last_day(trade_date) fiscal_date_ending, 'quarterly' period_type, max(trade_date) last_trade from fact_prices_enriched where month(trade_date) % 3 = 0 group by 1, 2)
select symbol, fiscal_date_ending, period_type, fw.total_revenue, e.estimated_eps, s.shares, p.last_trade, greatest(coalesce(fw.pull_date, date '1900-01-01'), coalesce(e.pull_date, date '1900-01-01')) as pulled
from fw full join e using (symbol, fiscal_date_ending, period_type) full join s using (symbol, fiscal_date_ending, period_type) full join p using (symbol, fiscal_date_ending, period_type)"""
)
def full_outer_wide(spark, d):
    """Four sources, each with its key once, in one wide row per key."""
    from marlstone.operators.relational import assemble

    e = latest_by(table(spark, d, "fact_earnings"), KEYS, [F.desc("pull_date"), F.desc_nulls_last("reported_eps"), F.desc_nulls_last("surprise")])
    s = table(spark, d, "shares_history").groupBy("symbol", F.col("as_of_date").alias("fiscal_date_ending")).agg(F.max("shares_outstanding").alias("shares")).withColumn("period_type", F.lit("quarterly"))
    p = table(spark, d, "fact_prices_enriched").where("month(trade_date) % 3 = 0").groupBy("symbol", F.last_day("trade_date").alias("fiscal_date_ending")).agg(F.max("trade_date").alias("last_trade")).withColumn("period_type", F.lit("quarterly"))
    out = assemble([fundamentals(spark, d).select(*KEYS, "total_revenue", F.col("pull_date").alias("p1")), e.select(*KEYS, "estimated_eps", F.col("pull_date").alias("p2")), s, p], KEYS)
    old = F.lit("1900-01-01").cast("date")
    return out.select(*KEYS, "total_revenue", "estimated_eps", "shares", "last_trade", F.greatest(F.coalesce("p1", old), F.coalesce("p2", old)).alias("pulled"))


@query(
    f"""with {FW}, t as (select symbol, coalesce(report_date, fiscal_date_ending + 60) eff, fiscal_date_ending, case when count(total_revenue) over n = 4 then sum(total_revenue) over n end::bigint ttm
   from fw where period_type = 'quarterly' window n as (partition by symbol order by fiscal_date_ending rows 3 preceding)),
 u as (select * from t qualify row_number() over (partition by symbol, eff order by fiscal_date_ending desc) = 1), {PX}
select px.symbol, px.trade_date, u.fiscal_date_ending as known_period, u.ttm as revenue_ttm, round(case when u.ttm > 0 then px.close * 1e6 / u.ttm end, 8) as price_to_revenue
from px asof left join u on px.symbol = u.symbol and px.trade_date >= u.eff"""
)
def asof_valuation(spark, d):
    """Prices beside the trailing revenue that was published by then."""
    w = ts.series("symbol", "fiscal_date_ending")
    q = fundamentals(spark, d).where("period_type = 'quarterly'").select("symbol", F.coalesce("report_date", F.date_add("fiscal_date_ending", 60)).alias("eff"), F.col("fiscal_date_ending").alias("known_period"), ts.rolling(F.sum, F.col("total_revenue"), w, 4, 4).alias("revenue_ttm"))
    q = latest_by(q, ["symbol", "eff"], [F.desc("known_period")])
    out = asof_join(prices(spark, d).select("symbol", "trade_date", "close"), q, ["symbol"], "trade_date", "eff", ["known_period", "revenue_ttm"], block_days=None)
    return out.select("symbol", "trade_date", "known_period", "revenue_ttm", F.round(ratio_if_positive(F.col("close") * 1e6, F.col("revenue_ttm")), 8).alias("price_to_revenue"))


@query(
    f"""with {PX} select e.symbol, e.fiscal_date_ending, e.report_date, e.surprise_pct, p.trade_date as priced_on, p.x as price
from (select * from fact_earnings where report_date is not null qualify row_number() over (partition by symbol, fiscal_date_ending, period_type order by pull_date desc, reported_eps desc nulls last, surprise desc nulls last) = 1) e
 asof left join (select * from px where x is not null) p on e.symbol = p.symbol and e.report_date >= p.trade_date"""
)
def price_at_event(spark, d):
    e = latest_by(table(spark, d, "fact_earnings").where("report_date is not null"), KEYS, [F.desc("pull_date"), F.desc_nulls_last("reported_eps"), F.desc_nulls_last("surprise")])
    p = prices(spark, d).where("x is not null").select("symbol", "trade_date", F.col("trade_date").alias("priced_on"), F.col("x").alias("price"))
    return asof_join(e.select("symbol", "fiscal_date_ending", "report_date", "surprise_pct"), p, ["symbol"], "report_date", "trade_date", ["priced_on", "price"])


# calendar time ------------------------------------------------------------------------------------


@query(
    """with d as (select event_type, ts::date as day, sum(value) total, count(*) n from events group by 1, 2)
select event_type, day, round(sum(total) over y, 4) as total_365d, round(case when sum(n) over m >= 3 then avg(total) over m end, 4) as mean_30d from d
window y as (partition by event_type order by day range between interval 364 days preceding and current row), m as (partition by event_type order by day range between interval 29 days preceding and current row)"""
)
def time_range_rolling(spark, d):
    days = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    y, m = ts.days_before("event_type", "day", 365), ts.days_before("event_type", "day", 30)
    return days.select("event_type", "day", F.round(F.sum("total").over(y), 4).alias("total_365d"), F.round(F.when(F.sum("n").over(m) >= 3, F.avg("total").over(m)), 4).alias("mean_30d"))


@query(
    """with d as (select user_id, ts::date as day, round(sum(value), 4) total from events group by 1, 2), s as (select user_id, unnest(generate_series(min(day), max(day), interval 1 day))::date as day from d group by 1)
select user_id, day, coalesce(total, 0) as total from s left join d using (user_id, day)"""
)
def calendar_densify(spark, d):
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 4).alias("total"))
    return ts.densify(days, "user_id", "day", {"total": F.lit(0.0)})


@query(
    """with d as (select distinct user_id, ts::date as day, event_type from events)
select a.user_id, a.day, count(distinct b.event_type) as kinds, count(distinct b.event_type) >= 3 as cluster from (select distinct user_id, day from d) a join d b on b.user_id = a.user_id and b.day between a.day - 30 and a.day group by 1, 2"""
)
def cluster_events_30d(spark, d):
    """Distinct kinds in a sliding month, both ends included; at most one row per user, day and kind enters the window."""
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("k"))
    kinds = F.size(F.array_distinct(F.flatten(F.collect_list("k").over(ts.days_before("user_id", "day", 31)))))
    return days.select("user_id", "day", kinds.cast("long").alias("kinds"), (kinds >= 3).alias("cluster"))
