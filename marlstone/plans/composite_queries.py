"""The composite tables over the test tables, with the SQL that answers them by other means.

The test tables lack some columns of the composites' inputs (debt, cash, capital expenditure, mentions, turns): stand-ins
are worked out from columns they have, the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.operators import series as ts
from marlstone.operators.relational import latest_by
from marlstone.plans import composites as cp
from marlstone.plans.registry import Registry
from marlstone.plans.series_queries import BENCHMARK, DP, FW, KEYS, PX, daily, fundamentals, prices
from marlstone.plans.table_queries import DIM, companies
from marlstone.sources.tables import table

query = Registry()
TODAY = "2024-06-28"


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Doubles to a number of digits, as the SQL has them; a rounded zero has no sign."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _r(columns: dict[str, str], digits: int = 8) -> str:
    return ", ".join(f"round(({x})::double, {digits}) + 0.0 as {n}" for n, x in columns.items())


# inputs ---------------------------------------------------------------------------------------------

_INCOME = {"ebitda": "operating_income + floor(total_assets / 50.0)", "interest_expense": "floor((total_assets - total_equity) / 40.0)"}
_BALANCE = {
    "cash_and_equivalents": "floor(total_assets / 10.0)", "short_term_investments": "case when month(fiscal_date_ending) <> 12 then floor(total_assets / 25.0) end",
    "long_term_debt": "floor((total_assets - total_equity) / 2.0)", "short_term_debt": "floor((total_assets - total_equity) / 8.0)",
}
_CASH = {"capex": "operating_cashflow - free_cash_flow", "dividend_payout": "case when net_income > 0 then floor(net_income / 4.0) end"}
_ONLY = {"bal": "total_assets is not null", "cf": "operating_cashflow is not null"}
_PLAIN = {"inc": ["reported_currency", "total_revenue", "gross_profit", "operating_income", "net_income"], "bal": ["total_assets", "total_equity"], "cf": ["operating_cashflow", "free_cash_flow"]}
_MADE = {"inc": _INCOME, "bal": _BALANCE, "cf": _CASH}
_EARNED = ["reported_eps", "estimated_eps", "surprise", "surprise_pct", "report_date"]


def _wide(spark: SparkSession, d: str) -> DataFrame:
    f = fundamentals(spark, d)
    sides = [f.where(_ONLY.get(n, "true")).select(*KEYS, *_PLAIN[n], *[F.expr(f"cast({x} as bigint)").alias(c) for c, x in _MADE[n].items()], "pull_date") for n in ("inc", "bal", "cf")]
    e = latest_by(table(spark, d, "fact_earnings"), KEYS, [F.desc("pull_date"), F.desc_nulls_last("reported_eps"), F.desc_nulls_last("surprise")]).select(*KEYS, *_EARNED, "pull_date")
    return cp.fundamentals_wide(*sides, e)


_RATIOS = {
    "gross_margin": "gross_profit / nullif(total_revenue, 0)", "operating_margin": "operating_income / nullif(total_revenue, 0)", "net_margin": "net_income / nullif(total_revenue, 0)", "fcf_margin": "free_cash_flow / nullif(total_revenue, 0)",
    "ebitda_margin": "ebitda / nullif(total_revenue, 0)", "roe": "net_income / nullif(total_equity, 0)", "roa": "net_income / nullif(total_assets, 0)", "roic": "operating_income / nullif(coalesce(total_equity, 0) + coalesce(long_term_debt, 0), 0)",
    "debt_to_equity": "(coalesce(long_term_debt, 0) + coalesce(short_term_debt, 0)) / nullif(total_equity, 0)", "interest_coverage": "operating_income / nullif(interest_expense, 0)",
    "cash_conversion": "operating_cashflow / nullif(net_income, 0)", "accruals_ratio": "(net_income - operating_cashflow) / nullif(total_assets, 0)",
}
_SUMS = [c for c in cp.FLOWS]
_WIDE = f"""{FW}, e as (select * from fact_earnings qualify row_number() over (partition by symbol, fiscal_date_ending, period_type order by pull_date desc, reported_eps desc nulls last, surprise desc nulls last) = 1),
 {', '.join(f"{n} as (select symbol, fiscal_date_ending, period_type, {', '.join(_PLAIN[n])}, {', '.join(f'({x})::bigint as {c}' for c, x in _MADE[n].items())}, pull_date p_{n} from fw where {_ONLY.get(n, 'true')})" for n in ('inc', 'bal', 'cf'))},
 j0 as (select * exclude (p_inc, p_bal, p_cf, pull_date, universe0), greatest(coalesce(p_inc, date '1900-01-01'), coalesce(p_bal, date '1900-01-01'), coalesce(p_cf, date '1900-01-01'), coalesce(pull_date, date '1900-01-01')) as pull_date
  from inc full join bal using (symbol, fiscal_date_ending, period_type) full join cf using (symbol, fiscal_date_ending, period_type)
  full join (select symbol, fiscal_date_ending, period_type, {', '.join(_EARNED)}, pull_date, 0 universe0 from e) e2 using (symbol, fiscal_date_ending, period_type)),
 j1 as (select *, {', '.join(f"({x.replace(' / ', '::double / ', 1)}) as {n}" for n, x in _RATIOS.items())},
   coalesce(long_term_debt, 0) + coalesce(short_term_debt, 0) - coalesce(cash_and_equivalents, 0) - coalesce(short_term_investments, 0) as net_debt,
   {', '.join(f"({c} - case period_type when 'quarterly' then lag({c}, 4) over w else lag({c}, 1) over w end)::double / nullif(case period_type when 'quarterly' then lag({c}, 4) over w else lag({c}, 1) over w end, 0) as {n}" for n, c in cp.GROWTHS.items())},
   case period_type when 'quarterly' then (total_revenue - lag(total_revenue) over w)::double / nullif(lag(total_revenue) over w, 0) end as revenue_growth_qoq,
   {', '.join(f"case when period_type = 'quarterly' and count({c}) over n = 4 then sum({c}) over n end as {c}_ttm0" for c in _SUMS)},
   {', '.join(f"case when period_type = 'annual' and lag(reported_eps, {n}) over w > 0 and reported_eps > 0 then power(reported_eps / lag(reported_eps, {n}) over w, 1.0 / {n}) - 1 end g{n}" for n in (5, 3))}
  from j0 window w as (partition by symbol, period_type order by fiscal_date_ending), n as (partition by symbol, period_type order by fiscal_date_ending rows 3 preceding)),
 rates as (select symbol, arg_max(g5, fiscal_date_ending) filter (g5 is not null) eps_cagr_5y, arg_max(g3, fiscal_date_ending) filter (g3 is not null) eps_cagr_3y, max(fiscal_date_ending) eps_cagr_as_of from j1 where period_type = 'annual' group by 1),
 wide as (select j1.* exclude (g5, g3, {', '.join(f'{c}_ttm0' for c in _SUMS)}), {', '.join(f"{c}_ttm0::{'double' if c == 'reported_eps' else 'bigint'} as {c}_ttm" for c in _SUMS)}, eps_cagr_5y, eps_cagr_3y, eps_cagr_as_of from j1 left join rates using (symbol))"""
_DOUBLES = [*_RATIOS, *cp.GROWTHS, "revenue_growth_qoq", "reported_eps_ttm", "eps_cagr_5y", "eps_cagr_3y", "reported_eps", "estimated_eps", "surprise", "surprise_pct"]


@query(f"with {_WIDE} select * replace ({_r({c: c for c in _DOUBLES})}) from wide")
def fundamentals_wide(spark, d):
    return rounded(_wide(spark, d))


# prices ---------------------------------------------------------------------------------------------

_GOOD = "adjusted_close > 0 and adjusted_close < 100000 and not isnan(adjusted_close) and high > 0 and low > 0 and close > 0 and not isnan(high) and not isnan(low) and not isnan(close)"


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return cp.prices_enriched(daily(spark, d).where(_GOOD), BENCHMARK)


def _roll(agg: str, x: str, n: int, least: int) -> str:
    w = f"over (partition by symbol order by trade_date rows {n - 1} preceding)"
    return f"case when count({x}) {w} >= {least} then {agg}({x}) {w} end"


def _fold(col: str, alpha: float) -> str:
    return f"list_reduce({col}, lambda a, v: a * (1 - {alpha!r}) + {alpha!r} * v)"


_RETURNS = {f"return_{k}d": f"x / nullif(lag(x, {k}) over w, 0) - 1" for k in cp.RETURN_DAYS}
_PRICED = f"""{DP}, c0 as (select symbol, trade_date, open, high, low, close, adjusted_close, adjusted_close x, volume, volume::double v from dp where {_GOOD}),
 c1 as (select *, {', '.join(f'{x} as {n}' for n, x in _RETURNS.items())}, lag(close) over w pc, x - lag(x) over w step, row_number() over w n, list(x) over w xs from c0 window w as (partition by symbol order by trade_date)),
 c2 as (select *, {_roll('stddev_samp', 'return_1d', 30, 20)} * sqrt(252.0) volatility_30d, {_roll('stddev_samp', 'return_1d', 90, 60)} * sqrt(252.0) volatility_90d, close * v dollar_volume, {_roll('avg', 'v', 20, 10)} volume_avg_20d,
   {_roll('max', 'x', 252, 60)} high_52w, {_roll('min', 'x', 252, 60)} low_52w, {', '.join(f"{_roll('avg', 'x', k, k)} sma_{k}" for k in (20, 50, 200))}, {_roll('stddev_samp', 'x', 20, 20)} sd,
   greatest(abs(high - low), coalesce(abs(high - pc), 0), coalesce(abs(low - pc), 0)) tr, {_fold('xs', 2 / 13)} e12, {_fold('xs', 2 / 27)} e26,
   list(greatest(step, 0)) filter (step is not null) over w ups, list(greatest(-step, 0)) filter (step is not null) over w downs from c1 window w as (partition by symbol order by trade_date)),
 c3 as (select *, case when n >= 26 then e12 - e26 end macd, list(tr) over w trs from c2 window w as (partition by symbol order by trade_date)),
 c4 as (select *, list(macd) filter (macd is not null) over w ms from c3 window w as (partition by symbol order by trade_date)),
 c5 as (select *, case when n >= 34 then {_fold('ms', 2 / 10)} end macd_signal, case when n >= 15 then {_fold('ups', 1 / 14)} end up, case when n >= 15 then {_fold('downs', 1 / 14)} end down from c4),
 bench as (select trade_date, return_63d b63, return_126d b126, return_252d b252 from c1 where symbol = '{BENCHMARK}')"""
_WIDTHS = {c: 4 for c in ("ema_12", "ema_26", "macd", "macd_signal", "macd_hist", "rsi_14", "atr_14", "bb_pct_b")} | {"dollar_volume": 2, "volume_avg_20d": 4, "volatility_30d": 3, "volatility_90d": 3, "volume_ratio_20d": 5} | {c: 6 for c in ("bb_upper", "bb_lower", "rel_strength_3m", "rel_strength_6m", "rel_strength_12m")} | {"sma_200": 10}
_COLUMNS = {
    **{n: n for n in _RETURNS}, "volatility_30d": "volatility_30d", "volatility_90d": "volatility_90d", "dollar_volume": "dollar_volume", "volume_avg_20d": "volume_avg_20d", "volume_ratio_20d": "v / nullif(volume_avg_20d, 0)",
    "high_52w": "high_52w", "low_52w": "low_52w", "pct_off_52w_high": "(x - high_52w) / nullif(high_52w, 0)", "pct_off_52w_low": "(x - low_52w) / nullif(low_52w, 0)", "drawdown_from_52w_high": "(x - high_52w) / nullif(high_52w, 0)",
    "sma_20": "sma_20", "sma_50": "sma_50", "sma_200": "sma_200", "ema_12": "case when n >= 12 then e12 end", "ema_26": "case when n >= 26 then e26 end", "macd": "macd", "macd_signal": "macd_signal", "macd_hist": "macd - macd_signal",
    "bb_middle": "sma_20", "bb_upper": "sma_20 + 2 * sd", "bb_lower": "sma_20 - 2 * sd", "bb_pct_b": "case when sd > 1e-9 then (x - (sma_20 - 2 * sd)) / (4 * sd) end", "rsi_14": "100 - 100 / (1 + up / nullif(down, 0))", "atr_14": f"case when n >= 14 then {_fold('trs', 1 / 14)} end",
    **{f"rel_strength_{n}": f"(1 + return_{k}d) / nullif(1 + b{k}, 0) - 1" for n, k in cp.STRENGTH.items()},
}


@query(f"with {_PRICED} select symbol, trade_date, open, high, low, close, adjusted_close, volume, {', '.join(_r({n: x}, _WIDTHS.get(n, 8)) for n, x in _COLUMNS.items())} from c5 left join bench using (trade_date)")
def prices_enriched(spark, d):
    p = _enriched(spark, d)
    flat = F.col("bb_upper") - F.col("bb_lower") > 4e-9  # a band of no width, but for rounding
    p = p.withColumn("bb_pct_b", F.when(flat, F.col("bb_pct_b")))
    given = ("open", "high", "low", "close", "adjusted_close")
    return p.select(*[(F.round(c, _WIDTHS.get(c, 8)) + F.lit(0.0)).alias(c) if t == "double" and c not in given else F.col(c) for c, t in p.dtypes])


@query(
    f"""with {PX}, c0 as (select symbol, trade_date, close x from px), c1 as (select *, {', '.join(f'{x} as {n}' for n, x in _RETURNS.items())} from c0 window w as (partition by symbol order by trade_date)),
 c2 as (select *, {_roll('stddev_samp', 'return_1d', 30, 20)} * sqrt(252.0) volatility_30d, {_roll('stddev_samp', 'return_1d', 90, 60)} * sqrt(252.0) volatility_90d, {_roll('max', 'x', 252, 60)} high_252d, {_roll('min', 'x', 252, 60)} low_252d from c1)
select symbol as index_symbol, trade_date, x as close, {_r({**{n: n for n in _RETURNS}, 'high_252d': 'high_252d', 'low_252d': 'low_252d', 'pct_off_252d_high': '(x - high_252d) / nullif(high_252d, 0)'}, 7)}, {_r({'volatility_30d': 'volatility_30d', 'volatility_90d': 'volatility_90d'}, 6)} from c2"""
)
def index_returns(spark, d):
    p = cp.index_returns(prices(spark, d).select(F.col("symbol").alias("index_symbol"), "trade_date", "close"))
    return p.select(*[(F.round(c, 6 if c.startswith("vol") else 7) + F.lit(0.0)).alias(c) if t == "double" and c != "close" else F.col(c) for c, t in p.dtypes])


# valuation ------------------------------------------------------------------------------------------

_EV = "close * shares_outstanding + coalesce(long_term_debt, 0) + coalesce(short_term_debt, 0) - coalesce(cash_and_equivalents, 0) - coalesce(short_term_investments, 0)"
_AMOUNTS = ("market_cap", "enterprise_value")
_CAP = "(close * shares_outstanding)"
_VALUED = {
    "market_cap": _CAP, "enterprise_value": _EV, "pe_ttm": "case when reported_eps_ttm > 0 then close / reported_eps_ttm end", "ps_ttm": f"case when total_revenue_ttm > 0 then {_CAP} / total_revenue_ttm end", "pb": f"case when total_equity > 0 then {_CAP} / total_equity end",
    "ev_ebitda_ttm": f"case when ebitda_ttm > 0 then ({_EV}) / ebitda_ttm end", "fcf_yield_ttm": f"case when {_CAP} > 0 then free_cash_flow_ttm / {_CAP} end", "dividend_yield_ttm": f"case when {_CAP} > 0 then dividend_payout_ttm / {_CAP} end",
    "fair_pe": "case when eps_cagr_5y >= 0 then eps_cagr_5y * 100 / 2 + 8 end", "fair_pe_3y": "case when eps_cagr_3y >= 0 then eps_cagr_3y * 100 / 2 + 8 end",
    "fair_price": "case when eps_cagr_5y >= 0 and reported_eps_ttm > 0 then (eps_cagr_5y * 100 / 2 + 8) * reported_eps_ttm end", "fair_price_3y": "case when eps_cagr_3y >= 0 and reported_eps_ttm > 0 then (eps_cagr_3y * 100 / 2 + 8) * reported_eps_ttm end",
}
_VALUATION = f"""{_WIDE}, {PX}, {DIM}, co as (select key symbol, {', '.join(f"case when upper(trim({c})) not in ('', 'NONE', 'NULL') then trim({c}) end {c}" for c in ('sector', 'industry', 'asset_type', 'listing_status', 'name'))}, shares_outstanding, market_cap from dim),
 fq as (select *, coalesce(report_date, fiscal_date_ending + 60) eff from wide where period_type = 'quarterly' qualify row_number() over (partition by symbol, eff order by fiscal_date_ending desc) = 1),
 pc as (select px.symbol, px.trade_date, px.close, px.x adjusted_close, co.sector, co.industry, co.shares_outstanding from px left join co using (symbol)),
 val0 as (select pc.*, fq.fiscal_date_ending fundamentals_as_of, fq.eff fundamentals_effective_date, {', '.join(f'fq.{c}' for c in ('reported_eps_ttm', 'total_revenue_ttm', 'ebitda_ttm', 'free_cash_flow_ttm', 'dividend_payout_ttm', 'total_equity', 'long_term_debt', 'short_term_debt', 'cash_and_equivalents', 'short_term_investments', 'eps_cagr_5y', 'eps_cagr_3y'))}
   from pc asof left join fq on pc.symbol = fq.symbol and pc.trade_date >= fq.eff),
 val as (select symbol, trade_date, close, adjusted_close, sector, industry, shares_outstanding, fundamentals_as_of, fundamentals_effective_date, reported_eps_ttm, eps_cagr_5y, eps_cagr_3y, {', '.join(f'{x} as {n}' for n, x in _VALUED.items())} from val0)"""


def _companies(spark: SparkSession, d: str) -> DataFrame:
    return companies(spark, d).select(F.col("key").alias("symbol"), *[clean.token(c).alias(c) for c in ("sector", "industry", "asset_type", "listing_status", "name")], "shares_outstanding", "market_cap")


def _valuation(spark: SparkSession, d: str, wide: DataFrame) -> DataFrame:
    return cp.valuation_daily(prices(spark, d).select("symbol", "trade_date", "close", F.col("x").alias("adjusted_close")), _companies(spark, d), wide)


@query(
    f"""with {_VALUATION} select symbol, trade_date, close, adjusted_close, sector, industry, shares_outstanding, fundamentals_as_of, fundamentals_effective_date,
 {_r({c: c for c in ('reported_eps_ttm', 'eps_cagr_5y', 'eps_cagr_3y', *_VALUED) if c not in _AMOUNTS}, 5)}, {_r({c: c for c in _AMOUNTS}, 3)}, {_r({'upside_pct': 'case when close > 0 then (fair_price - close) / close end'}, 5)}, close <= 0.7 * fair_price as margin_of_safety_met from val"""
)
def valuation_daily(spark, d):
    v = _valuation(spark, d, _wide(spark, d))
    return v.select(*[(F.round(c, 3 if c in _AMOUNTS else 5) + F.lit(0.0)).alias(c) if t == "double" and c not in ("close", "adjusted_close") else F.col(c) for c, t in v.dtypes])


_TAKEN = ["total_revenue_ttm", "net_income_ttm", "ebitda_ttm", "free_cash_flow_ttm", "operating_cashflow_ttm", "reported_eps_ttm", "dividend_payout_ttm", "gross_margin", "operating_margin", "net_margin", "fcf_margin", "roe", "roa", "roic", "debt_to_equity", "net_debt", "revenue_growth_yoy", "eps_growth_yoy", "fcf_growth_yoy", "eps_cagr_5y", "eps_cagr_3y"]
_ENRICHED = f"""lq as (select symbol, fiscal_date_ending latest_quarter_end, {', '.join(_TAKEN)} from wide where period_type = 'quarterly' and total_revenue_ttm is not null qualify row_number() over (partition by symbol order by fiscal_date_ending desc) = 1),
 dn as (select symbol, trade_date, adjusted_close a, row_number() over (partition by symbol order by trade_date desc) n from dp where {_GOOD}),
 dl as (select symbol, max(trade_date) as_of_date, max(a) filter (n = 1) latest_close, {', '.join(f"max(a) filter (n = {n}) a{k}" for k, n in cp.YEARS_BACK.items())} from dn group by 1),
 rich as (select co.*, lq.* exclude (symbol), as_of_date, latest_close, {', '.join(f"(latest_close - a{k}) / nullif(a{k}, 0) as price_return_{k}" for k in cp.YEARS_BACK)}, latest_close * shares_outstanding as market_cap_latest from co left join lq using (symbol) left join dl using (symbol))"""
_RICH_DOUBLES = [c for c in _TAKEN if not c.endswith("_ttm") and c != "net_debt"] + ["reported_eps_ttm", "latest_close", *[f"price_return_{k}" for k in cp.YEARS_BACK]]


def _rich(spark: SparkSession, d: str, wide: DataFrame) -> DataFrame:
    return cp.company_enriched(_companies(spark, d), wide, daily(spark, d).where(_GOOD))


@query(f"with {_VALUATION}, {DP}, {_ENRICHED} select * replace ({_r({c: c for c in _RICH_DOUBLES}, 6)}, {_r({'market_cap_latest': 'market_cap_latest'}, 4)}) from rich")
def company_enriched(spark, d):
    rich = _rich(spark, d, _wide(spark, d))
    return rounded(rich.withColumn("market_cap_latest", F.round("market_cap_latest", 4)), 6)


_SNAPSHOT = f"""vd as (select * from val where trade_date = (select max(trade_date) from val)), fl as (select * from wide where period_type = 'quarterly' qualify row_number() over (partition by symbol order by fiscal_date_ending desc) = 1),
 long as (select symbol, metric, value::double as value from (select symbol, {', '.join(f'{c}::double {c}' for c in cp.PRICED_METRICS)} from vd) unpivot (value for metric in ({', '.join(cp.PRICED_METRICS)})) where not isnan(value)
   union all select symbol, metric, value::double from (select symbol, {', '.join(f'{c}::double {c}' for c in cp.REPORTED_METRICS)} from fl) unpivot (value for metric in ({', '.join(cp.REPORTED_METRICS)})) where not isnan(value)),
 snap as (select (select max(trade_date) from val) as_of_date, long.symbol, co.sector, co.industry, metric, value from long left join co using (symbol))"""


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    wide = _wide(spark, d)
    return cp.metric_snapshot(_valuation(spark, d, wide), wide, _companies(spark, d))


@query(
    f"""with {_VALUATION}, {_SNAPSHOT} select as_of_date, level as grouping_level, val as group_value, metric, count(*) as n, {_r({'mean': 'avg(value)', 'p25': 'quantile_cont(value, 0.25)', 'median': 'quantile_cont(value, 0.5)', 'p75': 'quantile_cont(value, 0.75)'}, 7)}
from (select as_of_date, unnest(['sector', 'industry']) level, unnest([sector, industry]) val, metric, value from snap) where val is not null group by all"""
)
def sector_aggregates(spark, d):
    return rounded(cp.sector_aggregates(_snapshot(spark, d)), 7)


def _standing(g: str) -> dict[str, str]:
    w = f"(partition by {g}, metric)"
    return {f"{g}_percentile": f"case when {g} is not null then percent_rank() over (partition by {g}, metric order by value) end", f"{g}_zscore": f"case when stddev_samp(value) over {w} > 0 then (value - avg(value) over {w}) / stddev_samp(value) over {w} end"}


@query(f"with {_VALUATION}, {_SNAPSHOT} select as_of_date, symbol, sector, industry, metric, {_r({'value': 'value', **_standing('sector'), **_standing('industry')}, 5)}, count(*) over (partition by sector, metric) as sector_n, count(*) over (partition by industry, metric) as industry_n from snap")
def peer_relative(spark, d):
    return rounded(cp.peer_relative(_snapshot(spark, d)), 5)


@query(
    f"""with {_VALUATION}, {DP}, {_ENRICHED}, m as (select symbol k, name, sector w, industry n, coalesce(market_cap_latest, market_cap)::double s from rich where asset_type = 'Stock' and lower(listing_status) = 'active' and sector is not null and latest_quarter_end is not null and coalesce(market_cap_latest, market_cap) > 0),
 ret as (select symbol k, trade_date t, x / nullif(lag(x) over (partition by symbol order by trade_date), 0) - 1 x from px), xr as (select * from ret where x is not null and t >= date '{TODAY}' - {cp.LOOKBACK_DAYS}),
 c as (select a.k, b.k peer, log10(b.s / a.s) lr, coalesce(a.n = b.n, false) nm, a.w = b.w wm from m a join m b on a.k <> b.k where abs(log10(b.s / a.s)) <= 2),
 p as (select *, sum(nm::int) over (partition by k) >= {cp.PEERS} enough from c), q as (select * from p where (enough and nm) or (not enough and wm)),
 r as (select q.k, q.peer, corr(a.x, b.x) c from q join xr a on a.k = q.k join xr b on b.k = q.peer and b.t = a.t group by 1, 2 having count(*) >= {cp.LEAST_DAYS}),
 s as (select q.*, r.c, 0.6 * (1 - abs(lr) / 2) + 0.4 * coalesce(c, 0) score from q left join r using (k, peer))
select k as symbol, row_number() over (partition by k order by nm desc, round(score, 9) desc, peer) as peer_rank, peer as peer_symbol, coalesce(co.name, peer) as peer_name, nm as industry_match, {_r({'log_cap_ratio': 'lr', 'return_corr_2y': 'c', 'score': 'score'}, 6)} from s left join co on co.symbol = s.peer qualify peer_rank <= {cp.PEERS}"""
)
def peer_sets(spark, d):
    p = prices(spark, d)
    returns = p.select("symbol", "trade_date", ts.change(F.col("x"), ts.series("symbol", "trade_date")).alias("return_1d"))
    return rounded(cp.peer_sets(_rich(spark, d, _wide(spark, d)), returns, TODAY), 6)


# texts ----------------------------------------------------------------------------------------------

_SCORE = "(n_chars % 200 - 100) / 100.0"


@query(
    f"""with a as (select doc_id url, published_at from documents where published_at is not null), m as (select doc_id url, unnest([symbol, '{BENCHMARK}']) ticker, {_SCORE} score, case when doc_id % 7 <> 0 then (doc_id % 5) / 4.0 end relevance from documents),
 j as (select ticker, published_at::date as day, score, relevance, case when score > 0.35 then 'Bullish' when score > 0.15 then 'Somewhat-Bullish' when score < -0.35 then 'Bearish' when score < -0.15 then 'Somewhat-Bearish' else 'Neutral' end label from m join a using (url) where ticker is not null)
select ticker as symbol, day as sentiment_date, count(*) as article_count, {_r({'avg_sentiment_score': 'avg(score)', 'weighted_avg_sentiment': 'sum(score * coalesce(relevance, 0)) / nullif(sum(coalesce(relevance, 0)), 0)'})},
 count(*) filter (label in ('Bullish', 'Somewhat-Bullish')) as bullish_count, count(*) filter (label in ('Bearish', 'Somewhat-Bearish')) as bearish_count from j group by 1, 2"""
)
def news_sentiment_daily(spark, d):
    docs = table(spark, d, "documents")
    score = F.expr(_SCORE).cast("double")
    mentions = docs.select(F.col("doc_id").alias("url"), F.explode(F.array("symbol", F.lit(BENCHMARK))).alias("ticker"), score.alias("score"), F.when(F.col("doc_id") % 7 != 0, (F.col("doc_id") % 5) / 4.0).alias("relevance"))
    mentions = mentions.withColumn("label", F.expr("case when score > 0.35 then 'Bullish' when score > 0.15 then 'Somewhat-Bullish' when score < -0.35 then 'Bearish' when score < -0.15 then 'Somewhat-Bearish' else 'Neutral' end"))
    return rounded(cp.news_sentiment_daily(docs.select(F.col("doc_id").alias("url"), F.col("published_at").alias("time_published")), mentions))


_TITLES = ("null", "'Operator'", "'Analyst - Research'", "'Chief Executive Officer'", "'CFO and Treasurer'", "'PACEOX Director'")
_TITLE = "case doc_id % 6 " + " ".join(f"when {i} then {t}" for i, t in enumerate(_TITLES)) + " end"
_QUARTER = "concat(cast(year(published_at) as {0}), 'Q', cast(quarter(published_at) as {0}))"
_MGMT, _ANALYST = "filter (r = 'management')", "filter (r = 'analyst')"


@query(
    f"""with t as (select symbol, case when published_at is not null then {_QUARTER.format('varchar')} end q, {_TITLE} title, case when doc_id % 9 <> 0 then (n_chars % 21 - 10) / 10.0 end s, length(coalesce(text, '')) n, published_at, source from documents where symbol is not null and published_at is not null),
 u as (select *, case when title is null then 'unknown' when title ilike '%operator%' then 'operator' when title ilike '%analyst%' then 'analyst' else 'management' end r, regexp_matches(coalesce(title, ''), '\\b(CEO|CFO|chief executive officer|chief financial officer)\\b', 'i') chief from t where s is not null),
 g as (select symbol, q, count(*) scored_turns, count(*) {_MGMT} mgmt_turns, count(*) {_ANALYST} analyst_turns, {_r({'overall_avg_sentiment': "avg(s) filter (r in ('management', 'analyst'))", 'mgmt_avg_sentiment': f'avg(s) {_MGMT}', 'analyst_avg_sentiment': f'avg(s) {_ANALYST}', 'ceo_cfo_avg_sentiment': 'avg(s) filter (chief)', 'mgmt_wtd_sentiment': f'sum(s * n) {_MGMT} / nullif(sum(n) {_MGMT}, 0)', 'analyst_wtd_sentiment': f'sum(s * n) {_ANALYST} / nullif(sum(n) {_ANALYST}, 0)', 'mgmt_analyst_spread': f'avg(s) {_MGMT} - avg(s) {_ANALYST}'})} from u group by 1, 2),
 calls as (select symbol, q, min(published_at)::date call_date, count(distinct source) participant_count from t group by 1, 2)
select g.* exclude (q), g.q as quarter, call_date, participant_count from g left join calls using (symbol, q)"""
)
def transcript_sentiment(spark, d):
    turns = table(spark, d, "documents").where("symbol is not null and published_at is not null").select(
        "symbol", F.expr(_QUARTER.format("string")).alias("quarter"), F.expr(_TITLE).alias("title"), F.expr("cast(case when doc_id % 9 <> 0 then (n_chars % 21 - 10) / 10.0 end as double)").alias("sentiment"), F.col("text").alias("content"), "published_at", "source"
    )
    calls = turns.groupBy("symbol", "quarter").agg(F.to_date(F.min("published_at")).alias("call_date"), F.count_distinct("source").alias("participant_count"))
    return rounded(cp.transcript_sentiment(turns, calls))
