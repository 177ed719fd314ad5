"""The wide tables of the equity mart, each built in one plan from cleaned inputs.

Every input is first cut to one row per key, the latest pull's, so no join multiplies rows. Absent values stay
null through all arithmetic; only debt and cash count as 0 where a formula nets them. Every "today" is an argument.
Empty inputs give empty tables; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.arithmetic import cagr, growth, ratio, ratio_if_positive, weighted_mean
from marlstone.functions.clean import first_truthy
from marlstone.operators import cross_section as cs
from marlstone.operators import relational as rel
from marlstone.operators import series as ts
from marlstone.operators.asof import asof_join

PERIOD = ["symbol", "fiscal_date_ending", "period_type"]

# Names of columns, and the numbers of periods and days, that results share with existing tables.
FLOWS = ("total_revenue", "net_income", "operating_income", "ebitda", "free_cash_flow", "operating_cashflow", "reported_eps", "capex", "dividend_payout")
GROWTHS = {"revenue_growth_yoy": "total_revenue", "net_income_growth_yoy": "net_income", "eps_growth_yoy": "reported_eps", "fcf_growth_yoy": "free_cash_flow", "operating_cf_growth_yoy": "operating_cashflow"}
PRICED_METRICS = ("pe_ttm", "ps_ttm", "pb", "ev_ebitda_ttm", "fcf_yield_ttm", "dividend_yield_ttm")
REPORTED_METRICS = ("revenue_growth_yoy", "eps_growth_yoy", "gross_margin", "operating_margin", "net_margin", "roe", "roic")
RETURN_DAYS = (1, 5, 21, 63, 126, 252)
STRENGTH = {"3m": 63, "6m": 126, "12m": 252}
YEARS_BACK = {"1y": 252, "3y": 756, "5y": 1260}
FAIR_BASE, FAIR_SLOPE, SAFETY = 8.0, 0.5, 0.7
PEERS, MAX_LOG_RATIO, LEAST_DAYS, LOOKBACK_DAYS, WEIGHTS = 5, 2.0, 126, 564, (0.6, 0.4)
CHIEFS = r"(?i)\b(CEO|CFO|chief executive officer|chief financial officer)\b"


def _zero(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)) for n in names]


# fundamentals ---------------------------------------------------------------------------------------


def ratios() -> dict[str, Column]:
    debt_long, debt_short, cash, invested, equity = _zero("long_term_debt", "short_term_debt", "cash_and_equivalents", "short_term_investments", "total_equity")
    revenue = {"gross_margin": "gross_profit", "operating_margin": "operating_income", "net_margin": "net_income", "fcf_margin": "free_cash_flow", "ebitda_margin": "ebitda"}
    return {n: ratio(a, "total_revenue") for n, a in revenue.items()} | {
        "roe": ratio("net_income", "total_equity"),
        "roa": ratio("net_income", "total_assets"),
        "roic": ratio(F.col("operating_income"), equity + debt_long),
        "debt_to_equity": ratio(debt_long + debt_short, F.col("total_equity")),
        "net_debt": debt_long + debt_short - cash - invested,
        "interest_coverage": ratio("operating_income", "interest_expense"),
        "cash_conversion": ratio("operating_cashflow", "net_income"),
        "accruals_ratio": ratio(F.col("net_income") - F.col("operating_cashflow"), F.col("total_assets")),
    }


def fundamentals_wide(income: DataFrame, balance: DataFrame, cash: DataFrame, earnings: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """One row per (symbol, fiscal_date_ending, period_type) that any of the four inputs has: their columns,
    13 ratios, growth over a year and a quarter, sums of four quarters, and the latest rates of EPS growth over 5 and 3 years.

    Series are by symbol, so all windows share one exchange. Sums need four quarters without a null; annual rows have
    none. A rate is that of the last annual period that has one; its date is the last annual one's, with a rate or not.
    """
    sides = []
    for i, side in enumerate((income, balance, cash, earnings)):
        one = rel.latest_by(side, PERIOD, [F.desc_nulls_last("pull_date"), *order])
        sides.append(one.withColumnRenamed("pull_date", f"_pull{i}"))
    old = F.lit("1900-01-01").cast("date")
    wide = rel.assemble(sides, PERIOD).withColumn("pull_date", F.greatest(*[F.coalesce(F.col(f"_pull{i}"), old) for i in range(4)])).drop(*[f"_pull{i}" for i in range(4)])
    wide = wide.repartition("symbol").withColumns(ratios())
    w = Window.partitionBy("symbol", "period_type").orderBy("fiscal_date_ending")
    quarterly = F.col("period_type") == "quarterly"
    def before(c: str) -> Column:
        return F.when(quarterly, F.lag(c, 4).over(w)).otherwise(F.lag(c, 1).over(w))
    grown = {n: growth(c, before(c)) for n, c in GROWTHS.items()} | {"revenue_growth_qoq": growth("total_revenue", F.when(quarterly, F.lag("total_revenue", 1).over(w)))}
    sums = {f"{c}_ttm": F.when(quarterly, ts.rolling(F.sum, F.col(c), w, 4, 4)) for c in FLOWS}
    eps = F.when(F.col("period_type") == "annual", F.col("reported_eps"))
    rates = {f"_eps_{n}y": cagr(F.lag(eps, n).over(w), eps, n) for n in (5, 3)}
    wide = wide.withColumns(grown | sums | rates)
    # per symbol the last rate that isn't null, from the same exchange
    whole = Window.partitionBy("symbol").orderBy(F.when(F.col("period_type") == "annual", F.col("fiscal_date_ending"))).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    latest = {f"eps_cagr_{n}y": F.last(f"_eps_{n}y", ignorenulls=True).over(whole) for n in (5, 3)}
    as_of = F.max(F.when(F.col("period_type") == "annual", F.col("fiscal_date_ending"))).over(whole)
    return wide.withColumns(latest | {"eps_cagr_as_of": as_of}).drop("_eps_5y", "_eps_3y")


def analyst_ratios() -> dict[str, Column]:
    """Liquidity and investment beside the ratios of the wide table; missing cash counts as 0 only if the other part is there."""
    cash, invested = _zero("cash_and_equivalents", "short_term_investments")
    held = F.coalesce("cash_and_equivalents", "short_term_investments").isNotNull()
    return {
        "current_ratio": ratio("current_assets", "current_liabilities"),
        "cash_and_investments": F.when(held, cash + invested),
        "capex_pct_of_revenue": ratio(F.abs("capex") * 100.0, F.col("total_revenue")),
        "fcf_pct_of_revenue": ratio(F.col("free_cash_flow") * 100.0, F.col("total_revenue")),
    }


def insider_label(large: Column, cluster: Column) -> Column:
    """A label of a transaction (executive_title, bought, usd): the last rule that holds, and a mark if three or more bought within the month."""
    chief, buys = F.coalesce("executive_title", F.lit("")).rlike(CHIEFS), F.col("bought")
    label = F.when(buys & chief, "chief buys").when(buys & (F.col("usd") >= large), "large buy").when(~buys & (F.col("usd") >= large), "large sale")
    return F.when(label.isNotNull(), F.concat(label, F.when(buys & cluster, " + cluster buy").otherwise("")))


# prices ---------------------------------------------------------------------------------------------


def _window(key: str):
    return ts.series(key, "trade_date")


def price_measures(x: Column, key: str) -> dict[str, Column]:
    """Returns over 1 to 252 rows of a series, one by one."""
    return {f"return_{k}d": ts.change(x, _window(key), k) for k in RETURN_DAYS}


def prices_enriched(daily: DataFrame, benchmark: str) -> DataFrame:
    """A row per (symbol, trade_date) with returns, volatility, volume, range, moving averages, bands, the recursive
    indicators and the strength against one symbol. daily holds open to volume and adjusted_close, its key once.

    One exchange by symbol serves the recursion, which runs once for all seven indicators, and one all windows. Without
    the benchmark, or on days it lacks, strength is null.
    """
    w, x = _window("symbol"), F.col("adjusted_close")
    base = ts.with_indicators(daily, "symbol", "trade_date", "close", "high", "low", "adjusted_close", keep=["open", "high", "low", "close", "adjusted_close", "volume"])
    out = base.withColumns(price_measures(x, "symbol"))
    volume = F.col("volume").cast("double")
    high, low = ts.rolling(F.max, x, w, 252, 60), ts.rolling(F.min, x, w, 252, 60)
    out = out.withColumns(
        {
            "volatility_30d": ts.volatility(F.col("return_1d"), w, 30, 20), "volatility_90d": ts.volatility(F.col("return_1d"), w, 90, 60),
            "dollar_volume": F.col("close") * volume, "volume_avg_20d": ts.rolling(F.avg, volume, w, 20, 10), "high_52w": high, "low_52w": low,
            **{f"sma_{n}": ts.rolling(F.avg, x, w, n, n) for n in (20, 50, 200)}, **ts.bollinger(x, w),
        }
    )
    out = out.withColumns({"volume_ratio_20d": ratio(volume, F.col("volume_avg_20d")), "pct_off_52w_high": growth(x, F.col("high_52w")), "pct_off_52w_low": growth(x, F.col("low_52w"))})
    out = out.withColumn("drawdown_from_52w_high", F.col("pct_off_52w_high"))
    # the benchmark's own returns come from its rows alone; one row per day, however many symbols there are
    own = daily.where(F.col("symbol") == benchmark).select("symbol", "trade_date", "adjusted_close")
    own = own.select("trade_date", *[(1 + ts.change(x, w, k)).alias(f"_b{k}") for k in STRENGTH.values()])
    out = out.join(own, "trade_date", "left")
    return out.withColumns({f"rel_strength_{n}": ratio(1 + F.col(f"return_{k}d"), F.col(f"_b{k}")) - 1 for n, k in STRENGTH.items()}).drop(*[f"_b{k}" for k in STRENGTH.values()])


def index_returns(index: DataFrame, key: str = "index_symbol") -> DataFrame:
    """Returns, volatility and range of index levels (close), its key once per day."""
    w, c = _window(key), F.col("close")
    out = index.repartition(key).withColumns(price_measures(c, key))
    out = out.withColumns({"volatility_30d": ts.volatility(F.col("return_1d"), w, 30, 20), "volatility_90d": ts.volatility(F.col("return_1d"), w, 90, 60), "high_252d": ts.rolling(F.max, c, w, 252, 60), "low_252d": ts.rolling(F.min, c, w, 252, 60)})
    return out.withColumn("pct_off_252d_high", growth(c, F.col("high_252d")))


# valuation ------------------------------------------------------------------------------------------


def valuation_daily(prices: DataFrame, companies: DataFrame, wide: DataFrame) -> DataFrame:
    """Every price row beside the quarter known on its day: capitalisation, enterprise value, ratios, yields, fair price.

    A quarter is known from its report date, else 60 days after its end; of several known from one day the last counts.
    A ratio with a denominator that isn't positive is null. The fair multiple is 8 plus half of a growth rate in
    percent that isn't negative; a fair price needs positive earnings.
    """
    wanted = ["reported_eps_ttm", "total_revenue_ttm", "ebitda_ttm", "free_cash_flow_ttm", "dividend_payout_ttm", "total_equity", "long_term_debt", "short_term_debt", "cash_and_equivalents", "short_term_investments", "eps_cagr_5y", "eps_cagr_3y"]
    quarters = wide.where("period_type = 'quarterly'").select("symbol", F.coalesce("report_date", F.date_add("fiscal_date_ending", 60)).alias("fundamentals_effective_date"), F.col("fiscal_date_ending").alias("fundamentals_as_of"), *wanted)
    quarters = rel.latest_by(quarters, ["symbol", "fundamentals_effective_date"], [F.desc("fundamentals_as_of")])
    quarters = quarters.withColumn("_known", F.col("fundamentals_effective_date"))
    priced = prices.select("symbol", "trade_date", "close", "adjusted_close").join(companies.select("symbol", "sector", "industry", "shares_outstanding"), "symbol", "left")
    rows = asof_join(priced, quarters, ["symbol"], "trade_date", "_known", ["fundamentals_as_of", "fundamentals_effective_date", *wanted])
    debt_long, debt_short, cash, invested = _zero("long_term_debt", "short_term_debt", "cash_and_equivalents", "short_term_investments")
    rows = rows.withColumn("market_cap", F.col("close") * F.col("shares_outstanding"))
    rows = rows.withColumn("enterprise_value", F.col("market_cap") + debt_long + debt_short - cash - invested)
    over = {"pe_ttm": ("close", "reported_eps_ttm"), "ps_ttm": ("market_cap", "total_revenue_ttm"), "pb": ("market_cap", "total_equity"), "ev_ebitda_ttm": ("enterprise_value", "ebitda_ttm"), "fcf_yield_ttm": ("free_cash_flow_ttm", "market_cap"), "dividend_yield_ttm": ("dividend_payout_ttm", "market_cap")}
    rows = rows.withColumns({n: ratio_if_positive(a, b) for n, (a, b) in over.items()})
    fair = {s: F.when(F.col(c) >= 0, F.col(c) * 100.0 * FAIR_SLOPE + FAIR_BASE) for s, c in (("", "eps_cagr_5y"), ("_3y", "eps_cagr_3y"))}
    rows = rows.withColumns({f"fair_pe{s}": f for s, f in fair.items()})
    rows = rows.withColumns({f"fair_price{s}": F.when(F.col("reported_eps_ttm") > 0, F.col(f"fair_pe{s}") * F.col("reported_eps_ttm")) for s in fair})
    price = F.col("fair_price")
    rows = rows.withColumns({"upside_pct": F.when(F.col("close") > 0, (price - F.col("close")) / F.col("close")), "margin_of_safety_met": F.col("close") <= SAFETY * price})
    dropped = [c for c in wanted if c not in ("reported_eps_ttm", "eps_cagr_5y", "eps_cagr_3y")]
    return rows.drop(*dropped)


def company_enriched(companies: DataFrame, wide: DataFrame, daily: DataFrame) -> DataFrame:
    """Every company with its latest quarter that has a revenue of four quarters, its latest price, returns over 1, 3 and 5 years of rows, and a capitalisation at that price."""
    quarter = rel.latest_by(wide.where("period_type = 'quarterly' and total_revenue_ttm is not null"), ["symbol"], [F.desc("fiscal_date_ending")])
    taken = [f"{c}_ttm" for c in FLOWS if c not in ("operating_income", "capex")] + ["gross_margin", "operating_margin", "net_margin", "fcf_margin", "roe", "roa", "roic", "debt_to_equity", "net_debt", "revenue_growth_yoy", "eps_growth_yoy", "fcf_growth_yoy", "eps_cagr_5y", "eps_cagr_3y"]
    quarter = quarter.select("symbol", F.col("fiscal_date_ending").alias("latest_quarter_end"), *taken)
    back = Window.partitionBy("symbol").orderBy(F.desc("trade_date"))
    ranked = daily.select("symbol", "trade_date", "adjusted_close", F.row_number().over(back).alias("_n"))
    at = {f"_{k}": F.max(F.when(F.col("_n") == n, F.col("adjusted_close"))) for k, n in YEARS_BACK.items()}
    priced = ranked.groupBy("symbol").agg(F.max("trade_date").alias("as_of_date"), F.max(F.when(F.col("_n") == 1, F.col("adjusted_close"))).alias("latest_close"), *[v.alias(k) for k, v in at.items()])
    priced = priced.select("symbol", "as_of_date", "latest_close", *[growth("latest_close", f"_{k}").alias(f"price_return_{k}") for k in YEARS_BACK])
    out = companies.join(quarter, "symbol", "left").join(priced, "symbol", "left")
    return out.withColumn("market_cap_latest", F.col("latest_close") * F.col("shares_outstanding"))


# cross sections -------------------------------------------------------------------------------------


def metric_snapshot(valuation: DataFrame, wide: DataFrame, companies: DataFrame) -> DataFrame:
    """(as_of_date, symbol, sector, industry, metric, value): the 13 metrics on the last valuation day. The fundamental ones are of the
    latest quarter, even where they are null there; nulls and NaN are no values."""
    newest = valuation.agg(F.max("trade_date").alias("trade_date"))  # one row, so the broadcast is of proven size
    v = rel.latest_by(valuation.join(F.broadcast(newest), "trade_date"), ["symbol"], [F.desc("trade_date")])
    f = rel.latest_by(wide.where("period_type = 'quarterly'"), ["symbol"], [F.desc("fiscal_date_ending")])
    long = cs.melt(v, ["symbol"], PRICED_METRICS).unionByName(cs.melt(f, ["symbol"], REPORTED_METRICS))
    groups = companies.select("symbol", "sector", "industry")
    return long.join(groups, "symbol", "left").crossJoin(F.broadcast(newest.withColumnRenamed("trade_date", "as_of_date"))).where("as_of_date is not null")


def sector_aggregates(snapshot: DataFrame) -> DataFrame:
    out = cs.percentiles_by_level(snapshot.drop("symbol"), ["sector", "industry"], {"p25": 0.25, "median": 0.5, "p75": 0.75}, keep=["as_of_date"])
    return out.select("as_of_date", "grouping_level", "group_value", "metric", "n", "mean", "p25", "median", "p75")


def peer_relative(snapshot: DataFrame) -> DataFrame:
    """Percent rank and z-score of each value in its sector and in its industry."""
    out = snapshot
    for level in ("sector", "industry"):
        r = cs.relative_standing(out, level)
        out = r.withColumnsRenamed({"pct_rank": f"{level}_percentile", "z": f"{level}_zscore", "n": f"{level}_n"}).drop("mean", "sd")
    return out


def peer_sets(companies: DataFrame, returns: DataFrame, today: str) -> DataFrame:
    """Up to five peers of each eligible company: listed stocks with a size, a sector and fundamentals. The returns (symbol, trade_date, return_1d) of
    the 564 days up to today are compared on days both have, at least 126 of them."""
    size = F.coalesce("market_cap_latest", "market_cap")
    eligible = companies.where("asset_type = 'Stock' and lower(listing_status) = 'active' and sector is not null and latest_quarter_end is not null").withColumn("_size", size.cast("double")).where("_size > 0")
    recent = returns.where((F.col("trade_date") >= F.date_sub(F.lit(today).cast("date"), LOOKBACK_DAYS)) & F.col("return_1d").isNotNull() & ~F.isnan("return_1d"))
    out = cs.peers(eligible, recent, "symbol", "trade_date", "return_1d", "_size", ("sector", "industry"), PEERS, MAX_LOG_RATIO, LEAST_DAYS, WEIGHTS)
    names = companies.select(F.col("symbol").alias("peer"), F.coalesce(first_truthy("name"), "symbol").alias("peer_name"))
    out = out.join(names, "peer", "left")
    return out.select(F.col("key").alias("symbol"), F.col("rank").cast("long").alias("peer_rank"), F.col("peer").alias("peer_symbol"), "peer_name", F.col("narrow_match").alias("industry_match"), F.col("log_ratio").alias("log_cap_ratio"), F.col("correlation").alias("return_corr_2y"), "score")


def peers_or_fallback(wanted: DataFrame, candidates: DataFrame, sets: DataFrame, override: Sequence[str] = (), most: int = PEERS) -> DataFrame:
    """(symbol, peer_symbol, place, source) for one company (symbol, sector, industry, size): a list given by hand, else its
    stored set, else the candidates of its industry, then its sector, whose size is nearest."""
    me = wanted.limit(1)
    by_hand = [s.upper() for s in override][:most]
    if by_hand:
        rows = F.posexplode(F.array(*[F.lit(s) for s in by_hand])).alias("_at", "peer_symbol")
        return me.select("symbol", rows).select("symbol", "peer_symbol", (F.col("_at") + 1).cast("long").alias("place"), F.lit("by hand").alias("source"))
    mine = F.broadcast(me)  # one row
    stored = sets.join(mine.select("symbol"), "symbol").where(F.col("peer_rank") <= most).select("symbol", "peer_symbol", F.col("peer_rank").cast("long").alias("place"), F.lit("stored").alias("source"))
    alone = me.join(sets.select("symbol").distinct(), "symbol", "left_anti")
    own = alone.select("symbol", F.col("sector").alias("_sector"), F.col("industry").alias("_industry"), F.col("size").alias("_size"))
    same = F.coalesce(F.col("industry") == F.col("_industry"), F.lit(False))
    near = candidates.select(F.col("symbol").alias("peer_symbol"), "sector", "industry", "size").crossJoin(F.broadcast(own)).where(F.col("peer_symbol") != F.col("symbol"))
    near = near.withColumns({"_same": same, "_far": F.round(F.abs(F.log10(F.col("size") / F.col("_size"))), 9)}).where((F.col("_far") <= MAX_LOG_RATIO) & (F.col("_same") | (F.col("sector") == F.col("_sector"))))
    top = near.orderBy(F.desc("_same"), "_far", "peer_symbol").limit(most)
    place = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("_same"), "_far", "peer_symbol")).cast("long")
    return stored.unionByName(top.select("symbol", "peer_symbol", place.alias("place"), F.lit("inline").alias("source")))


# texts ----------------------------------------------------------------------------------------------


def news_sentiment_daily(articles: DataFrame, tickers: DataFrame) -> DataFrame:
    """Per ticker and day: articles, plain and relevance-weighted means, and how many are bullish and bearish. An article without a time, or a mention
    without a ticker, counts nowhere; a null score counts as an article and its relevance as weight."""
    met = tickers.where("ticker is not null").join(articles.where("time_published is not null").select("url", F.to_date("time_published").alias("sentiment_date")), "url")
    label = F.col("label")
    return met.groupBy(F.col("ticker").alias("symbol"), "sentiment_date").agg(
        F.count(F.lit(1)).alias("article_count"), F.avg("score").alias("avg_sentiment_score"), weighted_mean(F.col("score"), F.col("relevance")).alias("weighted_avg_sentiment"),
        F.count_if(label.isin("Bullish", "Somewhat-Bullish")).alias("bullish_count"), F.count_if(label.isin("Bearish", "Somewhat-Bearish")).alias("bearish_count"),
    )


def transcript_sentiment(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """Per call (symbol, quarter): turns and mean sentiments by role, plain and by length, their spread, beside the call's date and participants. Only scored turns count."""
    title = F.col("title")
    role = F.when(title.isNull(), "unknown").when(title.ilike("%operator%"), "operator").when(title.ilike("%analyst%"), "analyst").otherwise("management")
    scored = turns.where("sentiment is not null").select("symbol", "quarter", role.alias("role"), F.coalesce(title, F.lit("")).rlike(CHIEFS).alias("chief"), "sentiment", F.length(F.coalesce("content", F.lit(""))).alias("size"))
    def of(who: str, x: Column) -> Column:
        return F.when(F.col("role") == who, x)
    s, n = F.col("sentiment"), F.col("size")
    management, analyst = F.avg(of("management", s)), F.avg(of("analyst", s))
    out = scored.groupBy("symbol", "quarter").agg(
        F.count(F.lit(1)).alias("scored_turns"), F.count_if(F.col("role") == "management").alias("mgmt_turns"), F.count_if(F.col("role") == "analyst").alias("analyst_turns"),
        F.avg(F.when(F.col("role").isin("management", "analyst"), s)).alias("overall_avg_sentiment"), management.alias("mgmt_avg_sentiment"), analyst.alias("analyst_avg_sentiment"), F.avg(F.when(F.col("chief"), s)).alias("ceo_cfo_avg_sentiment"),
        weighted_mean(of("management", s), of("management", n)).alias("mgmt_wtd_sentiment"), weighted_mean(of("analyst", s), of("analyst", n)).alias("analyst_wtd_sentiment"), (management - analyst).alias("mgmt_analyst_spread"),
    )
    return out.join(calls.select("symbol", "quarter", "call_date", "participant_count"), ["symbol", "quarter"], "left")
