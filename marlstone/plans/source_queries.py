"""Queries over raw documents, views, coverage and fallbacks. The bodies of documents are made from the test tables by
to_json, parsed by the sources' own declarations, and compared with the tables they came from."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.operators import cross_section as cs
from marlstone.operators import relational as rel
from marlstone.operators import series as ts
from marlstone.plans import composites as cp
from marlstone.plans.registry import Registry
from marlstone.plans.series_queries import BENCHMARK, DP
from marlstone.plans.table_queries import DIM, companies, coverage_audit
from marlstone.plans.table_queries import query as tables
from marlstone.quality import checks
from marlstone.session import fresh_path
from marlstone.sources import documents as docs
from marlstone.sources import storage
from marlstone.sources.tables import register_views, table

query = Registry()

# raw documents --------------------------------------------------------------------------------------



def _pulled():
    return F.lit("2024-07-01").cast("date").alias("pull_date")


_REPORT = {"fiscalDateEnding": "fiscal_date_ending", "reportedCurrency": "reported_currency", "totalRevenue": "total_revenue", "grossProfit": "gross_profit", "operatingIncome": "operating_income", "netIncome": "net_income"}


@query("select symbol, fiscal_date_ending, period_type, reported_currency, total_revenue, gross_profit, operating_income, net_income from fact_fundamentals_wide where fiscal_date_ending is not null and period_type in ('annual', 'quarterly') and symbol is not null")
def silver_reports(spark, d):
    """Two arrays of one document, each with its tag."""
    report = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(k) for k, c in _REPORT.items()])
    def of(kind: str, name: str):
        return F.collect_list(F.when(F.col("period_type") == kind, report)).alias(name)
    bodies = table(spark, d, "fact_fundamentals_wide").where("symbol is not null").groupBy("symbol").agg(of("annual", "annualReports"), of("quarterly", "quarterlyReports"))
    files = bodies.select("symbol", _pulled(), F.to_json(F.struct("annualReports", "quarterlyReports")).alias("body"))
    return docs.parse(files, docs.SPECS["income_statement"][0]).select("symbol", "fiscal_date_ending", "period_type", *[c for k, c in _REPORT.items() if k != "fiscalDateEnding"])


@query(
    f"""select doc_id::varchar as url, t as ticker, (n_chars % 200 - 100)::double as score, case when doc_id % 7 <> 0 then (doc_id % 5)::double end as relevance
from (select distinct doc_id, n_chars, unnest([symbol, '{BENCHMARK}']) t from documents) where t is not null and upper(trim(t)) not in ('', 'NONE', 'NULL')"""
)
def silver_news(spark, d):
    """The second level of an array within an array; a ticker named twice in an article counts once."""
    mention = F.transform(F.array("symbol", F.lit(BENCHMARK)), lambda t: F.struct(t.alias("ticker"), (F.col("n_chars") % 200 - 100).cast("string").alias("ticker_sentiment_score"), F.when(F.col("doc_id") % 7 != 0, (F.col("doc_id") % 5).cast("string")).alias("relevance_score")))
    article = F.struct(F.col("doc_id").cast("string").alias("url"), mention.alias("ticker_sentiment"))
    files = table(spark, d, "documents").select(_pulled(), F.to_json(F.struct(F.array(article).alias("feed"))).alias("body"))
    return docs.news_tickers(files).select("url", "ticker", "score", "relevance")


@query(
    """with u as (select universe, upper(trim(symbol)) s, trim(sector) sector, market_cap from dim_company where universe is not null and snapshot_date = (select max(snapshot_date) from dim_company)),
 h as (select universe, s, max(market_cap)::double w from u where s is not null and s not in ('', 'NONE', 'NULL') group by 1, 2), g as (select universe, sector, count(*)::double n from u where sector is not null and upper(sector) not in ('', 'NONE', 'NULL') group by 1, 2)
select universe as symbol, 'profile' as part, null as name, count(*)::double as amount from u group by 1 union all select universe, 'holding', s, w from h union all select universe, 'sector', sector, n from g"""
)
def silver_funds(spark, d):
    """Three tables out of one document: its own values and two arrays side by side."""
    dim = table(spark, d, "dim_company").where("universe is not null")
    last = dim.join(F.broadcast(table(spark, d, "dim_company").agg(F.max("snapshot_date").alias("snapshot_date"))), "snapshot_date")
    held = last.groupBy("universe", F.upper(F.trim("symbol")).alias("s")).agg(F.max("market_cap").alias("w"))
    held = held.groupBy("universe").agg(F.collect_list(F.struct(F.col("s").alias("symbol"), F.col("w").cast("string").alias("weight"))).alias("holdings"))
    sectors = last.groupBy("universe", F.trim("sector").alias("sector")).agg(F.count(F.lit(1)).alias("w"))
    sectors = sectors.groupBy("universe").agg(F.collect_list(F.struct("sector", F.col("w").cast("string").alias("weight"))).alias("sectors"))
    whole = last.groupBy("universe").agg(F.count(F.lit(1)).cast("string").alias("net_assets")).join(held, "universe").join(sectors, "universe")
    files = whole.select(F.col("universe").alias("symbol"), _pulled(), F.to_json(F.struct("net_assets", "holdings", "sectors")).alias("body"))
    own, holdings, groups = (docs.parse(files, spec) for spec in docs.SPECS["etf_profile"])
    return own.select("symbol", F.lit("profile").alias("part"), F.lit(None).cast("string").alias("name"), F.col("net_assets").alias("amount")).unionByName(
        holdings.select("symbol", F.lit("holding").alias("part"), F.col("holding_symbol").alias("name"), F.col("weight").alias("amount"))
    ).unionByName(groups.select("symbol", F.lit("sector").alias("part"), F.col("sector").alias("name"), F.col("weight").alias("amount")))


@query(
    """with s as (select symbol, as_of_date, shares_outstanding, pull_date from shares_history where symbol is not null and as_of_date is not null)
select symbol, count(*) as listed, max(as_of_date) as latest_date from s group by 1"""
)
def silver_shares(spark, d):
    """A list that comes newest first: its first element is the latest; counted beside it."""
    item = F.struct(F.col("as_of_date").cast("string").alias("date"), F.col("shares_outstanding").cast("string").alias("shares_outstanding_basic"))
    listed = table(spark, d, "shares_history").where("symbol is not null").groupBy("symbol").agg(F.sort_array(F.collect_list(item), asc=False).alias("data"))
    rows = docs.parse(listed.select("symbol", _pulled(), F.to_json(F.struct("data")).alias("body")), docs.SPECS["shares_outstanding"][0])
    first = docs.first_listed(rows, ["symbol"])
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("listed")).join(first.select("symbol", F.col("as_of_date").alias("latest_date")), "symbol")


_LABEL = "year({0}) || 'Q' || quarter({0})"


@query(
    f"""with t as (select doc_id, symbol, {_LABEL.format('published_at')} stamp from documents where symbol is not null and published_at is not null),
 k as (select symbol, {_LABEL.format('fiscal_date_ending')} stamp, report_date from fact_earnings where fiscal_date_ending is not null and period_type = 'quarterly'
   qualify row_number() over (partition by symbol, stamp order by pull_date desc nulls last, report_date desc nulls last) = 1)
select t.doc_id, t.symbol, t.stamp, k.report_date from t left join k using (symbol, stamp)"""
)
def transcript_dates(spark, d):
    turns = table(spark, d, "documents").where("symbol is not null and published_at is not null").select("doc_id", "symbol", clean.quarter_label("published_at").alias("stamp"))
    return docs.with_quarter_dates(turns, table(spark, d, "fact_earnings").where("period_type = 'quarterly'")).select("doc_id", "symbol", "stamp", "report_date")


# views, lists, coverage -----------------------------------------------------------------------------

_VIEW_SQL = "select e.symbol, count(*) as periods, max(v.trade_date) as last_day from fact_earnings e join (select symbol, max(trade_date) as trade_date from fact_valuation_daily group by symbol) v on v.symbol = e.symbol where e.period_type = 'quarterly' group by e.symbol"


@query(_VIEW_SQL)
def sql_over_views(spark, d):
    """Frames as relations of a SQL text."""
    register_views(spark, d, ["fact_earnings", "fact_valuation_daily"])
    return spark.sql(_VIEW_SQL)


LISTED = ("IDXBM", "QOGFV", "ZDOCU-B")


@query(f"select symbol, trade_date, pull_date, close from fact_prices_enriched where symbol in ({', '.join(repr(s) for s in LISTED)})")
def validated_in_list(spark, d):
    p = table(spark, d, "fact_prices_enriched")
    return p.where(F.col("symbol").isin(clean.symbol_list(LISTED))).select("symbol", "trade_date", "pull_date", "close")


@query(
    f"""with {DIM}, p as (select symbol, min(trade_date) first_date from fact_daily_prices where trade_date is not null group by 1)
select p.symbol, first_date, ipo_date, first_date <= date '2023-06-05' or coalesce(first_date <= ipo_date, false) as skip from p left join dim on dim.key = p.symbol where p.symbol is not null"""
)
def deep_history_skip(spark, d):
    """Series that already reach back far enough, or to the listing, need no full load."""
    first = table(spark, d, "fact_daily_prices").where("trade_date is not null and symbol is not null").groupBy("symbol").agg(F.min("trade_date").alias("first_date"))
    listed = companies(spark, d).select(F.col("key").alias("symbol"), "ipo_date")
    return rel.deep_enough(first, listed, "symbol", "first_date", "ipo_date", "2023-06-05")


@query("select snapshot_date, count(*) as rows, count(*) filter (upper(trim(sector)) not in ('', 'NONE', 'NULL')) as named, round(100.0 * count(*) filter (upper(trim(sector)) not in ('', 'NONE', 'NULL')) / count(*), 4)::double as percent from dim_company where snapshot_date = (select max(snapshot_date) from dim_company) group by 1")
def sector_coverage_latest(spark, d):
    return checks.latest_group_coverage(table(spark, d, "dim_company"), "snapshot_date", "sector")


@query(
    "with a as (" + tables.sql["coverage_audit"] + """), r as (select *, row_number() over (order by symbol) n, row_number() over (order by start_gap desc nulls last, symbol) late from a)
select symbol, start_gap, cause, late from r where late <= 4 or (wanted_from >= date '2023-09-01' and n % 13 = 0) or (first_date is null and n % 7 = 0) or (missing and n % 5 = 0) order by late limit 10"""
)
def coverage_spot_sample(spark, d):
    """Ten audit rows to look at: the worst, and every so manieth of three kinds. Ranks are over one row per company."""
    late = Window.orderBy(F.desc_nulls_last("start_gap"), "symbol")
    a = coverage_audit(spark, d).withColumns({"n": F.row_number().over(Window.orderBy("symbol")), "late": F.row_number().over(late).cast("long")})
    every = lambda k: F.col("n") % k == 0
    chosen = (F.col("late") <= 4) | ((F.col("wanted_from") >= F.lit("2023-09-01").cast("date")) & every(13)) | (F.col("first_date").isNull() & every(7)) | (F.col("missing") & every(5))
    return a.where(chosen).orderBy("late").limit(10).select("symbol", "start_gap", "cause", "late")


@query(
    f"""with {DIM}, m as (select key symbol, trim(sector) sector, trim(industry) industry, market_cap::double cap from dim where asset_type = 'Stock' and lower(trim(listing_status)) = 'active' and market_cap > 0),
 me as (select * from m where sector is not null order by symbol limit 1),
 c as (select o.symbol, coalesce(o.industry = me.industry, false) industry_match, log10(o.cap / me.cap) lr from m o, me where o.symbol <> me.symbol and (o.industry = me.industry or o.sector = me.sector) and abs(log10(o.cap / me.cap)) <= 2)
select (select symbol from me) as symbol, symbol as peer_symbol, row_number() over (order by industry_match desc, round(abs(lr), 9), symbol) as place, 'inline' as source from c qualify place <= 5"""
)
def peer_fallback(spark, d):
    """The peers of the first company, whose set is missing: those of like size in its industry, then its sector."""
    m = companies(spark, d).where("asset_type = 'Stock' and lower(trim(listing_status)) = 'active' and market_cap > 0").select(F.col("key").alias("symbol"), F.trim("sector").alias("sector"), F.trim("industry").alias("industry"), F.col("market_cap").cast("double").alias("size"))
    first = m.where("sector is not null").orderBy("symbol").limit(1)
    none = spark.createDataFrame([], "symbol string, peer_symbol string, peer_rank long")
    return cp.peers_or_fallback(first, m, none)


# sinks ----------------------------------------------------------------------------------------------

_DAY_KEYS = ["symbol", "trade_date"]


def _rows(spark, d):
    return table(spark, d, "fact_daily_prices").where("symbol is not null and trade_date is not null").select("row_id", "symbol", "trade_date", "pull_date", F.year("trade_date").alias("year"))


def _order():
    return [F.desc("pull_date"), F.desc("row_id")]


_LAST_ROWS = f"with {DP} select row_id, symbol, trade_date, pull_date, year(trade_date)::int as year from dp"


@query(_LAST_ROWS)
def sink_upsert(spark, d):
    """A table written once, then met by a second batch, given twice."""
    path, rows = fresh_path(spark, "sink"), _rows(spark, d)
    rel.upsert_parquet(rows.where("row_id % 2 = 0"), path, _DAY_KEYS, _order())
    for _ in range(2):
        rel.upsert_parquet(rows.where("row_id % 2 = 1"), path, _DAY_KEYS, _order())
    return spark.read.schema(rows.schema).parquet(path)


@query(_LAST_ROWS)
def sink_upsert_partitions(spark, d):
    """The same by year, where only the years of the second batch are read and rewritten."""
    path, rows = fresh_path(spark, "sink"), _rows(spark, d)
    rel.overwrite_partitions(rel.upsert(None, rows.where("row_id % 3 > 0"), _DAY_KEYS, _order()), path, "year")
    rel.upsert_partitions(rows.where("row_id % 3 = 0"), path, _DAY_KEYS, _order(), "year")
    return spark.read.schema(rows.schema).parquet(path)


@query(f"{_LAST_ROWS} union all select row_id, symbol, trade_date, pull_date, 1999 from dp where year(trade_date) = 2024")
def sink_overwrite(spark, d):
    """A whole table replaced by year folders, of which one is then replaced and one added."""
    path, rows = fresh_path(spark, "sink"), rel.upsert(None, _rows(spark, d), _DAY_KEYS, _order())
    rel.overwrite(rows.withColumn("row_id", F.lit(0).cast("long")), path, "year")
    rel.overwrite(rows.where("year != 2024").unionByName(rows.where("year = 2024").limit(1)), path, "year")
    late = rows.where("year = 2024")
    rel.overwrite_partitions(late.unionByName(late.withColumn("year", F.lit(1999))), path, "year")
    return spark.read.schema(rows.schema).parquet(path)


@query(_LAST_ROWS)
def sink_dedup_rewrite(spark, d):
    path, rows = fresh_path(spark, "sink"), _rows(spark, d)
    rows.write.parquet(path)
    before, after = rel.dedup_rewrite(spark, path, _DAY_KEYS, _order())
    if rel.dedup_rewrite(spark, path, _DAY_KEYS, _order()) != (after, after) or before < after:
        raise AssertionError("a second rewrite changed the table")
    return spark.read.schema(rows.schema).parquet(path)


@query("select distinct upper(trim(symbol)) as symbol from dim_company where lower(trim(listing_status)) = 'active' and trim(symbol) <> ''")
def sink_csv(spark, d):
    """Two CSV folders with different columns, read back as one table of text; the active symbols of it."""
    paths, rows = [fresh_path(spark, "csv") for _ in range(2)], table(spark, d, "dim_company").select("symbol", F.trim("name").alias("name"), (F.lower(F.trim("listing_status")) == "active").cast("string").alias("active"), F.pmod("load_id", F.lit(2)).alias("side"))
    storage.write_csv(rows.where("side = 0").select("symbol", "name", "active"), paths[0])
    storage.write_csv(rows.where("side = 1").select("active", "symbol"), paths[1])
    return docs.active_symbols(docs.read_csv(spark, *paths))


# classification -------------------------------------------------------------------------------------


@query(
    f"""with {DIM}, p as (select distinct upper(trim(symbol)) symbol from fact_daily_prices where symbol is not null)
select p.symbol, case when dim.key is null then 'not_in_listing' when coalesce(asset_type, '') <> 'Stock' then 'non_stock' when lower(trim(listing_status)) = 'delisted' then 'delisted' else 'keep' end as verdict from p left join dim on dim.key = p.symbol"""
)
def reconcile_universe(spark, d):
    held = table(spark, d, "fact_daily_prices").where("symbol is not null").select(F.upper(F.trim("symbol")).alias("symbol")).distinct()
    listed = companies(spark, d).select(F.col("key").alias("symbol"), "asset_type", "listing_status", F.lit(True).alias("known"))
    verdict = F.when(F.col("known").isNull(), "not_in_listing").when(F.coalesce("asset_type", F.lit("")) != "Stock", "non_stock").when(F.lower(F.trim("listing_status")) == "delisted", "delisted").otherwise("keep")
    return held.join(listed, "symbol", "left").select("symbol", verdict.alias("verdict"))


_BALANCE_SQL = "select symbol, fiscal_date_ending, period_type, pull_date, gold_built_utc, total_revenue, free_cash_flow, operating_cashflow - free_cash_flow as capex, total_assets - total_equity as current_liabilities, floor(total_assets / 3.0) as current_assets, case when month(fiscal_date_ending) <> 3 then floor(total_assets / 10.0) end as cash_and_equivalents, case when month(fiscal_date_ending) = 6 then floor(total_assets / 25.0) end as short_term_investments from {0}"


@query(
    f"""with b as ({_BALANCE_SQL.format('fact_fundamentals_wide')}) select symbol, fiscal_date_ending, period_type, pull_date, gold_built_utc, round(current_assets / nullif(current_liabilities, 0), 6) as current_ratio,
 (coalesce(cash_and_equivalents, short_term_investments) + case when cash_and_equivalents is not null then coalesce(short_term_investments, 0) else 0 end)::double as cash_and_investments, round(abs(capex) * 100.0 / nullif(total_revenue, 0), 6) as capex_pct_of_revenue, round(free_cash_flow * 100.0 / nullif(total_revenue, 0), 6) as fcf_pct_of_revenue from b"""
)
def analyst_ratios(spark, d):
    table(spark, d, "fact_fundamentals_wide").createOrReplaceTempView("_wide_rows")
    b = spark.sql(_BALANCE_SQL.format("_wide_rows"))
    r = cp.analyst_ratios()
    return b.select("symbol", "fiscal_date_ending", "period_type", "pull_date", "gold_built_utc", *[F.round(r[n], 6).alias(n) for n in ("current_ratio", "capex_pct_of_revenue", "fcf_pct_of_revenue")], r["cash_and_investments"].cast("double").alias("cash_and_investments"))


_TITLED = "case l_partkey % 5 when 0 then 'Chief Executive Officer' when 1 then 'Director' when 2 then null when 3 then 'CFO' else 'PACEOX' end"


@query(
    f"""with t as (select l_suppkey k, l_orderkey, l_linenumber, l_partkey who, l_shipdate::date as day, l_extendedprice usd, l_returnflag = 'A' bought, {_TITLED} title from lineitem where l_returnflag <> 'N'),
 q as (select quantile_cont(usd, 0.9) big from t), b as (select distinct k, day, who from t where bought),
 c as (select k, day, count(distinct who) >= 3 cluster from (select x.k, x.day, y.who from (select distinct k, day from b) x join b y on y.k = x.k and y.day between x.day - 30 and x.day) group by 1, 2),
 l as (select t.*, coalesce(cluster, false) cluster, case when bought and regexp_matches(coalesce(title, ''), '\\b(CEO|CFO|chief executive officer|chief financial officer)\\b', 'i') then 'chief buys' when bought and usd >= big then 'large buy' when not bought and usd >= big then 'large sale' end label from t, q left join c on c.k = t.k and c.day = t.day)
select l_orderkey, l_linenumber, k as supplier, day, usd, label || case when bought and cluster then ' + cluster buy' else '' end as label from l where label is not null"""
)
def insider_labels(spark, d):
    """Transactions labelled by title and size, with a mark where three or more bought in the month up to it."""
    t = table(spark, d, "lineitem").where("l_returnflag != 'N'").select(
        F.col("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", F.col("l_partkey").alias("who"), F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("usd"), (F.col("l_returnflag") == "A").alias("bought"), F.expr(_TITLED).alias("executive_title")
    )
    big = cs.exact_quantiles(t.select(F.lit(1).alias("g"), "usd"), ["g"], F.col("usd"), {"big": 0.9}).select("big")
    buyers = t.where("bought").groupBy("k", "day").agg(F.collect_set("who").alias("who"))
    month = F.size(F.array_distinct(F.flatten(F.collect_list("who").over(ts.days_before("k", "day", 31)))))
    marks = buyers.select("k", "day", (month >= 3).alias("cluster"))
    out = t.join(marks, ["k", "day"], "left").crossJoin(F.broadcast(big))  # one row
    out = out.withColumn("label", cp.insider_label(F.col("big"), F.coalesce("cluster", F.lit(False)))).where("label is not null")
    return out.select("l_orderkey", "l_linenumber", F.col("k").alias("supplier"), "day", "usd", "label")


@query(r"with f as (select file_id, file_path, regexp_extract(file_path, '(\d{4}-\d{2}-\d{2})', 1) stamp from bronze_price_files) select file_id, file_path from f where stamp = (select max(stamp) from f)")
def latest_files_of_all(spark, d):
    """The files of the last date that any of them carries."""
    files = table(spark, d, "bronze_price_files").withColumn("stamp", F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2})", 1))
    return docs.latest_of_all(files).select("file_id", "file_path")


@query(
    "with a as (" + tables.sql["coverage_audit"] + """), f as (select upper(trim(symbol)) symbol, count(*) files, max(pull_date) last_pull, sum(size_bytes)::bigint bytes, count(*) filter (body is null or trim(body) = '') empty_files from bronze_price_files group by 1)
select a.symbol, a.cause, coalesce(files, 0) as files, last_pull, coalesce(bytes, 0) as bytes, case when a.cause = 'covered' then 'none' when files is null then 'never pulled' when empty_files = files then 'only empty files' else 'pulled, not held' end as root_cause from a left join f using (symbol)"""
)
def coverage_diagnostics(spark, d):
    """Why a series is short: what was audited, beside the metadata of the raw files."""
    f = table(spark, d, "bronze_price_files").groupBy(F.upper(F.trim("symbol")).alias("symbol")).agg(F.count(F.lit(1)).alias("files"), F.max("pull_date").alias("last_pull"), F.sum("size_bytes").alias("bytes"), F.count_if(F.col("body").isNull() | (F.trim("body") == "")).alias("empty"))
    a = coverage_audit(spark, d).select("symbol", "cause").join(f, "symbol", "left")
    root = F.when(F.col("cause") == "covered", "none").when(F.col("files").isNull(), "never pulled").when(F.col("empty") == F.col("files"), "only empty files").otherwise("pulled, not held")
    zero = F.lit(0).cast("long")
    return a.select("symbol", "cause", F.coalesce("files", zero).alias("files"), "last_pull", F.coalesce("bytes", zero).alias("bytes"), root.alias("root_cause"))


@query(
    """select doc_id, strftime(published_at, '%Y%m%dT%H%M') as compact, date_trunc('minute', published_at) as minute, round(ln(1 + n_chars), 8) as log_size, least(greatest(n_chars, 100), 2000) as clipped,
 case when n_chars >= 1000 then printf('%.1fK', n_chars / 1000.0) else printf('%.1f', n_chars / 1.0) end as short, to_json({'id': doc_id, 'lang': lang}) as packed from documents where n_chars is not null and n_chars % 100 <> 50"""
)
def scalar_formats(spark, d):
    """Compact times written and parsed, logarithm, clipping, short numbers, JSON texts."""
    compact = F.date_format("published_at", "yyyyMMdd'T'HHmm")
    n = F.col("n_chars")
    return table(spark, d, "documents").where("n_chars is not null and n_chars % 100 <> 50").select(
        "doc_id", compact.alias("compact"), clean.compact_timestamp(compact).cast("timestamp_ntz").alias("minute"), F.round(F.log1p(n), 8).alias("log_size"), F.least(F.greatest(n, F.lit(100)), F.lit(2000)).alias("clipped"),
        clean.short_number(n.cast("double")).alias("short"), F.to_json(F.struct(F.col("doc_id").alias("id"), "lang"), {"ignoreNullFields": "false"}).alias("packed"),
    )
