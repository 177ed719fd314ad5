"""Raw JSON documents as tables, one declaration per kind of document.

A document comes from <kind>/<symbol>/<date>.json (or <symbol>/<quarter>.json) or from a
table with a body column. Bodies that are null, blank or no JSON give no rows. Every
value is text first and then cast by its kind; what can't be cast is null.
Alternate keys of a value are tried in order, skipping blanks and null tokens.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import clean
from marlstone.operators.relational import latest_by

KINDS = {
    "text": clean.token,
    "double": clean.to_double,
    "long": clean.to_long,
    "whole": clean.to_long_strict,
    "date": clean.to_date,
    "time": clean.compact_timestamp,
    "raw": lambda c: c,
}


@dataclass(frozen=True)
class Value:
    """A column, its kind and the key or keys it comes from ('' for a raw sub-document)."""

    column: str
    kind: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Rows:
    """A table in a document: the array (or arrays, each with a tag) its rows come from; none for one row per document."""

    table: str
    values: tuple[Value, ...]
    arrays: tuple[tuple[str, str], ...] = ()
    tag: str | None = None
    place: str | None = None
    required: tuple[str, ...] = ()
    keys: tuple[str, ...] = field(default=("symbol",))


def values(kind: str, **columns: str) -> tuple[Value, ...]:
    return tuple(Value(c, kind, tuple(k.split("|"))) for c, k in columns.items())


_REPORT = (("annualReports", "annual"), ("quarterlyReports", "quarterly"))
_PERIOD = ("symbol", "fiscal_date_ending", "period_type")

# The keys of each kind of document.
SPECS: dict[str, tuple[Rows, ...]] = {
    "income_statement": (
        Rows(
            "fact_income_statement",
            values("date", fiscal_date_ending="fiscalDateEnding") + values("text", reported_currency="reportedCurrency")
            + values("long", total_revenue="totalRevenue", cost_of_revenue="costOfRevenue", gross_profit="grossProfit", operating_expenses="operatingExpenses", operating_income="operatingIncome", ebit="ebit", ebitda="ebitda",
                     depreciation_amortization="depreciationAndAmortization", income_before_tax="incomeBeforeTax", income_tax_expense="incomeTaxExpense", net_income="netIncome", net_income_continuing="netIncomeFromContinuingOperations",
                     research_development="researchAndDevelopment", sga="sellingGeneralAndAdministrative", interest_expense="interestExpense"),
            _REPORT, "period_type", None, ("fiscal_date_ending",), _PERIOD,
        ),
    ),
    "balance_sheet": (
        Rows(
            "fact_balance_sheet",
            values("date", fiscal_date_ending="fiscalDateEnding") + values("text", reported_currency="reportedCurrency")
            + values("long", total_assets="totalAssets", total_liabilities="totalLiabilities", total_equity="totalShareholderEquity", cash="cashAndCashEquivalentsAtCarryingValue", short_term_investments="shortTermInvestments",
                     current_assets="totalCurrentAssets", current_liabilities="totalCurrentLiabilities", long_term_debt="longTermDebt", short_term_debt="shortTermDebt", retained_earnings="retainedEarnings", goodwill="goodwill", intangible_assets="intangibleAssets"),
            _REPORT, "period_type", None, ("fiscal_date_ending",), _PERIOD,
        ),
    ),
    "cash_flow": (
        Rows(
            "fact_cash_flow",
            values("date", fiscal_date_ending="fiscalDateEnding") + values("text", reported_currency="reportedCurrency")
            + values("long", operating_cashflow="operatingCashflow", capital_expenditures="capitalExpenditures", dividend_payout="dividendPayout", buybacks="paymentsForRepurchaseOfCommonStock",
                     debt_issued="proceedsFromIssuanceOfLongTermDebtAndCapitalSecuritiesNet", debt_repaid="proceedsFromRepaymentsOfShortTermDebt", investing="cashflowFromInvestment", financing="cashflowFromFinancing", change_in_cash="changeInCashAndCashEquivalents"),
            _REPORT, "period_type", None, ("fiscal_date_ending",), _PERIOD,
        ),
    ),
    "earnings": (
        Rows(
            "fact_earnings",
            values("date", fiscal_date_ending="fiscalDateEnding", report_date="reportedDate") + values("double", reported_eps="reportedEPS", estimated_eps="estimatedEPS", surprise="surprise", surprise_pct="surprisePercentage"),
            (("annualEarnings", "annual"), ("quarterlyEarnings", "quarterly")), "period_type", None, ("fiscal_date_ending",), _PERIOD,
        ),
    ),
    "company_overview": (
        Rows(
            "dim_company",
            values("text", name="Name", exchange="Exchange", asset_type="AssetType", cik="CIK", sector="Sector", industry="Industry", country="Country", currency="Currency", fiscal_year_end="FiscalYearEnd")
            + values("long", market_cap="MarketCapitalization", shares_outstanding="SharesOutstanding"),
        ),
    ),
    "shares_outstanding": (Rows("shares_history", values("date", as_of_date="date") + values("long", shares_outstanding="shares_outstanding_basic"), (("data", ""),), None, "place", ("as_of_date",), ("symbol", "as_of_date")),),
    "dividends": (Rows("fact_dividends", values("date", ex_date="ex_dividend_date", declaration_date="declaration_date", record_date="record_date", payment_date="payment_date") + values("double", amount="amount"), (("data", ""),), None, None, ("ex_date",), ("symbol", "ex_date")),),
    "splits": (Rows("fact_splits", values("date", effective_date="effective_date") + values("double", split_ratio="split_factor"), (("data", ""),), None, None, ("effective_date",), ("symbol", "effective_date")),),
    "earnings_transcript": (Rows("fact_transcript_turns", values("text", speaker="speaker", title="title", content="content") + values("double", sentiment="sentiment"), (("transcript", ""),), None, "turn_idx", (), ("symbol", "stamp", "turn_idx")),),
    "insider_transactions": (
        Rows(
            "fact_insider_transactions",
            values("date", transaction_date="transaction_date") + values("text", executive="executive", executive_title="executive_title", security_type="security_type", acquisition_or_disposal="acquisition_or_disposal") + values("double", shares="shares", share_price="share_price"),
            (("data", ""),), None, None, ("transaction_date",), ("symbol", "transaction_date", "executive", "shares", "share_price", "acquisition_or_disposal"),
        ),
    ),
    "etf_profile": (
        Rows("dim_etf_profile", values("double", net_assets="net_assets", net_expense_ratio="net_expense_ratio", portfolio_turnover="portfolio_turnover", dividend_yield="dividend_yield") + values("date", inception_date="inception_date") + values("text", leveraged="leveraged")),
        Rows("fact_etf_holdings", values("text", holding_symbol="symbol", description="description") + values("double", weight="weight"), (("holdings", ""),), None, None, ("holding_symbol",), ("symbol", "holding_symbol")),
        Rows("fact_etf_sector_allocation", values("text", sector="sector") + values("double", weight="weight"), (("sectors", ""),), None, None, ("sector",), ("symbol", "sector")),
    ),
    "index_data": (Rows("fact_index_prices", values("date", trade_date="date") + values("double", open="open", high="high", low="low", close="close"), (("data", ""),), None, None, ("trade_date",), ("symbol", "trade_date")),),
    "news_sentiment": (
        Rows(
            "fact_news_articles",
            values("text", url="url", title="title", summary="summary", source="source", source_domain="source_domain", category="category_within_source", label="overall_sentiment_label") + values("time", time_published="time_published") + values("double", score="overall_sentiment_score")
            + values("raw", authors="authors", topics="topics"),
            (("feed", ""),), None, None, ("url",), ("url",),
        ),
    ),
}

TICKERS = "ticker_sentiment"


def read_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """file_path, symbol, stamp (the date or quarter in the name), pull_date, body: one row per file."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(list(paths)).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body"))
    return with_names(raw)


def with_names(files: DataFrame) -> DataFrame:
    stamp = F.regexp_extract("file_path", r"/([^/]+)/([^/]+)\.[^./]+$", 2)
    return files.withColumns({"symbol": F.regexp_extract("file_path", r"/([^/]+)/([^/]+)\.[^./]+$", 1), "stamp": stamp, "pull_date": stamp.try_cast("date")})


def latest_documents(files: DataFrame) -> DataFrame:
    """The last file of each symbol, by name."""
    return latest_by(files, ["symbol"], [F.desc("stamp"), F.desc("file_path")])


def latest_of_all(files: DataFrame) -> DataFrame:
    """The files of the last stamp that any symbol has."""
    top = files.agg(F.max("stamp").alias("stamp"))  # one row
    return files.join(F.broadcast(top), "stamp", "left_semi")


def _get(record: Column, v: Value) -> Column:
    cast = KINDS[v.kind]
    return F.coalesce(*[cast(record.getField(k)) for k in v.keys]).alias(v.column)


def _record(vs: Sequence[Value]) -> str:
    names = dict.fromkeys(k for v in vs for k in v.keys)
    return "struct<" + ", ".join(f"`{k}`: string" for k in names) + ">"


def parse(files: DataFrame, spec: Rows, keep: Sequence[str] = ("symbol", "pull_date")) -> DataFrame:
    """The rows of one table of a kind; files needs the kept columns and body."""
    record = _record(spec.values)
    if not spec.arrays:
        doc = F.from_json("body", record)
        out = files.select(*keep, doc.alias("_r")).where("_r is not null")
        # a document without any of the keys is no row
        out = out.select(*keep, *[_get(F.col("_r"), v) for v in spec.values])
        return out.where(F.coalesce(*[F.col(v.column).cast("string") for v in spec.values]).isNotNull())
    doc = F.from_json("body", "struct<" + ", ".join(f"`{a}`: array<{record}>" for a, _ in spec.arrays) + ">")
    parts = []
    read = files.select(*keep, doc.alias("_d"))
    for array, tag in spec.arrays:
        part = read.select(*keep, F.posexplode(F.col("_d").getField(array)).alias("_at", "_r"))
        extra = ([F.lit(tag).alias(spec.tag)] if spec.tag else []) + ([F.col("_at").alias(spec.place)] if spec.place else [])
        parts.append(part.select(*keep, *extra, *[_get(F.col("_r"), v) for v in spec.values]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    for c in spec.required:
        out = out.where(F.col(c).isNotNull())
    return out


def first_listed(rows: DataFrame, keys: Sequence[str], place: str = "place") -> DataFrame:
    """The row that comes first in its list; of lists that run newest first, the latest."""
    return latest_by(rows, keys, [F.asc(place)])


def news_tickers(files: DataFrame) -> DataFrame:
    """url, ticker, relevance, score, label: the second level of a feed; each (url, ticker) once, the latest pull's."""
    inner = f"struct<url: string, `{TICKERS}`: array<struct<ticker: string, relevance_score: string, ticker_sentiment_score: string, ticker_sentiment_label: string>>>"
    feed = files.select("pull_date", F.explode(F.from_json("body", f"struct<feed: array<{inner}>>")["feed"]).alias("a"))
    rows = feed.select("pull_date", F.col("a.url").alias("url"), F.explode(f"a.{TICKERS}").alias("t")).select(
        "pull_date", clean.token("url").alias("url"), clean.token("t.ticker").alias("ticker"), clean.to_double("t.relevance_score").alias("relevance"), clean.to_double("t.ticker_sentiment_score").alias("score"), clean.token("t.ticker_sentiment_label").alias("label")
    )
    return latest_by(rows.where("url is not null and ticker is not null"), ["url", "ticker"], [F.desc("pull_date"), F.desc("relevance"), F.desc("score")])


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV with a header, all columns text, names trimmed; several files are one table by name."""
    out = None
    for p in paths:
        df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(p)
        df = df.toDF(*[c.strip() for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def active_symbols(config: DataFrame) -> DataFrame:
    return config.where(F.lower(F.trim("active")) == "true").select(F.upper(F.trim("symbol")).alias("symbol")).where("symbol != ''").distinct()


def listing(active: DataFrame, delisted: DataFrame) -> DataFrame:
    """One row per symbol of both lists; an active entry precedes a delisted one."""
    both = active.unionByName(delisted, allowMissingColumns=True).select(
        clean.token("symbol").alias("symbol"), clean.token("name").alias("name"), clean.token("exchange").alias("exchange"), clean.token("assetType").alias("asset_type"), clean.to_date("ipoDate").alias("ipo_date"), clean.to_date("delistingDate").alias("delisted_date"), F.lower(clean.token("status")).alias("listing_status")
    ).where("symbol is not null")
    return latest_by(both, ["symbol"], [F.asc_nulls_last("listing_status"), F.desc_nulls_last("ipo_date")])


def earnings_calendar(csv: DataFrame, pull_date: str) -> DataFrame:
    return csv.select(
        clean.token("symbol").alias("symbol"), clean.token("name").alias("name"), clean.to_date("reportDate").alias("report_date"), clean.to_date("fiscalDateEnding").alias("fiscal_date_ending"), clean.to_double("estimate").alias("estimate"), clean.token("currency").alias("currency"), F.to_date(F.lit(pull_date)).alias("pull_date")
    ).where("symbol is not null and fiscal_date_ending is not null")


def with_quarter_dates(turns: DataFrame, earnings: DataFrame) -> DataFrame:
    """Transcript rows (stamp is a quarter such as 2024Q1) with the report_date of that quarter, the last one known."""
    known = latest_by(earnings.where("fiscal_date_ending is not null").select("symbol", clean.quarter_label("fiscal_date_ending").alias("stamp"), "report_date", "pull_date"), ["symbol", "stamp"], [F.desc_nulls_last("pull_date"), F.desc_nulls_last("report_date")]).drop("pull_date")
    return turns.join(known, ["symbol", "stamp"], "left")
