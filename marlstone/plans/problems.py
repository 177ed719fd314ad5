"""The training-data problems that aren't about text: queries p1_ to p3_ and p5_ to p7_ over whole tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import column_profile as cp
from marlstone.operators import compaction, rolling_state, schema_drift, snapshot_diff, valid_time
from marlstone.operators.rolling_state import Measure
from marlstone.plans.holdings import HOLDING_FIELDS
from marlstone.session import materialise, sized, spread
from marlstone.sources.price_files import price_records
from marlstone.sources.tables import table

# 1 ------------------------------------------------------------------------------------------------


def _activity(windows_volume: tuple[int, ...], windows_close: tuple[int, ...], parts: tuple[str, ...]) -> list[Measure]:
    return [
        Measure("volume", F.col("volume"), windows_volume, F.col("volume") > 0, scale=0, parts=parts),
        Measure("adjusted_close", F.col("adjusted_close"), windows_close, F.col("adjusted_close").isNotNull(), parts=parts),
    ]


def _revenue(parts: tuple[str, ...]) -> list[Measure]:
    return [Measure("total_revenue", F.col("total_revenue"), (120,), F.col("total_revenue").isNotNull(), scale=0, parts=parts)]


def _states(spark: SparkSession, d: str, activity: list[Measure]) -> tuple[DataFrame, DataFrame]:
    """Rows pulled later than usual after their date come in as corrections of the state."""
    order = [F.col("pull_date"), F.col("gold_built_utc")]
    def state(rows: DataFrame, day: str, measures: list[Measure], usual: int) -> DataFrame:
        return rolling_state.maintain(rows, "symbol", day, measures, order, F.col("pull_date"), F.datediff("pull_date", day) > usual)
    prices = table(spark, d, "fact_prices_enriched")
    quarters = table(spark, d, "fact_fundamentals_wide").where("period_type = 'quarterly'")
    with ThreadPoolExecutor(2) as pool:  # two independent states: the jobs of one fill the gaps of the other
        daily = pool.submit(state, prices, "trade_date", activity, 7)
        revenue = pool.submit(state, quarters, "fiscal_date_ending", _revenue(activity[0].parts), 75)
        return daily.result(), revenue.result()


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    daily, revenue = _states(spark, d, _activity((7,), (30,), ("use",)))
    idle = F.array_compact(F.array(F.when(F.col("use_volume_7") == 0, "volume"), F.when(F.col("use_adjusted_close_30") == 0, "adjusted_close")))
    by_day = daily.where("live").select(F.col("entity").alias("symbol"), F.col("day").cast("string").alias("day"), F.explode(idle).alias("measure"))
    return by_day.unionByName(
        revenue.where("live and use_total_revenue_120 = 0").select(F.col("entity").alias("symbol"), F.col("day").cast("string").alias("day"), F.lit("total_revenue").alias("measure"))
    )


def p1_rolling_totals(spark: SparkSession, d: str) -> DataFrame:
    daily, revenue = _states(spark, d, _activity((7, 30), (7, 30), ("sum", "n", "use", "over")))
    def rows(name: str, w: int) -> Column:
        total, n = F.when(F.col(f"over_{name}_{w}") == 0, F.col(f"sum_{name}_{w}").cast("double")), F.col(f"n_{name}_{w}")
        return F.struct(F.lit(name).alias("measure"), F.lit(w).alias("days"), total.alias("total"), n.alias("n"), F.try_divide(total, n).alias("average"))
    def long(state: DataFrame, pairs: list[tuple[str, int]]) -> DataFrame:
        return state.where("live").select(F.col("entity").alias("symbol"), F.col("day").cast("string").alias("day"), F.inline(F.array(*[rows(m, w) for m, w in pairs])))
    return long(daily, [(m, w) for m in ("volume", "adjusted_close") for w in (7, 30)]).unionByName(long(revenue, [("total_revenue", 120)]))


# 2 ------------------------------------------------------------------------------------------------


def _known(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    events = table(spark, d, "fact_valuation_daily").select(*columns)
    shares = table(spark, d, "shares_history")
    earnings = table(spark, d, "fact_earnings").where("period_type = 'quarterly' and fiscal_date_ending is not null")
    return valid_time.as_of(
        events,
        "symbol",
        "trade_date",
        {
            "known_shares": valid_time.first_known(shares.where("as_of_date is not null and pull_date is not null"), "symbol", F.greatest("as_of_date", "pull_date"), [F.col("as_of_date"), F.col("pull_date")], [F.col("shares_outstanding").alias("v")]),
            "known_period": valid_time.first_known(earnings, "symbol", F.coalesce(F.col("report_date"), F.date_add("fiscal_date_ending", 60)), [F.col("fiscal_date_ending")], [F.col("fiscal_date_ending").alias("v")]),
        },
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _known(spark, d, ["symbol", "trade_date", "shares_outstanding", "fundamentals_as_of"])
    wrong = F.array_compact(
        F.array(
            F.when(~F.col("shares_outstanding").eqNullSafe(F.col("known_shares.v")), "shares_outstanding"),
            F.when(~F.col("fundamentals_as_of").eqNullSafe(F.col("known_period.v")), "fundamentals_as_of"),
        )
    )
    return rows.select("symbol", F.col("trade_date").cast("string").alias("trade_date"), F.explode(wrong).alias("field")).distinct()


def p2_known_at_event(spark: SparkSession, d: str) -> DataFrame:
    rows = _known(spark, d, ["symbol", "universe", "trade_date"])
    return rows.select("symbol", "universe", F.col("trade_date").cast("string").alias("trade_date"), F.col("known_shares.v").alias("shares_outstanding"), F.col("known_period.v").cast("string").alias("fundamentals_as_of"))


# 3 ------------------------------------------------------------------------------------------------


def _schemas(spark: SparkSession, d: str, keep: list[str]) -> DataFrame:
    return schema_drift.fingerprints(spread(table(spark, d, "bronze_holdings_files").select(*keep, "body")), keep, "body", "$.holdings")


def _registry(schemas: DataFrame) -> DataFrame:
    return materialise(schema_drift.registry(schemas, HOLDING_FIELDS), "registry")


def _drift(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The schemas of all files with records, and the registry of their fingerprints."""
    schemas = materialise(_schemas(spark, d, ["file_id", "symbol", "file_no"]).drop("recs"), "schemas").where(F.size("fields") > 0)
    return schemas, _registry(schemas)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.changes(*_drift(spark, d), "file_id", "symbol", "file_no").select("file_id", "field", "change")


def p3_change_report(spark: SparkSession, d: str) -> DataFrame:
    """Every change with the keys and types on both sides and the schema version it led to."""
    schemas, known = _drift(spark, d)
    found = schema_drift.changes(schemas, known, "file_id", "symbol", "file_no")
    return found.join(schema_drift.versions(schemas, "file_id", "symbol", "file_no").select("file_id", "schema_version"), "file_id")


def p3_holdings(spark: SparkSession, d: str) -> DataFrame:
    """The table of all files, each body parsed once; gaps are filled by the fields' default rules."""
    keep = ["file_id", "symbol", "file_no", "pull_date"]
    names = [f.name for f in HOLDING_FIELDS]
    schemas = materialise(_schemas(spark, d, keep), "records").where(F.size("fields") > 0)
    rows = materialise(schema_drift.route(schemas, _registry(schemas), keep, HOLDING_FIELDS), "holdings")
    per_file = rows.groupBy("file_id").agg(
        F.max("report_date").alias("_date"),
        F.try_divide(F.sum(F.when(F.col("shares_held") > 0, F.col("market_value"))), F.sum(F.when(F.col("market_value").isNotNull() & (F.col("shares_held") > 0), F.col("shares_held")))).alias("_price"),
    )
    # the holder's last known shares come by an equi-join on the file before, never by sorting a holder's history
    order = schema_drift.previous(rows.select("file_id", "symbol", "file_no").distinct(), "symbol", "file_no", ["file_id"]).select("file_id", F.col("prev_file_id").alias("_before"))
    held = rows.where("holder_name is not null and shares_held is not null").groupBy(F.col("file_id").alias("_before"), "holder_name").agg(F.max("shares_held").alias("_held"))
    rows = rows.join(per_file, "file_id").join(order, "file_id")
    gaps = rows.where("shares_held is null").join(held, ["_before", "holder_name"], "left")
    whole = rows.where("shares_held is not null").withColumn("_held", F.lit(None).cast("double"))
    rules = {
        "value_over_price": F.round(F.try_divide("market_value", "_price")), "held_before_plus_change": F.col("_held") + F.coalesce("shares_change", F.lit(0.0)), "held_before": F.col("_held"),
        "change_alone": F.col("shares_change"), "none_held": F.lit(0.0), "rest_of_file": F.col("_date"), "last_quarter_end": F.date_sub(F.trunc("pull_date", "quarter"), 1), "unknown": F.lit("UNKNOWN"),
    }
    return schema_drift.fill(whole.unionByName(gaps.select(*whole.columns)), HOLDING_FIELDS, rules).select("symbol", *names, "pull_date", "file_id")


# 5 ------------------------------------------------------------------------------------------------


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    records = price_records(table(spark, d, "bronze_price_files"))
    # the identity of a record is its eight numbers; the smallest file that holds it stands for it
    once = records.groupBy(*[c for c in records.columns if c != "file_id"]).agg(F.min("file_id").alias("file_id"))
    compacted = compaction.compact(once, by=["symbol", "pull_date"], sort=["symbol", "pull_date", "trade_date"])
    return compacted.select("file_id", "symbol", F.col("trade_date").cast("string").alias("trade_date"))


def p5_daily_prices(spark: SparkSession, d: str) -> DataFrame:
    """fact_daily_prices, compacted by symbol and pull_date: all rows of the published table."""
    prices = table(spark, d, "fact_daily_prices")
    compacted = compaction.compact(prices, by=["symbol", "pull_date"], sort=["symbol", "pull_date"])
    return compacted.select("row_id", "symbol", F.col("trade_date").cast("string").alias("trade_date"), F.col("pull_date").cast("string").alias("pull_date"), "close", "volume")


# 6 ------------------------------------------------------------------------------------------------

# The columns whose changes are reported.
DESCRIPTIVE = ("name", "exchange", "asset_type", "cik", "sector", "industry", "country", "currency", "fiscal_year_end", "listing_status")


def _blank_as_null(c: str) -> Column:
    t = F.upper(F.trim(F.col(c)))
    return F.when(~t.isin("", "NONE", "NULL"), t)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    companies = table(spark, d, "dim_company")
    values = [_blank_as_null(c) for c in DESCRIPTIVE] + [F.col("ipo_date"), F.col("delisted_date")]
    rows = snapshot_diff.normalised(companies, F.col("snapshot_date"), _blank_as_null("symbol"), values, [F.col("last_updated")])
    out = snapshot_diff.diff(snapshot_diff.digest(rows))
    return out.select(F.col("snapshot").cast("string").alias("snapshot_date"), F.col("key").alias("symbol"), "change")


# 7 ------------------------------------------------------------------------------------------------

SYMBOL_SHAPE = "^[A-Z]+(-[A-Z])?$"


def _in_range() -> Column:
    x = F.col("adjusted_close")
    return F.when(~F.isnan(x) & (x > 0) & (x < 100000), x)


def _price_checks(distinct: bool) -> list[cp.Check]:
    x, t = F.col("adjusted_close"), F.col("trade_date")
    return [
        cp.Check("adjusted_close", x, number=_in_range(), violations={"range": x.isNotNull() & _in_range().isNull()}, distinct=distinct),
        cp.Check("trade_date", t, violations={"range": (t > F.col("pull_date")) | (t < F.lit("2000-01-01").cast("date")), "pattern": F.weekday(t) >= 5}),
    ]


def _symbol_checks() -> list[cp.Check]:
    s = F.col("symbol")
    # \\z-like: a final line end must not slip past the anchor
    return [cp.Check("symbol", s, violations={"pattern": s.isNotNull() & ~(s.rlike(SYMBOL_SHAPE) & ~s.contains("\n"))})]


LOAD = ["universe", "load_id"]
TABLE_LOAD = ["table_name", *LOAD]


def _cells(spark: SparkSession, d: str, all_distinct: bool) -> DataFrame:
    """The cells of both tables, each read once."""
    names = ["v_range", "v_pattern"]
    price = cp.cells(table(spark, d, "fact_daily_prices"), LOAD, _price_checks(all_distinct), names)
    company = cp.cells(table(spark, d, "dim_company"), LOAD, _symbol_checks(), names)
    both = price.withColumn("table_name", F.lit("fact_daily_prices")).unionByName(company.withColumn("table_name", F.lit("dim_company")))
    return materialise(both, "cells")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """A median that may have moved by the power sums is bounded by its bucket; the table is read again, for the
    values of one bucket of the loads concerned, only if that leaves a load open."""
    parts = _cells(spark, d, all_distinct=False)
    keys = ["universe", "table_name", "column_name"]
    rows = cp.against_previous(cp.moments(cp.profile(parts, TABLE_LOAD)), "load_id", keys, ["mean", "sd", "med_lo", "med_hi", "n_distinct"])
    surely, unsure = cp.median_moved(4.0, 0.25)
    may = cp.may_differ(4.0, 0.25) & (F.col("column_name") == "adjusted_close")
    rows = materialise(rows.withColumns({"moved": may & surely, "open": may & unsure}), "profiles")
    unsettled = rows.where("open").select(*LOAD)
    if not unsettled.isEmpty():
        asked = unsettled.unionByName(unsettled.withColumn("load_id", F.col("load_id") - 1)).distinct()
        wanted = cp.middle(parts.where("column_name = 'adjusted_close'"), LOAD).join(asked, LOAD, "left_semi")
        values = cp.number_values(table(spark, d, "fact_daily_prices"), LOAD, _in_range())
        exact = cp.settle(values, sized(materialise(wanted, "middle-buckets")), LOAD)
        exact = cp.against_previous(exact, "load_id", ["universe"], ["median"]).where("median > prev_median * 4 or median < prev_median / 4")
        exact = exact.select(*LOAD, F.lit("adjusted_close").alias("column_name"), F.lit(True).alias("_exact"))
        rows = rows.join(exact, [*LOAD, "column_name"], "left").withColumn("moved", F.col("moved") | (F.col("open") & F.coalesce("_exact", F.lit(False))))
    days = (F.col("n_distinct") > F.col("prev_n_distinct") * 2) | (F.col("n_distinct") * 2 < F.col("prev_n_distinct"))
    names = (F.col("n_distinct") * 2 > F.col("prev_n_distinct") * 3) | (F.col("n_distinct") * 3 < F.col("prev_n_distinct") * 2)
    shift = F.when(F.col("column_name") == "adjusted_close", F.col("moved")).when(F.col("column_name") == "trade_date", days).otherwise(names)
    findings = F.array_compact(
        F.array(
            F.when(F.col("nulls") * 10 > F.col("n"), "null_rate"),
            F.when(F.col("v_range") > 0, "range"),
            F.when(F.col("v_pattern") > 0, "pattern"),
            F.when(F.col("has_prev") & shift, "distribution"),
        )
    )
    return rows.select("table_name", "column_name", "load_id", F.explode(findings).alias("finding"))


def p7_profile(spark: SparkSession, d: str) -> DataFrame:
    """The whole profile of each load and column, with the standardised difference from the load before."""
    parts = _cells(spark, d, all_distinct=True)
    numbers = parts.where("column_name = 'adjusted_close'")
    medians = cp.settle(cp.cell_values(numbers, LOAD), cp.middle(numbers, LOAD), LOAD).withColumn("column_name", F.lit("adjusted_close"))
    rows = cp.against_previous(cp.moments(cp.profile(parts, TABLE_LOAD)), "load_id", ["universe", "table_name", "column_name"], ["mean", "sd"])
    rows = rows.join(medians, [*LOAD, "column_name"], "left")
    return rows.select(
        "table_name", "column_name", "universe", "load_id", "n", "nulls", "n_distinct", "lo_text", "hi_text", "lo", "hi", "v_range", "v_pattern", "median", "big",
        F.round("mean", 8).alias("mean"), F.round("sd", 8).alias("sd"), F.round("skew", 4).alias("skew"), F.round(cp.standardised_difference(), 6).alias("shift"),
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_rolling_totals, p2_found, p2_known_at_event, p3_found, p3_change_report, p3_holdings, p5_found, p5_daily_prices, p6_found, p7_found, p7_profile)}
