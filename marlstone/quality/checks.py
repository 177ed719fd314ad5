"""Checks with a severity; each is one aggregation, none brings rows to the driver but a few examples."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.clean import token, weekdays_between
from marlstone.sources.storage import write_report

CRITICAL, WARN, INFO = "critical", "warn", "info"


@dataclass
class Result:
    name: str
    severity: str
    passed: bool
    details: dict = field(default_factory=dict)


def has_rows(name: str, df: DataFrame, severity: str = CRITICAL) -> Result:
    n = df.count()
    return Result(f"{name}.row_count", severity, n > 0, {"rows": n})


def unique(name: str, df: DataFrame, keys: Sequence[str], severity: str = CRITICAL) -> Result:
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    examples = [list(r)[:-1] for r in twice.orderBy(*keys).limit(5).collect()]
    n = twice.count() if examples else 0
    return Result(f"{name}.unique", severity, n == 0, {"duplicates": n, "examples": examples})


def null_rate(name: str, df: DataFrame, column: str, at_most: float, severity: str = CRITICAL) -> Result:
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(F.col(column).isNull())).first()
    rate = 100 * nulls / n if n else 0.0
    return Result(f"{name}.{column}.null_rate", severity, rate <= at_most, {"rows": n, "nulls": nulls, "percent": round(rate, 4)})


def stale_weekdays(df: DataFrame, column: str, today: str) -> DataFrame:
    return df.agg(F.max(column).alias("_m")).select(weekdays_between(F.col("_m"), F.to_date(F.lit(today))).alias("stale"))


def freshness(name: str, df: DataFrame, column: str, today: str, warn: int = 2, critical: int = 5) -> list[Result]:
    """Weekdays since the latest value; with no data both limits are missed."""
    stale = stale_weekdays(df, column, today).first()[0]
    return [Result(f"{name}.freshness_{s}", s, stale is not None and stale <= most, {"weekdays": stale}) for s, most in ((WARN, warn), (CRITICAL, critical))]


def coverage(name: str, wanted: DataFrame, held: DataFrame, key: str, at_least: float, severity: str = WARN) -> Result:
    w = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    n, met = w.count(), w.join(held.select(key).distinct(), key, "left_semi").count()
    rate = 100 * met / n if n else 0.0
    return Result(f"{name}.coverage", severity, rate >= at_least, {"wanted": n, "held": met, "percent": round(rate, 4)})


def group_coverage(name: str, snapshots: DataFrame, at: str, group: str, at_least: float, severity: str = CRITICAL) -> Result:
    """How many rows of the latest snapshot name a group that isn't blank or a null token; with no rows the limit is missed."""
    latest = latest_group_coverage(snapshots, at, group).first()
    percent = latest["percent"] if latest is not None else None
    return Result(f"{name}.{group}.coverage", severity, percent is not None and percent >= at_least, {"snapshot": str(latest[0]) if latest is not None else None, "percent": percent})


def latest_group_coverage(snapshots: DataFrame, at: str, group: str) -> DataFrame:
    """at, rows, named, percent of the latest snapshot: summed up per snapshot first, so only as many rows as snapshots are compared."""
    per = snapshots.where(F.col(at).isNotNull()).groupBy(at).agg(F.count(F.lit(1)).alias("rows"), F.count(token(group)).alias("named"))
    return per.orderBy(F.desc(at)).limit(1).withColumn("percent", F.round(F.lit(100.0) * F.col("named") / F.col("rows"), 4))


def columns_present(name: str, df: DataFrame, needed: Sequence[str], severity: str = CRITICAL) -> Result:
    missing = sorted(set(needed) - set(df.columns))
    return Result(f"{name}.schema", severity, not missing, {"missing": missing})


def within(name: str, df: DataFrame, column: str, lo: float, hi: float, severity: str = CRITICAL) -> Result:
    n = df.where((F.col(column) < lo) | (F.col(column) > hi)).count()
    return Result(f"{name}.{column}.bounds", severity, n == 0, {"outside": n})


def run(suite: str, checks: Mapping[str, Callable[[], Result | list[Result]]], path: str | None = None) -> tuple[int, dict]:
    """Exit code (1 if a critical check failed or broke) and report; a check that raises fails as critical."""
    began, results = time.time(), []
    for name, check in checks.items():
        try:
            r = check()
            results += r if isinstance(r, list) else [r]
        except Exception as e:  # noqa: BLE001
            results.append(Result(name, CRITICAL, False, {"error": str(e)[:300]}))
    report = {"suite": suite, "seconds": round(time.time() - began, 3), "results": [asdict(r) for r in results]}
    report["failed"] = [r.name for r in results if not r.passed]
    if path:
        write_report(SparkSession.active(), report, path)
    return int(any(not r.passed and r.severity == CRITICAL for r in results)), report


# The columns each table must have, and the limits of the checks.
REQUIRED = {
    "dim_company": ("symbol", "name", "sector", "industry"),
    "fact_daily_prices": ("symbol", "trade_date", "close", "adjusted_close", "volume"),
    "fact_fundamentals_wide": ("symbol", "fiscal_date_ending", "period_type", "total_revenue", "net_income"),
    "fact_valuation_daily": ("symbol", "trade_date", "pe_ttm"),
    "fact_institutional_holdings": ("symbol", "holder_name", "shares_held"),
}
MOST_NULLS, ACTIVE_COVERAGE, VALUED_COVERAGE, SECTOR_COVERAGE = 1.0, 80.0, 100.0, 90.0


def suite(kind: str, t: Mapping[str, DataFrame], today: str) -> dict[str, Callable[[], Result | list[Result]]]:
    """The daily, weekly or full (both) checks over named tables."""
    prices, dim = t["fact_daily_prices"], t["dim_company"]
    daily: dict[str, Callable[[], Result | list[Result]]] = {
        "dim_rows": lambda: has_rows("dim_company", dim),
        "price_rows": lambda: has_rows("fact_daily_prices", prices),
        "price_key": lambda: unique("fact_daily_prices", prices, ["symbol", "trade_date"]),
        "nulls": lambda: null_rate("fact_daily_prices", prices, "adjusted_close", MOST_NULLS),
        "fresh": lambda: freshness("fact_daily_prices", prices, "trade_date", today),
    }
    weekly: dict[str, Callable[[], Result | list[Result]]] = {f"{n}_rows": (lambda n=n: has_rows(n, t[n], WARN)) for n in sorted(t)}
    weekly |= {f"{n}_columns": (lambda n=n: columns_present(n, t[n], REQUIRED[n])) for n in sorted(REQUIRED) if n in t}
    weekly |= {
        "active": lambda: coverage("active_priced", dim.where("lower(trim(listing_status)) = 'active'"), prices, "symbol", ACTIVE_COVERAGE),
        "valued": lambda: coverage("prices_valued", t["fact_prices_enriched"], t["fact_valuation_daily"], "symbol", VALUED_COVERAGE, CRITICAL),
        "sectors": lambda: group_coverage("dim_company", dim, "snapshot_date", "sector", SECTOR_COVERAGE),
        "bounds": lambda: within("fact_institutional_holdings", t["fact_institutional_holdings"], "pct_of_portfolio", 0, 100),
    }
    return {"daily": daily, "weekly": weekly, "full": daily | weekly}[kind]


def measures(spark: SparkSession, t: Mapping[str, DataFrame], today: str) -> DataFrame:
    """(check_name, measure): the figures behind the checks, as one frame and without the driver."""
    def one(name: str, df: DataFrame, c: Column) -> DataFrame:
        return df.agg(c.cast("double").alias("measure")).select(F.lit(name).alias("check_name"), "measure")
    n = F.count(F.lit(1))
    def rate(hits: Column) -> Column:
        return F.round(F.lit(100.0) * hits / F.nullif(n, F.lit(0)), 4)
    prices = t["fact_prices_enriched"].select("symbol").distinct()
    held = t["fact_valuation_daily"].select(F.col("symbol").alias("_s")).distinct()
    parts = [
        one("null_rate", t["fact_daily_prices"], rate(F.count_if(F.col("adjusted_close").isNull()))),
        one("unique_key", t["fact_valuation_daily"].groupBy("universe", "symbol", "trade_date").agg(n.alias("k")).where("k > 1"), n),
        one("coverage", prices.join(held, F.col("symbol") == F.col("_s"), "left"), rate(F.count("_s"))),
        one("out_of_bounds", t["fact_institutional_holdings"].where("pct_of_portfolio < 0 or pct_of_portfolio > 100"), n),
        one("row_count", t["dim_company"], n),
        stale_weekdays(t["fact_prices_enriched"], "trade_date", today).select(F.lit("weekdays_stale").alias("check_name"), F.col("stale").cast("double").alias("measure")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
