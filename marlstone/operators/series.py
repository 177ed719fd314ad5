"""Row-based windows over (key, time) series, and recursive smoothing.

Windows count rows. Every function takes the window spec of the series, so
any number of them shares one exchange and one sort. Nulls inside a window are
skipped; a result with fewer non-null values than asked for is null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marlstone.functions.arithmetic import ratio

TRADING_DAYS = 252


def series(key: str | Sequence[str], time: str) -> WindowSpec:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(time)


def change(x: Column, w: WindowSpec, k: int = 1) -> Column:
    """x over its value k rows before, less 1. Gaps aren't filled first."""
    return ratio(x, F.lag(x, k).over(w)) - 1


def rolling(agg: Callable[[Column], Column], x: Column, w: WindowSpec, rows: int, least: int) -> Column:
    frame = w.rowsBetween(1 - rows, 0)
    return F.when(F.count(x).over(frame) >= least, agg(x).over(frame))


def volatility(returns: Column, w: WindowSpec, rows: int, least: int) -> Column:
    return rolling(F.stddev_samp, returns, w, rows, least) * F.sqrt(F.lit(float(TRADING_DAYS)))


def bollinger(x: Column, w: WindowSpec, rows: int = 20, width: float = 2.0) -> dict[str, Column]:
    mid, sd = rolling(F.avg, x, w, rows, rows), rolling(F.stddev_samp, x, w, rows, rows)
    upper, lower = mid + width * sd, mid - width * sd
    return {"bb_middle": mid, "bb_upper": upper, "bb_lower": lower, "bb_pct_b": ratio(x - lower, upper - lower)}


def days_before(key: str | Sequence[str], date: str, days: int) -> WindowSpec:
    """The calendar days (d - days, d], however many rows they hold."""
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(F.unix_date(F.col(date))).rangeBetween(1 - days, 0)


def densify(df: DataFrame, key: str, date: str, fill: dict[str, Column]) -> DataFrame:
    """A row for each calendar day between a key's first and last; absent days take `fill`.

    df holds (key, date) once. Each row brings the days up to its successor, so
    nothing is joined.
    """
    w = series(key, date)
    until = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    out = df.withColumn("_until", until).withColumn("_day", F.explode(F.sequence(F.col(date), F.col("_until"))))
    here = F.col("_day") == F.col(date)
    return out.select(key, F.col("_day").alias(date), *[F.when(here, F.col(c)).otherwise(v).alias(c) for c, v in fill.items()])


def ewm(x: np.ndarray, alpha: float, least: int) -> np.ndarray:
    """Recursive mean, seeded by the first value: a gap ages the past, and the output is masked
    until `least` values were seen."""
    return pd.Series(x).ewm(alpha=alpha, adjust=False, min_periods=least).mean().to_numpy()


INDICATORS = "ema_12 double, ema_26 double, macd double, macd_signal double, macd_hist double, rsi_14 double, atr_14 double"


def with_indicators(df: DataFrame, key: str, time: str, close: str, high: str, low: str, adjusted: str, keep: Sequence[str] = (), names: Sequence[str] = tuple(c.split()[0] for c in INDICATORS.split(", "))) -> DataFrame:
    """key, time, the columns to keep and the recursive indicators named; df holds (key, time) once.

    A recursion has no frame, so the rows of a key are folded in one Arrow batch;
    there is at most one row per key and day. An average loss of zero leaves the
    strength index null. The first true range is high less low.
    """
    kinds, asked = dict(df.dtypes), set(names)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(time, kind="stable")
        out = g[[key, time, *keep]].copy()
        made: dict[str, np.ndarray] = {}
        a = g["_a"].to_numpy(float)
        if asked & {"ema_12", "ema_26", "macd", "macd_signal", "macd_hist"}:
            made["ema_12"], made["ema_26"] = ewm(a, 2 / 13, 12), ewm(a, 2 / 27, 26)
            made["macd"] = made["ema_12"] - made["ema_26"]
            made["macd_signal"] = ewm(made["macd"], 2 / 10, 9)
            made["macd_hist"] = made["macd"] - made["macd_signal"]
        if "rsi_14" in asked:
            step = np.diff(a, prepend=np.nan)
            gain, loss = (ewm(np.where(np.isnan(step), np.nan, np.maximum(x, 0)), 1 / 14, 14) for x in (step, -step))
            with np.errstate(divide="ignore", invalid="ignore"):
                made["rsi_14"] = np.where(loss == 0, np.nan, 100 - 100 / (1 + gain / loss))
        if "atr_14" in asked:
            before = np.concatenate([[np.nan], g["_c"].to_numpy(float)[:-1]]) if len(g) else a
            h, lo = g["_h"].to_numpy(float), g["_l"].to_numpy(float)
            made["atr_14"] = ewm(np.fmax(np.fmax(np.abs(h - lo), np.abs(h - before)), np.abs(lo - before)), 1 / 14, 14)
        return out.assign(**{n: made[n] for n in names})

    narrow = df.select(key, time, *keep, F.col(adjusted).cast("double").alias("_a"), F.col(high).cast("double").alias("_h"), F.col(low).cast("double").alias("_l"), F.col(close).cast("double").alias("_c"))
    out = narrow.groupBy(key).applyInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in (key, time, *keep)) + "".join(f", {n} double" for n in names))
    return out.select(key, time, *keep, *[F.nanvl(F.col(n), F.lit(None).cast("double")).alias(n) for n in names])
