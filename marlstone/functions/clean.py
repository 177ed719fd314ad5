"""Text to typed values: whatever isn't a value becomes null, nothing raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKENS = ("", "NONE", "NULL")


def token(c: Column | str) -> Column:
    """Trimmed text; null for the tokens that stand for null, in any case."""
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(~F.upper(t).isin(*NULL_TOKENS), t)


def to_double(c: Column | str) -> Column:
    return token(c).try_cast("double")


def to_long(c: Column | str) -> Column:
    """Whole part of any number: '123.9' is 123."""
    return token(c).try_cast("double").try_cast("bigint")


def to_long_strict(c: Column | str) -> Column:
    """Only texts that are whole numbers: '123.0' is null."""
    t = token(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint"))


def to_date(c: Column | str) -> Column:
    return token(c).try_cast("date")


def compact_timestamp(c: Column | str) -> Column:
    """yyyyMMddTHHmmss or yyyyMMddTHHmm."""
    t = token(c)
    return F.coalesce(F.try_to_timestamp(t, F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(t, F.lit("yyyyMMdd'T'HHmm")))


def first_truthy(*cs: Column | str) -> Column:
    """The first that is neither null nor blank nor a null token."""
    return F.coalesce(*[token(c) for c in cs])


def quarter_label(d: Column | str) -> Column:
    """2024Q1, or null."""
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def weekdays_between(lo: Column, hi: Column) -> Column:
    """Mondays to Fridays in (lo, hi]; 0 if hi isn't after lo, null if one is null. Closed form: no list of days is made."""
    def upto(d: Column) -> Column:
        n = F.unix_date(d) + 3  # day 0 is then a Monday
        week = F.floor(n / 7)
        return week * 5 + F.least(n - week * 7 + 1, F.lit(5))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.greatest(upto(hi) - upto(lo), F.lit(0)).cast("int"))


def short_number(x: Column) -> Column:
    """1.2T, 3.4B, 5.6M, 7.8K: a sign, one decimal, a unit."""
    size = F.abs(x)
    out = F.lit(None).cast("string")
    for unit, scale in (("", 1.0), ("K", 1e3), ("M", 1e6), ("B", 1e9), ("T", 1e12)):
        out = F.when(size >= scale, F.concat(F.format_string("%.1f", x / scale), F.lit(unit))).otherwise(out)
    return F.coalesce(out, F.when(x.isNotNull(), F.format_string("%.1f", x)))


# The share of a term that may vary, and the shortest term that does.
JITTER, LEAST_TTL = 0.15, 20


def jitter_days(key: Column | str, ttl: int, fraction: float = JITTER, least_ttl: int = LEAST_TTL) -> Column:
    """A whole number in [-m, m], m = round(ttl * fraction), fixed by the key; none for short terms."""
    if ttl < least_ttl:
        return F.lit(0)
    m = round(ttl * fraction)
    return (F.pmod(F.crc32(F.encode(key, "utf-8")), F.lit(2 * m + 1)) - m).cast("int")


def symbol_list(symbols: Sequence[str]) -> list[str]:
    """Symbols fit for an IN list: letters and digits, with dots and dashes between; others are refused."""
    for s in symbols:
        if not s.replace(".", "").replace("-", "").isalnum():
            raise ValueError(f"not a symbol: {s!r}")
    return list(symbols)


def none_counts(schema: Sequence[tuple[str, str]]) -> list[Column]:
    """Per text column the number of rows with the text None."""
    return [F.count_if(F.col(f"`{n}`") == "None").alias(n) for n, t in schema if t == "string"]
