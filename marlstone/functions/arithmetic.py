"""Guarded arithmetic: a missing or zero denominator gives null under ANSI rules too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def ratio_if_positive(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b > 0, a.cast("double") / b.cast("double"))


def growth(now: Column | str, before: Column | str) -> Column:
    """(now - before) / before; the sign of a negative base is kept."""
    now, before = (F.col(x) if isinstance(x, str) else x for x in (now, before))
    return ratio(now - before, before)


def cagr(start: Column, end: Column, years: int) -> Column:
    return F.when((start > 0) & (end > 0), F.pow(end.cast("double") / start.cast("double"), F.lit(1.0 / years)) - 1)


def weighted_mean(x: Column, w: Column) -> Column:
    """Null values still count their weight; null weights count nothing."""
    w = F.coalesce(w.cast("double"), F.lit(0.0))
    return F.sum(x * w) / F.nullif(F.sum(w), F.lit(0.0))
