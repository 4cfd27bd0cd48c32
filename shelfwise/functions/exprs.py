"""Column-expression helpers.  Everything here is a built-in Spark expression,
so it stays inside whole-stage codegen; no Python runs per row."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def elapsed_days(later, earlier) -> Column:
    """Whole elapsed 24-hour periods between two timestamps (floor, so a gap of
    23h59m is 0 days and a negative gap rounds down), not a calendar-date diff."""
    us = F.timestamp_diff("MICROSECOND", col(earlier), col(later))
    return F.floor(us / F.lit(MICROS_PER_DAY))


def money(c, precision: int = 12, scale: int = 2) -> Column:
    """Money stays DECIMAL so sums are exact and independent of row order."""
    return col(c).cast(f"decimal({precision},{scale})")


def round6(c) -> Column:
    """Final rounding of irrational / averaged doubles for engine-independent output."""
    return F.round(col(c).cast("double"), 6)


def ratio(num, den) -> Column:
    """Division that yields NULL instead of failing (ANSI) on a zero denominator."""
    return F.try_divide(col(num), col(den))


def nz(c, default=0) -> Column:
    return F.coalesce(col(c), F.lit(default))


def log_eps(c, eps: float = 1e-5) -> Column:
    """Epsilon-guarded natural log ln(x + eps)."""
    return F.ln(col(c).cast("double") + F.lit(eps))


def clip(c, lo=None, hi=None) -> Column:
    out = col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def day_string(c) -> Column:
    """``%Y-%m-%d`` rendering of a date/timestamp."""
    return F.date_format(col(c), "yyyy-MM-dd")


def calendar_flags(date_col) -> list[Column]:
    """Calendar features of a date: Monday = 0 weekday, month, quarter, weekend
    (Sat/Sun), month end, and the holiday proxy (Jan 1-7 or Dec 25-31)."""
    d = col(date_col)
    dow = F.weekday(d)
    month = F.month(d)
    day = F.dayofmonth(d)
    return [
        dow.alias("day_of_week"),
        month.alias("month"),
        dow.isin(5, 6).cast("int").alias("is_weekend"),
        (F.last_day(d) == F.to_date(d)).cast("int").alias("is_month_end"),
        F.quarter(d).alias("quarter"),
        (((month == 1) & (day <= 7)) | ((month == 12) & (day >= 25))).cast("int")
        .alias("is_holiday_proxy"),
    ]
