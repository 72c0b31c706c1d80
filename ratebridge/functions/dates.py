"""Date helpers: ages, freshness levels, look-back bounds, period codes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: str | dt.date | None) -> Column:
    """The reference date of a build: a fixed date, or today's date when None."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def age_days(date_col: Column | str, as_of: str | dt.date | None = None) -> Column:
    """Whole days from ``date_col`` to the as-of date (INT)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(as_of_column(as_of), d)


def freshness_level(age: Column | str, warn_after: int, stale_after: int) -> Column:
    """fresh if age <= warn_after, aging if <= stale_after, else stale (NULL age -> stale)."""
    a = F.col(age) if isinstance(age, str) else age
    return F.when(a <= warn_after, F.lit("fresh")).when(a <= stale_after, F.lit("aging")).otherwise(F.lit("stale"))


def month_code_to_iso(code: Column | str) -> Column:
    """Statistical month code ``2024M05`` -> ``2024-05``."""
    c = F.col(code) if isinstance(code, str) else code
    return F.replace(c, F.lit("M"), F.lit("-"))


def lookback_start(as_of: str | dt.date | None, days: int) -> Column:
    """First date of a ``days``-day look-back window ending at the as-of date."""
    if days < 1:
        raise ValueError("look-back must be at least 1 day")
    return F.date_sub(as_of_column(as_of), days)


def lookback_month(as_of: str | dt.date | None, months: int) -> Column:
    """``yyyy-MM`` of the month ``months`` before the as-of month (year wrap included)."""
    if months < 1:
        raise ValueError("look-back must be at least 1 month")
    return F.date_format(F.add_months(as_of_column(as_of), -months), "yyyy-MM")


def month_start(period_month: Column | str) -> Column:
    """``yyyy-MM`` text -> DATE of the first day; bad text raises (ANSI)."""
    p = F.col(period_month) if isinstance(period_month, str) else period_month
    return F.to_date(F.concat(p, F.lit("-01")), "yyyy-MM-dd")
