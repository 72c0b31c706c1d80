"""Staging: type the raw relations, drop unusable rows, deduplicate.

Filters run *before* the dedup window on purpose: a row with a NULL rate must
not win the rank and then be thrown away, hiding a valid duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.functions.dates import month_start
from ratebridge.operators.topk import asc, dedup_by_min, dedup_keep_first, desc

RATE_DECIMAL = T.DecimalType(10, 4)
#: Characters that are white space at the ends of a text.
BLANKS = " \t\n\r\f\v"


def stage_rates(raw: DataFrame) -> DataFrame:
    """One row per (rate_date, series_id): DATE, trimmed text, DECIMAL(10,4) value.

    Survivor among duplicates: smallest value, then name, then category (the
    reference keeps an arbitrary one). Reloads repeat the same observation
    many times, so duplicates are pre-aggregated map-side before the shuffle.
    """
    return dedup_by_min(typed_rates(raw), RATE_KEYS, "value", ["series_name", "category"])


RATE_KEYS = ["rate_date", "series_id"]


#: When a row was delivered; kept in merged tables, so that an older delivery that comes late replaces nothing.
DELIVERED = "delivered_at"


def rate_order():
    """Survivor order among deliveries of an observation (a total order): the newest delivery, within it as in ``stage_rates``."""
    return desc(DELIVERED) + asc("value", "series_name", "category")


def typed_rates(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a date, series and value; DATE, trimmed text, DECIMAL(10,4), and the ``keep`` columns as they are."""
    return raw.where(
        F.col("rate_date").isNotNull() & F.col("series_id").isNotNull() & F.col("value").isNotNull()
    ).select(
        F.col("rate_date").cast("date").alias("rate_date"),
        *[F.btrim(c, F.lit(BLANKS)).alias(c) for c in ("series_id", "series_name", "category")],
        F.col("value").cast(RATE_DECIMAL).alias("value"),
        *keep,
    )


BANK_COLUMNS = [
    "scrape_date",
    "bank",
    "period_label",
    "period_years",
    "list_rate",
    "avg_rate",
    "valid_from",
    "scraped_at",
    "source",
]


def stage_bank(raw: DataFrame, strict_dates: bool = True) -> DataFrame:
    """One row per (scrape_date, bank, period_label): the day's EARLIEST scrape.

    ``scraped_at`` is compared as ISO text, as the reference does. With
    ``strict_dates=False`` a malformed timestamp yields a NULL scrape_date
    instead of failing the build.
    """
    day = F.substring("scraped_at", 1, 10)
    scrape_date = F.to_date(day, "yyyy-MM-dd") if strict_dates else F.try_to_date(day, "yyyy-MM-dd")
    typed = raw.where(F.col("list_rate").isNotNull()).select(
        scrape_date.alias("scrape_date"),
        "bank",
        "period_label",
        F.col("period_years").cast("double").alias("period_years"),
        F.col("list_rate").cast("double").alias("list_rate"),
        F.col("avg_rate").cast("double").alias("avg_rate"),
        "valid_from",
        "scraped_at",
        "source",
    )
    return dedup_keep_first(
        typed,
        ["scrape_date", "bank", "period_label"],
        asc("scraped_at", "period_years", "list_rate", "avg_rate", "valid_from", "source"),
    )


SCB_COLUMNS = ["period_month", "period_date", "loan_type", "loan_type_name", "period_code", "period_label", "rate"]


def stage_scb(raw: DataFrame) -> DataFrame:
    """One row per (period_month, loan_type, period_code): the latest revision
    (``scraped_at`` descending), then the smallest rate."""
    typed = raw.where(F.col("rate").isNotNull()).select(
        "period_month",
        "loan_type",
        "loan_type_name",
        "period_code",
        "period_label",
        F.col("rate").cast("double").alias("rate"),
        "scraped_at",
    )
    deduped = dedup_keep_first(
        typed,
        ["period_month", "loan_type", "period_code"],
        desc("scraped_at") + asc("rate", "loan_type_name", "period_label"),
    )
    return deduped.select(
        "period_month",
        month_start("period_month").alias("period_date"),
        "loan_type",
        "loan_type_name",
        "period_code",
        "period_label",
        "rate",
    )
