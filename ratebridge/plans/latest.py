"""Latest rate per key with age and freshness level."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ratebridge import schemas as S
from ratebridge.operators.status import with_freshness
from ratebridge.operators.topk import asc, desc, latest_per_key


def latest_bank(stg_bank: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Latest listed rate per (bank, period_label), even when one bank lags."""
    latest = latest_per_key(
        stg_bank,
        ["bank", "period_label"],
        desc("scrape_date", "scraped_at") + asc("period_years", "list_rate", "avg_rate", "valid_from", "source"),
    )
    warn, stale = S.LISTED_RATE_FRESHNESS
    return with_freshness(
        latest, "scrape_date", as_of, warn, stale, "listed_rate_age_days", "listed_rate_freshness"
    )


def latest_scb(stg_scb: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Latest market-average rate per (loan_type, period_label).

    Two codes sharing a label (e.g. several unknown codes) are resolved by the
    smallest code, where the reference picks arbitrarily.
    """
    latest = latest_per_key(
        stg_scb,
        ["loan_type", "period_label"],
        desc("period_date") + asc("period_code", "rate", "loan_type_name", "period_month"),
    )
    warn, stale = S.SCB_RATE_FRESHNESS
    return with_freshness(latest, "period_date", as_of, warn, stale, "scb_rate_age_days", "scb_rate_freshness")
