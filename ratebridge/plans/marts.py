"""Marts: wide daily rates, bank margins, bank versus market."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.functions import funding as FN
from ratebridge.operators.reshape import pivot_series
from ratebridge.operators.snapshot import attach_snapshot, latest_complete_row
from ratebridge.operators.status import worst_status

SERIES_COLUMNS = [s[3] for s in S.SERIES]
SPREADS = {
    "stibor_policy_spread_3m": ("stibor_3m", "policy_rate"),
    "swestr_policy_spread_3m": ("swestr_3m_avg", "policy_rate"),
    "spread_2y": ("mortbond_2y", "govbond_2y"),
    "spread_5y": ("mortbond_5y", "govbond_5y"),
}
RATES_DAILY_COLUMNS = ["rate_date", *SERIES_COLUMNS, *SPREADS]


def spread(a: str, b: str):
    """``round(a - b, 4)``."""
    return F.round(F.col(a) - F.col(b), 4)


def rates_daily(stg_rates: DataFrame) -> DataFrame:
    """One row per date, one column per series, plus four spreads."""
    wide = pivot_series(stg_rates, "rate_date", "series_id", "value", S.SERIES_COLUMNS)
    return wide.select(
        "rate_date", *SERIES_COLUMNS, *[spread(a, b).alias(name) for name, (a, b) in SPREADS.items()]
    )


MARKET_COLUMNS = [
    "policy_rate",
    "stibor_3m",
    "govbond_2y",
    "govbond_5y",
    "mortbond_2y",
    "mortbond_5y",
    "stibor_policy_spread_3m",
    "swestr_policy_spread_3m",
    "spread_2y",
    "spread_5y",
]


def latest_market(daily: DataFrame) -> DataFrame:
    """The latest date on which all six funding inputs are present (0 or 1 row).

    ``daily`` is unique per date, so one global ``max_by`` finds the row; the
    staging chain under ``daily`` runs once (a self-join would run it twice)."""
    snap = latest_complete_row(daily, "rate_date", S.MARKET_REQUIRED, ["rate_date", *MARKET_COLUMNS])
    return snap.select(F.col("rate_date").alias("funding_date"), *MARKET_COLUMNS)


def funding_components(listed: DataFrame, market: DataFrame) -> DataFrame:
    """Every latest listed rate with the market snapshot and its funding components.

    ``market`` has at most one row (``latest_market`` of a relation unique on
    its date), so it is broadcast and the listed rates are never shuffled.
    """
    return FN.with_funding_components(attach_snapshot(listed, market))


def _funding_outputs() -> list:
    return [
        "funding_model",
        "funding_weight_2y",
        "funding_weight_5y",
        *FN.COMPONENT_COLUMNS,
        F.round(FN.component_sum(), 4).alias("funding_cost"),
        FN.funding_source("period_years").alias("funding_cost_source"),
    ]


def bank_margin(daily: DataFrame, latest_listed: DataFrame) -> DataFrame:
    """Latest listed rates with a stylised funding cost and gross / average margins."""
    listed = latest_listed.select(
        "scrape_date",
        "bank",
        "period_label",
        "period_years",
        "list_rate",
        "avg_rate",
        "listed_rate_age_days",
        "listed_rate_freshness",
    )
    f = funding_components(listed, latest_market(daily))
    return f.select(
        "bank",
        FN.tenor_label("period_years").alias("period_label"),
        F.col("period_label").alias("period_label_display"),
        "period_years",
        "list_rate",
        "avg_rate",
        "listed_rate_age_days",
        "listed_rate_freshness",
        *_funding_outputs(),
        FN.margin_over_funding("list_rate").alias("gross_margin"),
        F.when(F.col("avg_rate").isNotNull(), FN.margin_over_funding("avg_rate")).alias("avg_margin"),
        "scrape_date",
        "funding_date",
    )


def scb_by_bucket(latest_scb_rates: DataFrame, buckets_only: bool = False) -> DataFrame:
    """Per period_label: new-loan and outstanding rates and months side by side,
    the oldest age and the worst freshness level. With ``buckets_only`` only the
    labels a bank tenor can map to are kept (at most five rows)."""
    src = latest_scb_rates
    if buckets_only:
        src = src.where(F.col("period_label").isin(S.MARKET_BUCKETS))
    lt = F.col("loan_type")
    return src.groupBy("period_label").agg(
        F.max(F.when(lt == S.NEW_LOANS, F.col("rate"))).alias("new_loan_rate"),
        F.max(F.when(lt == S.OUTSTANDING_LOANS, F.col("rate"))).alias("outstanding_rate"),
        F.max(F.when(lt == S.NEW_LOANS, F.col("period_month"))).alias("scb_new_loan_period_month"),
        F.max(F.when(lt == S.OUTSTANDING_LOANS, F.col("period_month"))).alias("scb_outstanding_period_month"),
        F.max("scb_rate_age_days").alias("scb_rate_age_days"),
        worst_status("scb_rate_freshness").alias("scb_rate_freshness"),
    )


def bank_vs_market(daily: DataFrame, latest_listed: DataFrame, latest_scb_rates: DataFrame) -> DataFrame:
    """Listed rates against market averages and the funding proxy.

    The market side is grouped per bucket label and filtered to the five labels
    the join key can take, so the broadcast holds at most five rows whatever
    the input size; the bucket key is computed once, not repeated in the join.
    """
    listed = latest_listed.select(
        "bank",
        F.col("period_label").alias("period_label_display"),
        "period_years",
        "list_rate",
        "listed_rate_age_days",
        "listed_rate_freshness",
    ).withColumn("scb_bucket", FN.market_bucket("period_years"))
    f = funding_components(listed, latest_market(daily))
    s = scb_by_bucket(latest_scb_rates, buckets_only=True).withColumnRenamed("period_label", "__bucket")
    j = f.join(F.broadcast(s), F.col("scb_bucket") == F.col("__bucket"), "left")
    return j.select(
        "bank",
        FN.tenor_label("period_years").alias("period_label"),
        "period_label_display",
        "period_years",
        "scb_bucket",
        "list_rate",
        "listed_rate_age_days",
        "listed_rate_freshness",
        F.col("new_loan_rate").alias("scb_new_loan_rate"),
        F.col("outstanding_rate").alias("scb_outstanding_rate"),
        "scb_rate_age_days",
        "scb_rate_freshness",
        *_funding_outputs(),
        FN.margin_over_funding("list_rate").alias("gross_margin_listed"),
        FN.margin_over_funding("new_loan_rate").alias("effective_margin_new"),
        F.round(F.col("list_rate") - F.col("new_loan_rate"), 4).alias("list_vs_mkt_discount"),
        "funding_date",
        F.coalesce("scb_new_loan_period_month", "scb_outstanding_period_month").alias("scb_period_month"),
        "scb_new_loan_period_month",
        "scb_outstanding_period_month",
    )


def for_display(df: DataFrame, name: str) -> DataFrame:
    """The reference's presentation order (tables carry no stored order; apply on read)."""
    orders = {
        "rates_daily": [F.col("rate_date").desc_nulls_last()],
        "bank_margin": [F.col("bank").asc_nulls_last(), F.col("period_years").asc_nulls_last()],
        "bank_vs_market": [F.col("bank").asc_nulls_last(), F.col("period_years").asc_nulls_last()],
        "stage_bank": [
            F.col("scrape_date").desc_nulls_last(),
            F.col("bank").asc_nulls_last(),
            F.col("period_years").asc_nulls_last(),
        ],
        "stage_scb": [
            F.col("period_month").desc_nulls_last(),
            F.col("loan_type").asc_nulls_last(),
            F.col("period_code").asc_nulls_last(),
        ],
    }
    return df.orderBy(*orders[name])
