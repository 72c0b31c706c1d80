"""Declared schemas of the raw relations and the small reference dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw relations (fixed, declared; no inference) ---------------------------

SE_RATES_RAW = T.StructType(
    [
        T.StructField("rate_date", T.StringType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("series_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

BANK_LISTED_RATES_RAW = T.StructType(
    [
        T.StructField("bank", T.StringType()),
        T.StructField("period_label", T.StringType()),
        T.StructField("period_years", T.DoubleType()),
        T.StructField("list_rate", T.DoubleType()),
        T.StructField("avg_rate", T.DoubleType()),
        T.StructField("valid_from", T.StringType()),
        T.StructField("scraped_at", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

SCB_MORTGAGE_RATES_RAW = T.StructType(
    [
        T.StructField("period_month", T.StringType()),
        T.StructField("loan_type", T.StringType()),
        T.StructField("loan_type_name", T.StringType()),
        T.StructField("period_code", T.StringType()),
        T.StructField("period_label", T.StringType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("scraped_at", T.StringType()),
    ]
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "se_rates_raw": SE_RATES_RAW,
    "bank_listed_rates_raw": BANK_LISTED_RATES_RAW,
    "scb_mortgage_rates_raw": SCB_MORTGAGE_RATES_RAW,
}

# --- nested payloads ----------------------------------------------------------

# Keys stay apart from their values, so an explicit null differs from an absent key.
OBSERVATIONS_PAYLOAD = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

PX_TABLE_PAYLOAD = T.StructType(
    [
        T.StructField("columns", T.ArrayType(T.StructType([T.StructField("code", T.StringType())]))),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.ArrayType(T.StringType())),
                        T.StructField("values", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
    ]
)

OFFERS_PAYLOAD = T.StructType(
    [
        T.StructField(
            "listInterests",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("period", T.StringType()),
                        T.StructField("interestRate", T.StringType()),
                        T.StructField("validFrom", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

# --- fixed values that must equal the reference's -----------------------------
# Series id, display name, category, wide column name (rates_daily), in the
# reference's column order.
SERIES: list[tuple[str, str, str, str]] = [
    ("SECBREPOEFF", "Policy rate", "central_bank", "policy_rate"),
    ("SECBDEPOEFF", "Deposit rate", "central_bank", "deposit_rate"),
    ("SECBLENDEFF", "Lending rate", "central_bank", "lending_rate"),
    ("SEDP3MSTIBORDELAYC", "STIBOR 3M", "money_market", "stibor_3m"),
    ("SETB3MBENCH", "T-bill 3M", "money_market", "tbill_3m"),
    ("SEGVB2YC", "Govt bond 2Y", "government_bond", "govbond_2y"),
    ("SEGVB5YC", "Govt bond 5Y", "government_bond", "govbond_5y"),
    ("SEGVB10YC", "Govt bond 10Y", "government_bond", "govbond_10y"),
    ("SEMB2YCACOMB", "Covered bond 2Y", "covered_bond", "mortbond_2y"),
    ("SEMB5YCACOMB", "Covered bond 5Y", "covered_bond", "mortbond_5y"),
    ("SWESTRAVG3M", "SWESTR 3M compounded average", "money_market", "swestr_3m_avg"),
]
SERIES_IDS: list[str] = [s[0] for s in SERIES]
SERIES_COLUMNS: dict[str, str] = {s[0]: s[3] for s in SERIES}
# The one series served by the averages endpoint (its observations carry "rate").
AVERAGE_SERIES: frozenset[str] = frozenset({"SWESTRAVG3M"})

# Bank period text or code -> (years, label).
BANK_PERIODS: list[tuple[str, float, str]] = [
    ("P_3_MONTHS", 0.25, "3M"),
    ("P_1_YEAR", 1.0, "1Y"),
    ("P_2_YEARS", 2.0, "2Y"),
    ("P_3_YEARS", 3.0, "3Y"),
    ("P_4_YEARS", 4.0, "4Y"),
    ("P_5_YEARS", 5.0, "5Y"),
    ("P_7_YEARS", 7.0, "7Y"),
    ("P_10_YEARS", 10.0, "10Y"),
    ("3 månader", 0.25, "3M"),
    ("3 mån", 0.25, "3M"),
    ("1 år", 1.0, "1Y"),
    ("2 år", 2.0, "2Y"),
    ("3 år", 3.0, "3Y"),
    ("4 år", 4.0, "4Y"),
    ("5 år", 5.0, "5Y"),
    ("6 år", 6.0, "6Y"),
    ("7 år", 7.0, "7Y"),
    ("8 år", 8.0, "8Y"),
    ("9 år", 9.0, "9Y"),
    ("10 år", 10.0, "10Y"),
]

# SCB binding-time code -> (label, years); unknown codes get this label.
SCB_PERIODS: list[tuple[str, str, float]] = [
    ("1.1.1", "3M", 0.25),
    ("1.1.2.1", "1Y", 1.0),
    ("1.1.2.2.1.1", "2Y", 2.0),
    ("1.1.2.2.2", "3-5Y", 4.0),
    ("1.1.2.3", "5Y+", 7.0),
]
SCB_UNKNOWN_LABEL = "unknown"

# SCB loan type code -> name; unknown codes keep the code as name.
SCB_LOAN_TYPES: list[tuple[str, str]] = [
    ("0100", "Nya och omförhandlade avtal"),
    ("0200", "Utestående avtal"),
]
NEW_LOANS = "0100"
OUTSTANDING_LOANS = "0200"

# Banks that must be present in every bank batch, and their source ids.
REQUIRED_BANKS: list[str] = ["SBAB", "Nordea", "Swedbank"]
BANK_SOURCES: dict[str, str] = {"SBAB": "sbab_api", "Nordea": "nordea_html", "Swedbank": "swedbank_html"}

# Freshness levels, best to worst.
FRESHNESS_LEVELS: list[str] = ["fresh", "aging", "stale"]
# (warn_after_days, stale_after_days) for the latest-rate models.
LISTED_RATE_FRESHNESS = (1, 3)
SCB_RATE_FRESHNESS = (45, 75)
# Source freshness rules: (warn_after_days, error_after_days).
SOURCE_FRESHNESS: dict[str, tuple[int, int]] = {
    "se_rates_raw": (2, 4),
    "bank_listed_rates_raw": (1, 2),
    "scb_mortgage_rates_raw": (35, 60),
}

# Columns that must all be present on the same date for a usable market snapshot.
MARKET_REQUIRED: list[str] = [
    "policy_rate",
    "govbond_2y",
    "govbond_5y",
    "swestr_policy_spread_3m",
    "spread_2y",
    "spread_5y",
]

# Funding-model names and source texts.
FUNDING_MODEL_SHORT = "swapped_covered_bond_variable_proxy"
FUNDING_MODEL_INTERPOLATED = "interpolated_covered_bond_curve"
FUNDING_MODEL_LONG = "five_year_covered_bond_proxy"
FUNDING_SOURCE_SHORT = "policy_rate + (swestr_3m_avg - policy_rate) + CAISSE spread_5y"
FUNDING_SOURCE_INTERPOLATED = "blended govt curve + blended CAISSE covered spread (2Y to 5Y)"
FUNDING_SOURCE_LONG = "govbond_5y + CAISSE spread_5y"

# Quarter-year count -> sortable tenor label; other tenors become NNNM.
TENOR_LABELS: list[tuple[int, str]] = [
    (1, "0.25Y"),
    (4, "01Y"),
    (8, "02Y"),
    (12, "03Y"),
    (16, "04Y"),
    (20, "05Y"),
    (24, "06Y"),
    (28, "07Y"),
    (32, "08Y"),
    (36, "09Y"),
    (40, "10Y"),
]

# Market (SCB) bucket labels a bank tenor can map to.
MARKET_BUCKETS: list[str] = ["3M", "1Y", "2Y", "3-5Y", "5Y+"]
