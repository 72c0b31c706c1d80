"""Registered queries over the rate models (staging, latest, funding, marts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge.functions import funding as FN
from ratebridge.plans import latest as L
from ratebridge.plans import marts as M
from ratebridge.plans import oracle as O
from ratebridge.plans import staging as ST
from ratebridge.plans.registry import _double, _sql_double, register
from ratebridge.sources import fixtures as FX

AS_OF = O.AS_OF

# ---- model builders over the adapters ---------------------------------------------


def staged_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.stage_rates(FX.se_rates_raw(spark, sf_dir))


def staged_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.stage_bank(FX.bank_listed_rates_raw(spark, sf_dir))


def staged_scb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.stage_scb(FX.scb_mortgage_rates_raw(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rates_daily(staged_rates(spark, sf_dir))


def latest_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest_bank(staged_bank(spark, sf_dir), AS_OF)


def latest_market_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest_scb(staged_scb(spark, sf_dir), AS_OF)


# ---- staging -----------------------------------------------------------------------


@register(
    "stage_rates",
    O.with_ctes(["stg_se_rates"], "SELECT rate_date, series_id, series_name, category, "
                "CAST(value AS DOUBLE) AS value FROM stg_se_rates"),
)
def q_stage_rates(spark, sf_dir):
    return staged_rates(spark, sf_dir).select("rate_date", "series_id", "series_name", "category", *_double("value"))


@register("stage_bank", O.with_ctes(["stg_bank"], "SELECT * FROM stg_bank"))
def q_stage_bank(spark, sf_dir):
    return staged_bank(spark, sf_dir)


@register("stage_scb", O.with_ctes(["stg_scb"], "SELECT * FROM stg_scb"))
def q_stage_scb(spark, sf_dir):
    return staged_scb(spark, sf_dir)


# ---- rates_daily and spreads ---------------------------------------------------------

_DECIMAL_DAILY = [c for c in M.RATES_DAILY_COLUMNS if c != "rate_date"]


@register(
    "rates_daily",
    O.with_ctes(["rates_daily"], f"SELECT rate_date, {_sql_double(*_DECIMAL_DAILY)} FROM rates_daily"),
)
def q_rates_daily(spark, sf_dir):
    return daily(spark, sf_dir).select("rate_date", *_double(*_DECIMAL_DAILY))


@register(
    "rate_spreads",
    O.with_ctes(["rates_daily"], f"SELECT rate_date, {_sql_double(*M.SPREADS)} FROM rates_daily"),
)
def q_rate_spreads(spark, sf_dir):
    return daily(spark, sf_dir).select("rate_date", *_double(*M.SPREADS))


# ---- latest --------------------------------------------------------------------------


@register("latest_bank", O.with_ctes(["latest_bank"], "SELECT * FROM latest_bank"))
def q_latest_bank(spark, sf_dir):
    return latest_listed(spark, sf_dir)


@register("latest_scb", O.with_ctes(["latest_scb"], "SELECT * FROM latest_scb"))
def q_latest_scb(spark, sf_dir):
    return latest_market_avg(spark, sf_dir)


@register(
    "latest_complete_market",
    O.with_ctes(["market"], f"SELECT funding_date, {_sql_double(*M.MARKET_COLUMNS)} FROM market"),
)
def q_latest_complete_market(spark, sf_dir):
    return M.latest_market(daily(spark, sf_dir)).select("funding_date", *_double(*M.MARKET_COLUMNS))


# ---- funding model ---------------------------------------------------------------------

_FUNDING_COLS = ["funding_model", "funding_weight_2y", "funding_weight_5y", *FN.COMPONENT_COLUMNS]


@register(
    "funding_components",
    O.with_ctes(
        ["latest_bank", "market"],
        f"SELECT bank, period_label, period_years, list_rate, funding_date, {', '.join(_FUNDING_COLS)}, round(cost, 4) AS funding_cost FROM priced",
        extra=[O.tenor_cte("latest_bank"), O.priced_cte("latest_bank")],
    ),
)
def q_funding_components(spark, sf_dir):
    listed = latest_listed(spark, sf_dir).select("bank", "period_label", "period_years", "list_rate")
    f = M.funding_components(listed, M.latest_market(daily(spark, sf_dir)))
    return f.select(
        "bank", "period_label", "period_years", "list_rate", "funding_date", *_FUNDING_COLS,
        F.round(FN.component_sum(), 4).alias("funding_cost"),
    )


def _part_tenors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size").cast("double") / 4).alias("period_years")
    )


_PART_YEARS = "SELECT p_partkey, CAST(p_size AS DOUBLE) / 4 AS period_years FROM part"


def _of_parts(columns: str) -> str:
    """Those columns for every part, from the relation of its tenor."""
    return f"WITH parts AS ({_PART_YEARS}),{O.tenor_cte('parts')}\nSELECT p_partkey, period_years, {columns} FROM parts JOIN tenor ON tenor_years IS NOT DISTINCT FROM period_years"


@register("curve_weights", _of_parts("funding_model, funding_weight_2y, funding_weight_5y"))
def q_curve_weights(spark, sf_dir):
    y = F.col("period_years")
    return _part_tenors(spark, sf_dir).select(
        "p_partkey", "period_years",
        FN.funding_model(y).alias("funding_model"),
        FN.weight_low(y).alias("funding_weight_2y"),
        FN.weight_high(y).alias("funding_weight_5y"),
    )


@register("tenor_labels", _of_parts("tenor_label AS period_label"))
def q_tenor_labels(spark, sf_dir):
    return _part_tenors(spark, sf_dir).select("p_partkey", "period_years", FN.tenor_label("period_years").alias("period_label"))


@register("market_buckets", _of_parts("scb_bucket"))
def q_market_buckets(spark, sf_dir):
    return _part_tenors(spark, sf_dir).select("p_partkey", "period_years", FN.market_bucket("period_years").alias("scb_bucket"))


@register(
    "part_funding_curve",
    O.with_ctes(
        ["market"],
        f"SELECT p_partkey, period_years, {', '.join(FN.COMPONENT_COLUMNS)} FROM priced",
        extra=[f"\nparts AS ({_PART_YEARS})", O.tenor_cte("parts"), O.priced_cte("parts")],
    ),
)
def q_part_funding_curve(spark, sf_dir):
    """Funding components for every part tenor against the latest complete market."""
    f = M.funding_components(_part_tenors(spark, sf_dir), M.latest_market(daily(spark, sf_dir)))
    return f.select("p_partkey", "period_years", *FN.COMPONENT_COLUMNS)


# ---- market comparison and marts ---------------------------------------------------------


@register(
    "scb_by_bucket",
    O.with_ctes(["scb_buckets"], "SELECT * FROM scb_buckets"),
)
def q_scb_by_bucket(spark, sf_dir):
    return M.scb_by_bucket(latest_market_avg(spark, sf_dir))


_BM_SQL = O.with_ctes(["latest_bank", "market"], O.bank_margin_select(), extra=[O.tenor_cte("latest_bank"), O.priced_cte("latest_bank")])


@register("bank_margin", _BM_SQL)
def q_bank_margin(spark, sf_dir):
    return M.bank_margin(daily(spark, sf_dir), latest_listed(spark, sf_dir))


_BVM_SQL = O.with_ctes(
    ["latest_bank", "market", "scb_buckets"], O.bank_vs_market_select(), extra=[O.tenor_cte("latest_bank"), O.priced_cte("latest_bank")]
)


@register("bank_vs_market", _BVM_SQL)
def q_bank_vs_market(spark, sf_dir):
    return M.bank_vs_market(daily(spark, sf_dir), latest_listed(spark, sf_dir), latest_market_avg(spark, sf_dir))
