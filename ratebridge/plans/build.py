"""The model graph: raw relations -> staging -> latest -> marts, by model name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ratebridge.plans import latest as L
from ratebridge.plans import marts as M
from ratebridge.plans import staging as ST

VIEWS = [
    "stg_se_rates",
    "stg_bank_listed_rates",
    "stg_scb_mortgage_rates",
    "int_latest_bank_listed_rates",
    "int_latest_scb_mortgage_rates",
]
TABLES = ["rates_daily", "bank_margin_analysis", "bank_vs_market_analysis"]


def model_relations(
    raw: Mapping[str, DataFrame], as_of: str | dt.date | None = None, reuse: bool = False
) -> dict[str, DataFrame]:
    """Lazy DataFrames of all eight models (nothing runs until an action).

    With ``reuse`` the relations that feed several models (the three staged
    relations and rates_daily) are persisted (memory, spilling to disk), so a
    job touching many models - e.g. all column checks - computes each once.
    Staged relations are deduplicated, hence much smaller than the raw input.
    """
    stg_rates = ST.stage_rates(raw["se_rates_raw"])
    stg_bank = ST.stage_bank(raw["bank_listed_rates_raw"])
    stg_scb = ST.stage_scb(raw["scb_mortgage_rates_raw"])
    if reuse:
        stg_rates, stg_bank, stg_scb = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (stg_rates, stg_bank, stg_scb))
    lb = L.latest_bank(stg_bank, as_of)
    ls = L.latest_scb(stg_scb, as_of)
    daily = M.rates_daily(stg_rates)
    if reuse:
        daily = daily.persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "stg_se_rates": stg_rates,
        "stg_bank_listed_rates": stg_bank,
        "stg_scb_mortgage_rates": stg_scb,
        "int_latest_bank_listed_rates": lb,
        "int_latest_scb_mortgage_rates": ls,
        "rates_daily": daily,
        "bank_margin_analysis": M.bank_margin(daily, lb),
        "bank_vs_market_analysis": M.bank_vs_market(daily, lb, ls),
    }


# Table and column descriptions stored with the marts.
DOCS: dict[str, tuple[str, dict[str, str]]] = {
    "rates_daily": (
        "Every series of a day side by side; the spreads compare mortgage-bond with government-bond yields of one tenor.",
        {
            "spread_2y": "Mortgage-bond yield less government-bond yield, two years.",
            "spread_5y": "Mortgage-bond yield less government-bond yield, five years.",
            "stibor_policy_spread_3m": "How far the three-month interbank rate lies above the policy rate.",
            "swestr_policy_spread_3m": "How far the three-month compounded overnight rate lies above the policy rate.",
        },
    ),
    "bank_margin_analysis": (
        "The newest listed rate of each bank and tenor, a modelled funding proxy for it, and what is left.",
        {
            "funding_cost": "Modelled from market rates, in percent; no bank's own figure.",
            "gross_margin": "Listed rate less modelled funding cost, in percentage points.",
        },
    ),
    "bank_vs_market_analysis": (
        "Listed rates beside the average rates of new and outstanding loans of the tenor.",
        {"effective_margin_new": "Average rate of new loans less modelled funding cost, in percentage points."},
    ),
}


def build_models(
    spark,
    raw: Mapping[str, DataFrame],
    ns,
    as_of: str | dt.date | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Materialise the model graph: staging and intermediate models as views,
    marts as tables (full rebuild). ``rates_daily`` is written first and read
    back, so both marts start from the stored table instead of recomputing the
    staging chain; descriptions are stored in the catalog."""
    from ratebridge.sources.catalog import as_table, as_view, persist_docs

    ns.create(spark)
    rels = model_relations(raw, as_of)
    for name in VIEWS:
        as_view(rels[name], name)
    daily = as_table(rels["rates_daily"], ns, "marts", "rates_daily", fmt)
    lb, ls = rels["int_latest_bank_listed_rates"], rels["int_latest_scb_mortgage_rates"]
    out = {name: spark.table(name) for name in VIEWS}
    out["rates_daily"] = daily
    out["bank_margin_analysis"] = as_table(M.bank_margin(daily, lb), ns, "marts", "bank_margin_analysis", fmt)
    out["bank_vs_market_analysis"] = as_table(
        M.bank_vs_market(daily, lb, ls), ns, "marts", "bank_vs_market_analysis", fmt
    )
    for name, (text, cols) in DOCS.items():
        persist_docs(spark, ns.table("marts", name), text, cols)
    return out


def build_counted(spark, raw: Mapping[str, DataFrame], ns, checks, as_of: str | dt.date | None = None, fmt: str = "parquet"):
    """(models, results of ``checks``): every model stored as a table, each built from the stored ones before
    it and counted while it is written, so that neither a model nor a check is computed twice."""
    from ratebridge.operators.quality import CountedWrites
    from ratebridge.sources.catalog import as_table

    ns.create(spark)
    writes, out = CountedWrites(spark, checks), {}

    def store(layer: str, name: str, df: DataFrame) -> DataFrame:
        out[name] = as_table(writes.counted(name, df), ns, layer, name, fmt)
        return out[name]

    rates = store("staging", "stg_se_rates", ST.stage_rates(raw["se_rates_raw"]))
    bank = store("staging", "stg_bank_listed_rates", ST.stage_bank(raw["bank_listed_rates_raw"]))
    scb = store("staging", "stg_scb_mortgage_rates", ST.stage_scb(raw["scb_mortgage_rates_raw"]))
    latest_bank = store("intermediate", "int_latest_bank_listed_rates", L.latest_bank(bank, as_of))
    latest_scb = store("intermediate", "int_latest_scb_mortgage_rates", L.latest_scb(scb, as_of))
    daily = store("marts", "rates_daily", M.rates_daily(rates))
    store("marts", "bank_margin_analysis", M.bank_margin(daily, latest_bank))
    store("marts", "bank_vs_market_analysis", M.bank_vs_market(daily, latest_bank, latest_scb))
    return out, writes.results()
