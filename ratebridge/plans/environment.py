"""An environment: raw tables over landing folders, stored views, mart tables, functions and descriptions.

Staging and latest-row models are views in the environment's databases, written in SQL,
so other sessions and tools read them by name and two environments never meet. A view
holds no rows: it sees what has landed when it is read, and ages count to that day
unless the environment was built as of a fixed one. Marts are tables built from the views.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ratebridge import schemas as S
from ratebridge.plans import marts as M
from ratebridge.plans.build import DOCS
from ratebridge.plans.staging import BLANKS
from ratebridge.session import ensure_checkpoint_dir
from ratebridge.sources.catalog import Namespace, as_table, persist_docs, sql_text
from ratebridge.sources.raw import ensure_raw_tables


@dataclass(frozen=True)
class View:
    """One row a key: of the rows of ``source`` the first in ``order``, then the ``added`` columns.

    ``least`` names the first column of a rising order: rows alike in all others are first reduced to the
    smallest of it, so that heavily repeated rows are aggregated as they are read, and not sorted.
    """

    layer: str
    source: tuple[str, str]
    columns: Mapping[str, str]
    where: str
    keys: Sequence[str]
    order: Sequence[str]
    dropped: Sequence[str] = ()
    least: str | None = None
    added: Mapping[str, str] | None = None
    description: str = ""
    texts: Mapping[str, str] | None = None


def _rising(*columns: str) -> list[str]:
    return [f"{c} ASC NULLS LAST" for c in columns]


def _falling(*columns: str) -> list[str]:
    return [f"{c} DESC NULLS LAST" for c in columns]


def _same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


def _age(column: str, name: str, limits: tuple[int, int]) -> dict[str, str]:
    days = f"datediff({{as_of}}, {column})"
    return {f"{name}_age_days": days, f"{name}_freshness": f"{{freshness}}({days}, {limits[0]}, {limits[1]})"}


def _trimmed(column: str) -> str:
    return f"btrim({column}, {sql_text(BLANKS)})"


_BANK = ("scrape_date", "bank", "period_label", "period_years", "list_rate", "avg_rate", "valid_from", "scraped_at", "source")
_SCB = ("period_month", "period_date", "loan_type", "loan_type_name", "period_code", "period_label", "rate")

VIEWS: dict[str, View] = {
    "stg_se_rates": View(
        "staging", ("raw", "se_rates_raw"),
        {"rate_date": "CAST(rate_date AS DATE)", **{c: _trimmed(c) for c in ("series_id", "series_name", "category")}, "value": "CAST(value AS DECIMAL(10, 4))"},
        "rate_date IS NOT NULL AND series_id IS NOT NULL AND value IS NOT NULL",
        ("rate_date", "series_id"), _rising("value", "series_name", "category"), least="value",
        description="Rate observations with proper types, one a series and day, however often they were delivered.",
        texts={"rate_date": "Day observed.", "series_id": "Code of the series at its source.", "value": "Percent."},
    ),
    "stg_bank_listed_rates": View(
        "staging", ("raw", "bank_listed_rates_raw"),
        {"scrape_date": "to_date(substr(scraped_at, 1, 10), 'yyyy-MM-dd')", **_same("bank", "period_label"),
         **{c: f"CAST({c} AS DOUBLE)" for c in ("period_years", "list_rate", "avg_rate")}, **_same("valid_from", "scraped_at", "source")},
        "list_rate IS NOT NULL", ("scrape_date", "bank", "period_label"),
        _rising("scraped_at", "period_years", "list_rate", "avg_rate", "valid_from", "source"),
        description="Listed mortgage rates, the first scrape of a day for each bank and fixing period.",
        texts={"list_rate": "Percent, before any discount.", "period_label": "Fixing period as the bank names it."},
    ),
    "stg_scb_mortgage_rates": View(
        "staging", ("raw", "scb_mortgage_rates_raw"),
        {**_same("period_month"), "period_date": "to_date(concat(period_month, '-01'), 'yyyy-MM-dd')",
         **_same("loan_type", "loan_type_name", "period_code", "period_label"), "rate": "CAST(rate AS DOUBLE)", **_same("scraped_at")},
        "rate IS NOT NULL", ("period_month", "loan_type", "period_code"),
        [*_falling("scraped_at"), *_rising("rate", "loan_type_name", "period_label")], dropped=("scraped_at",),
        description="Monthly average rates paid, the newest revision for each kind of loan and fixing period.",
        texts={"period_date": "First day of the month.", "loan_type": "New or outstanding loans, by code."},
    ),
    "int_latest_bank_listed_rates": View(
        "intermediate", ("staging", "stg_bank_listed_rates"), _same(*_BANK), "true", ("bank", "period_label"),
        [*_falling("scrape_date", "scraped_at"), *_rising("period_years", "list_rate", "avg_rate", "valid_from", "source")],
        added=_age("scrape_date", "listed_rate", S.LISTED_RATE_FRESHNESS),
        description="The newest listed rate of each bank and fixing period, also where a bank has fallen behind.",
        texts={"listed_rate_age_days": "Days since it was scraped.", "listed_rate_freshness": "fresh, aging or stale, by age."},
    ),
    "int_latest_scb_mortgage_rates": View(
        "intermediate", ("staging", "stg_scb_mortgage_rates"), _same(*_SCB), "true", ("loan_type", "period_label"),
        [*_falling("period_date"), *_rising("period_code", "rate", "loan_type_name", "period_month")],
        added=_age("period_date", "scb_rate", S.SCB_RATE_FRESHNESS),
        description="The newest average rate of each kind of loan and fixing period.",
        texts={"scb_rate_age_days": "Days since the month began.", "scb_rate_freshness": "fresh, aging or stale, by age."},
    ),
}


def create_functions(spark: SparkSession, ns: Namespace) -> None:
    """SQL functions of the models, in the environment's database."""
    levels = [sql_text(level) for level in S.FRESHNESS_LEVELS]
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {ns.table('intermediate', 'freshness')}(age INT, fresh_to INT, aging_to INT) RETURNS STRING "
        f"COMMENT 'Level of an age in days; of no age the last.' "
        f"RETURN CASE WHEN age <= fresh_to THEN {levels[0]} WHEN age <= aging_to THEN {levels[1]} ELSE {levels[2]} END"
    )


def view_sql(ns: Namespace, view: View, as_of: str | dt.date | None = None) -> str:
    """The query of a view in that environment."""
    names = {"as_of": f"DATE '{as_of}'" if as_of else "current_date()", "freshness": ns.table("intermediate", "freshness")}
    inner = ", ".join(f"{text} AS {name}" for name, text in view.columns.items())
    outer = [*(c for c in view.columns if c not in view.dropped), *(f"{text.format(**names)} AS {name}" for name, text in (view.added or {}).items())]
    rows = f"SELECT {inner} FROM {ns.table(*view.source)} WHERE {view.where}"
    if view.least:
        rest = ", ".join(c for c in view.columns if c != view.least)
        rows = f"SELECT {rest}, min({view.least}) AS {view.least} FROM ({rows}) GROUP BY {rest}"
    return (
        f"SELECT {', '.join(outer)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(view.keys)} ORDER BY {', '.join(view.order)}) AS place "
        f"FROM ({rows})) WHERE place = 1"
    )


def create_views(spark: SparkSession, ns: Namespace, as_of: str | dt.date | None = None) -> dict[str, DataFrame]:
    """Staging and latest-row views of the environment, with descriptions; by name."""
    create_functions(spark, ns)
    for name, view in VIEWS.items():
        columns = [c for c in view.columns if c not in view.dropped] + list(view.added or {})
        listed = ", ".join(f"`{c}` COMMENT {sql_text(view.texts[c])}" if c in (view.texts or {}) else f"`{c}`" for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {ns.table(view.layer, name)} ({listed}) COMMENT {sql_text(view.description)} AS {view_sql(ns, view, as_of)}")
    return {name: spark.table(ns.table(view.layer, name)) for name, view in VIEWS.items()}


def build_environment(spark: SparkSession, ns: Namespace, locations: Mapping[str, str], as_of: str | dt.date | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All eight models of an environment over the landing folders ``locations`` (by raw table); by name.

    Latest-row views are read once into the marts that need them.
    """
    ns.create(spark)
    ensure_raw_tables(spark, ns.database("raw"), dict(locations))
    out = create_views(spark, ns, as_of)
    daily = out["rates_daily"] = as_table(M.rates_daily(out["stg_se_rates"]), ns, "marts", "rates_daily", fmt)
    ensure_checkpoint_dir(spark)
    bank, scb = out["int_latest_bank_listed_rates"].checkpoint(), out["int_latest_scb_mortgage_rates"]
    out["bank_margin_analysis"] = as_table(M.bank_margin(daily, bank), ns, "marts", "bank_margin_analysis", fmt)
    out["bank_vs_market_analysis"] = as_table(M.bank_vs_market(daily, bank, scb), ns, "marts", "bank_vs_market_analysis", fmt)
    for name, (text, columns) in DOCS.items():
        persist_docs(spark, ns.table("marts", name), text, columns)
    return out
