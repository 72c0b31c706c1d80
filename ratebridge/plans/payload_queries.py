"""Registered round-trip queries for the payload and HTML extractors.

Adapter rows are rendered into the shapes the sources publish (``landing``),
extracted again, and compared with the rows the oracle derives directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.functions.text import NBSP, parse_rate
from ratebridge.plans import oracle as O
from ratebridge.plans.registry import register
from ratebridge.sources import html_tables as H
from ratebridge.sources import landing as LD
from ratebridge.sources import payloads as P
from ratebridge.sources.fixtures import table

_BANK_OUT = "bank, period_label, period_years, list_rate, avg_rate, valid_from, scraped_at, source"
_SBAB_LABELS = sorted({label for code, _, label in S.BANK_PERIODS if code.startswith("P_")})
_TEXT_LABELS = sorted({label for code, _, label in S.BANK_PERIODS if not code.startswith("P_")})
# One scraped page / offer list: (day, key block).
_PAGE = f"substr(scraped_at, 1, 10), src_key // {LD.PAGE_BLOCK}"


def _in(values) -> str:
    return "(" + ", ".join(O._q(v) for v in values) + ")"


@register(
    "observations_roundtrip",
    O.with_ctes(["se_rates_raw"], "SELECT rate_date, series_id, series_name, category, value FROM se_rates_raw"),
)
def q_observations_roundtrip(spark, sf_dir):
    """Observation arrays -> one row per observation, with series metadata."""
    return P.extract_observations(LD.observation_bodies(spark, sf_dir))


@register(
    "px_table_roundtrip",
    O.with_ctes(
        ["scb_mortgage_rates_raw"],
        f"""
SELECT period_month, loan_type, loan_type_name, period_code, period_label, rate, fetched_at AS scraped_at
FROM (SELECT *, max(scraped_at) OVER (PARTITION BY src_key // {LD.PX_BLOCK}) AS fetched_at
      FROM scb_mortgage_rates_raw) r
WHERE rate IS NOT NULL AND period_month >= '{LD.PX_FROM_MONTH}'""",
    ),
)
def q_px_table_roundtrip(spark, sf_dir):
    """Statistical tables -> rows; missing cells and months before the bound are skipped."""
    return P.extract_px_table(LD.px_bodies(spark, sf_dir), from_month=LD.PX_FROM_MONTH)


@register(
    "offers_roundtrip",
    O.with_ctes(
        ["bank_listed_rates_raw"],
        f"""
SELECT bank, period_label, period_years, list_rate, CAST(NULL AS DOUBLE) AS avg_rate,
       CASE WHEN src_key % 7 = 0 THEN '' ELSE substr(scraped_at, 1, 10) END AS valid_from,
       fetched_at AS scraped_at, source
FROM (SELECT *, max(scraped_at) OVER (PARTITION BY {_PAGE}) AS fetched_at
      FROM bank_listed_rates_raw WHERE bank = 'SBAB' AND list_rate IS NOT NULL) r
WHERE period_label IN {_in(_SBAB_LABELS)}""",
    ),
)
def q_offers_roundtrip(spark, sf_dir):
    """Offer lists -> bank rows; unknown period codes are dropped."""
    return P.extract_offers_json(LD.offer_bodies(spark, sf_dir))


_MONTHS_SQL = "[" + ", ".join(O._q(m) for m in LD.MONTHS_SV) + "]"

_HTML_SQL = O.with_ctes(
    ["bank_listed_rates_raw"],
    f"""
SELECT {_BANK_OUT} FROM (
  SELECT bank, period_label, period_years, list_rate, CAST(NULL AS DOUBLE) AS avg_rate,
         coalesce(last_value(CASE WHEN src_key % 5 = 0 THEN substr(scraped_at, 1, 10) END IGNORE NULLS)
                  OVER (PARTITION BY {_PAGE} ORDER BY src_key
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS valid_from,
         max(scraped_at) OVER (PARTITION BY {_PAGE}) AS scraped_at, source
  FROM bank_listed_rates_raw WHERE bank = 'Nordea') n
WHERE list_rate IS NOT NULL AND period_label IN {_in(_TEXT_LABELS)}
UNION ALL
SELECT bank, period_label, period_years, list_rate, avg_rate,
       CAST(day(d) AS VARCHAR) || ' ' || {_MONTHS_SQL}[month(d)] || ' ' || CAST(year(d) AS VARCHAR) AS valid_from,
       fetched_at AS scraped_at, source
FROM (SELECT *, CAST(substr(scraped_at, 1, 10) AS DATE) AS d,
             max(scraped_at) OVER (PARTITION BY {_PAGE}) AS fetched_at
      FROM bank_listed_rates_raw WHERE bank = 'Swedbank') s
WHERE list_rate IS NOT NULL AND period_label IN {_in(_TEXT_LABELS)}""",
)


@register("html_table_roundtrip", _HTML_SQL)
def q_html_table_roundtrip(spark, sf_dir):
    """Bank pages (plain and sectioned tables) -> bank rows."""
    return H.extract_bank_pages(LD.bank_pages(spark, sf_dir))


@register(
    "parse_rate_strings",
    "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS rate FROM part",
)
def q_parse_rate_strings(spark, sf_dir):
    """Rate texts with decimal commas, percent signs, no-break and plain spaces, junk."""
    price = F.col("p_retailprice").cast("string")
    text = (
        F.when(F.col("p_size") % 7 == 0, F.lit("n/a"))
        .when(F.col("p_size") % 2 == 0, F.concat(F.replace(price, F.lit("."), F.lit(",")), F.lit(NBSP + "%")))
        .otherwise(F.concat(F.lit(" "), price, F.lit(" %")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", parse_rate(text).alias("rate"))
