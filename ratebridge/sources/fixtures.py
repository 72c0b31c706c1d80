"""Adapters: derive the three raw relations from the shared driver tables.

The engine's real inputs are landed JSON Lines (see ``sources.raw``). For tests
and the benchmark we derive rows of exactly the raw schemas from the TPC-H-like
tables, so every model runs over data that grows with the scale factor:

* ``se_rates_raw`` from ``lineitem``: one observation per line item, dated to
  the first day of its ship month, series chosen by ``l_partkey % 11``; every
  97th order has a NULL value. Many line items share a (date, series), which is
  exactly the "overlapping reloads" the staging dedup must collapse.
* ``bank_listed_rates_raw`` from ``orders``: bank by ``o_orderkey % 3``, tenor
  by ``o_custkey % 14`` (the 11 listed tenors plus three off-grid ones: 0.5,
  1.5 and 2.5 years), scrape time from the order date and ``o_orderkey % 24``.
* ``scb_mortgage_rates_raw`` from ``orders``: month of the order date, loan type
  by ``o_orderkey % 2``, binding code by ``o_custkey % 5``.

All arithmetic is on DOUBLE (``cast(k % n as double) / 100``) so Spark and the
SQL oracle type it identically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.sources.payloads import with_series_meta

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tenors of the bank adapter, indexed by o_custkey % 14.
ADAPTER_TENORS: list[tuple[float, str]] = [
    (0.25, "3M"),
    *[(float(y), f"{y}Y") for y in range(1, 11)],
    (0.5, "6M"),
    (1.5, "18M"),
    (2.5, "30M"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` for a 0-based integer index (a literal array lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def se_rates_raw(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    """``keep_key`` adds ``src_key`` (the line item's order key) for renderers."""
    li = table(spark, sf_dir, "lineitem")
    rate_date = F.trunc(F.col("l_shipdate").cast("date"), "month").cast("string")
    value = F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("double")).otherwise(
        F.col("l_quantity") / 10 + F.col("l_discount")
    )
    obs = li.select(
        rate_date.alias("rate_date"),
        _pick(S.SERIES_IDS, F.col("l_partkey") % 11).alias("series_id"),
        value.alias("value"),
        F.col("l_orderkey").alias("src_key"),
    )
    # 11-entry fixed dimension as literal maps: an expression, no join, no shuffle.
    cols = S.SE_RATES_RAW.fieldNames() + (["src_key"] if keep_key else [])
    return with_series_meta(obs).select(*cols)


def bank_listed_rates_raw(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    tenor = F.col("o_custkey") % 14
    banks = list(S.BANK_SOURCES)
    extra = [k.alias("src_key")] if keep_key else []
    return o.select(
        _pick(banks, k % 3).alias("bank"),
        _pick([t[1] for t in ADAPTER_TENORS], tenor).alias("period_label"),
        _pick([t[0] for t in ADAPTER_TENORS], tenor).alias("period_years"),
        F.when(k % 50 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(2.0) + (k % 400).cast("double") / 100)
        .alias("list_rate"),
        F.when(k % 3 == 2, F.lit(1.5) + (k % 300).cast("double") / 100).alias("avg_rate"),
        F.lit("").alias("valid_from"),
        F.concat(
            F.col("o_orderdate").cast("date").cast("string"),
            F.lit("T"),
            F.lpad((k % 24).cast("string"), 2, "0"),
            F.lit(":00:00+00:00"),
        ).alias("scraped_at"),
        _pick([S.BANK_SOURCES[b] for b in banks], k % 3).alias("source"),
        *extra,
    )


def scb_mortgage_rates_raw(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    extra = [k.alias("src_key")] if keep_key else []
    code = F.col("o_custkey") % 5
    loan_type = F.when(k % 2 == 0, F.lit(S.NEW_LOANS)).otherwise(F.lit(S.OUTSTANDING_LOANS))
    loan_names = F.create_map(*[F.lit(x) for pair in S.SCB_LOAN_TYPES for x in pair])
    return o.select(
        F.substring(F.col("o_orderdate").cast("date").cast("string"), 1, 7).alias("period_month"),
        loan_type.alias("loan_type"),
        F.coalesce(loan_names[loan_type], loan_type).alias("loan_type_name"),
        _pick([c for c, _, _ in S.SCB_PERIODS], code).alias("period_code"),
        _pick([label for _, label, _ in S.SCB_PERIODS], code).alias("period_label"),
        F.when(k % 40 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(1.0) + (k % 500).cast("double") / 100)
        .alias("rate"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T00:00:00+00:00")).alias("scraped_at"),
        *extra,
    )


RAW_ADAPTERS = {
    "se_rates_raw": se_rates_raw,
    "bank_listed_rates_raw": bank_listed_rates_raw,
    "scb_mortgage_rates_raw": scb_mortgage_rates_raw,
}


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW_ADAPTERS.items()}
