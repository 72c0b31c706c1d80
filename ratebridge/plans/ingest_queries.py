"""Registered ingestion jobs: gated publishing of scrapes, and a run of batches under a ledger."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.operators.gates import GateError, require_members, require_rows
from ratebridge.plans import oracle as O
from ratebridge.plans.registry import register
from ratebridge.plans.staging import DELIVERED, RATE_KEYS, rate_order, typed_rates
from ratebridge.session import scratch_path
from ratebridge.sources.fixtures import bank_listed_rates_raw, se_rates_raw
from ratebridge.sources.published import PublishedTable
from ratebridge.sources.raw import ddl_columns
from ratebridge.streaming.ledger import Ledger, ingest_range

#: What every scrape must hold before it is published.
SCRAPE_AUDITS = (partial(require_rows, what="scrape"), partial(require_members, col="bank", required=S.REQUIRED_BANKS))


def scrape_table(spark, name: str, path: str) -> PublishedTable:
    """Listed rates, replaced by month of scrape."""
    columns = ddl_columns(S.BANK_LISTED_RATES_RAW) + ", month STRING"
    return PublishedTable(spark, name, path, columns, ("month",)).create()


def publish_scrapes(table: PublishedTable, rows, batch_id: int) -> str:
    """Written, audited, published: 'published', 'refused' with the reason, or 'known'."""
    dated = rows.withColumn("month", F.substring("scraped_at", 1, 7))
    try:
        return "published" if table.replace(dated, batch_id, SCRAPE_AUDITS) else "known"
    except GateError as refused:
        return f"refused: {refused}"


_COLUMNS = [f.name for f in S.BANK_LISTED_RATES_RAW]
#: The month of scrapes that is delivered again.
AGAIN = "1998-07"
_SCRAPES = O.with_ctes(["bank_listed_rates_raw"], f"""
SELECT {", ".join("list_rate + 0.5 AS list_rate" if c == "list_rate" else c for c in _COLUMNS)}, substr(scraped_at, 1, 7) AS month
FROM bank_listed_rates_raw WHERE substr(scraped_at, 1, 7) = '{AGAIN}'
UNION ALL
SELECT {", ".join(_COLUMNS)}, substr(scraped_at, 1, 7) AS month FROM bank_listed_rates_raw WHERE substr(scraped_at, 1, 7) <> '{AGAIN}'""")


def _scrape_run(spark, sf_dir):
    """The table after five deliveries, and what became of each."""
    raw = bank_listed_rates_raw(spark, sf_dir).where("scraped_at IS NOT NULL")
    month = raw.where(F.substring("scraped_at", 1, 7) == AGAIN)
    table = scrape_table(spark, f"scrapes_{uuid.uuid4().hex}", scratch_path(spark, "ingest", uuid.uuid4().hex))
    one_bank_short = month.where(F.col("bank") != S.REQUIRED_BANKS[0]).withColumn("list_rate", F.lit(99.0))
    deliveries = [raw, one_bank_short, month.limit(0), month.withColumn("list_rate", F.col("list_rate") + 0.5), month]
    return table, [publish_scrapes(table, rows, number) for rows, number in zip(deliveries, (1, 2, 3, 4, 4), strict=True)]


@register("gated_scrapes", _SCRAPES)
def q_gated_scrapes(spark, sf_dir):
    """All scrapes; then for one month a delivery without a required bank and an empty one, both refused,
    a complete one, which replaces the month, and that batch number again, which changes nothing."""
    return _scrape_run(spark, sf_dir)[0].read()


@register("gated_scrape_outcomes", f"""
SELECT * FROM (VALUES (1, 'published'), (2, 'refused: missing required bank values: {S.REQUIRED_BANKS[0]}'),
                      (3, 'refused: no rows in scrape'), (4, 'published'), (5, 'known')) AS t(delivery, outcome)""")
def q_gated_scrape_outcomes(spark, sf_dir):
    """What became of each delivery of ``gated_scrapes``."""
    outcomes = _scrape_run(spark, sf_dir)[1]
    return spark.createDataFrame(list(enumerate(outcomes, 1)), "delivery int, outcome string")


# --- batches of rates under a ledger ------------------------------------------------------

START = "1995-01-01"
#: Day of each run, and the series that the run's source fails to deliver.
RUNS = [("1996-01-01", None), ("1997-06-01", "SEGVB5YC"), ("1997-06-02", None), ("1999-01-01", None), ("1999-01-01", None), ("2002-01-01", "SECBREPOEFF")]


def _expected_ledger() -> str:
    rows, start, batch = [], START, 0
    for day, lacking in RUNS:
        if start >= day:
            continue
        batch += 1
        rows.append(f"({batch}, '{start}', '{day}', '{lacking or ''}')")
        start = start if lacking else day
    return ", ".join(rows)


_LEDGER = O.with_ctes(["se_rates_raw"], f"""
, runs AS (SELECT * FROM (VALUES {_expected_ledger()}) AS r(batch, from_date, to_date, lacking)),
required AS (SELECT unnest([{", ".join(f"'{s}'" for s in S.SERIES_IDS)}]) AS series_id),
present AS (
  SELECT DISTINCT batch, series_id FROM runs JOIN se_rates_raw ON rate_date >= from_date AND rate_date <= to_date AND series_id <> lacking)
SELECT 'rates' AS source, CAST(runs.batch AS BIGINT) AS batch, from_date, to_date,
       CASE WHEN count(CASE WHEN p.series_id IS NULL THEN 1 END) = 0 THEN 'complete' ELSE 'incomplete' END AS status,
       coalesce(string_agg(CASE WHEN p.series_id IS NULL THEN required.series_id END, ',' ORDER BY required.series_id), '') AS missing
FROM runs CROSS JOIN required LEFT JOIN present p ON p.batch = runs.batch AND p.series_id = required.series_id
GROUP BY runs.batch, from_date, to_date""")


def _ledger_run(spark, sf_dir):
    """(ledger, rates) after the runs of ``RUNS``."""
    base = scratch_path(spark, "ingest", uuid.uuid4().hex)
    raw = se_rates_raw(spark, sf_dir)
    typed = lambda rows, batch: typed_rates(rows.withColumn(DELIVERED, F.timestamp_seconds(F.lit(batch))), keep=(DELIVERED,)).withColumn("year", F.year("rate_date"))
    rates = PublishedTable(spark, f"rates_{uuid.uuid4().hex}", f"{base}/rates", ddl_columns(typed(raw, 0).schema), ("year",)).create()
    ledger = Ledger(spark, f"{base}/ledger")
    for day, lacking in RUNS:
        def fetch(start, end, lacking=lacking):
            return raw.where(F.col("rate_date").between(start, end) & ~F.col("series_id").eqNullSafe(F.lit(lacking)))

        def publish(rows, batch):
            return rates.merge(typed(rows, batch), batch, RATE_KEYS, rate_order())

        ingest_range(ledger, "rates", START, day, fetch, publish, S.SERIES_IDS, "series_id")
    return ledger, rates


@register("ingest_ledger", _LEDGER)
def q_ingest_ledger(spark, sf_dir):
    """Runs of the rates source: two lack a series, so the mark stays and the next run starts where the
    incomplete one did; a run on a day already reached fetches nothing."""
    return _ledger_run(spark, sf_dir)[0].read().withColumn("missing", F.array_join("missing", ","))


_LEDGER_RATES = O.with_ctes(["stg_se_rates"], f"""
SELECT rate_date, series_id, series_name, category, CAST(value AS DOUBLE) AS value FROM stg_se_rates
WHERE rate_date >= DATE '{START}' AND rate_date <= DATE '{RUNS[-1][0]}'
  AND (series_id <> '{RUNS[-1][1]}' OR rate_date <= DATE '1999-01-01')""")


@register("ingest_ledger_rates", _LEDGER_RATES)
def q_ingest_ledger_rates(spark, sf_dir):
    """The rates those runs published: what an incomplete batch lacked came with the next one."""
    rates = _ledger_run(spark, sf_dir)[1].read()
    return rates.select("rate_date", "series_id", "series_name", "category", F.col("value").cast("double").alias("value"))
