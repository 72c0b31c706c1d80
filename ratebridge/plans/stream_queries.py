"""Registered landing queries: write driver-table rows as files, scan or stream them back.

Each call works in a fresh folder under the session's checkpoint directory
(shared storage on a cluster), runs the stream with ``availableNow`` to
completion and returns the stored result, which must equal the batch answer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge import schemas as S
from ratebridge.operators.topk import desc
from ratebridge.plans import oracle as O
from ratebridge.plans.environment import build_environment
from ratebridge.plans.generic_queries import EVENTS_AS_OF, LOOKBACK_DAYS
from ratebridge.plans.registry import register
from ratebridge.plans import staging as ST
from ratebridge.plans.staging import DELIVERED, RATE_KEYS, rate_order, typed_rates
from ratebridge.session import scratch_path
from ratebridge.sources.catalog import Namespace
from ratebridge.sources.fixtures import bank_listed_rates_raw, scb_mortgage_rates_raw, se_rates_raw, table
from ratebridge.sources.published import PublishedTable
from ratebridge.sources.raw import ddl_columns, read_source
from ratebridge.sources.sinks import DAY, MONTH, nest_periods, write_periods
from ratebridge.streaming import incremental as X

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


def _table_name(name: str) -> str:
    """A table of this call alone."""
    return f"{name}_{uuid.uuid4().hex}"


def _workdir(spark, name: str) -> str:
    return scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")


@register("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def q_stream_dedup(spark, sf_dir):
    """Events landed twice (a full load, then a re-delivery of the look-back
    window) and de-duplicated by event id within a watermark."""
    base = _workdir(spark, "dedup")
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )
    ev.write.json(f"{base}/landing/load=0")
    start = F.lit(EVENTS_AS_OF).cast("timestamp") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    ev.where(F.col("ts") >= start).write.json(f"{base}/landing/load=1")
    X.use_rocksdb_state(spark)
    stream = X.landed_stream(spark, f"{base}/landing", EVENTS_SCHEMA)
    deduped = X.dedup_stream(stream, ["event_id"], F.col("ts"), f"{LOOKBACK_DAYS} days")
    X.run_available(deduped, f"{base}/checkpoint", sink_path=f"{base}/out")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type", "value")


#: One event in so many is withheld from the first load, if it is that many days older than the newest.
_WITHHELD, _BACK_FILL_DAYS = 40, 15
_LATE_SQL = f"""event_id % {_WITHHELD} = 0 AND CAST(ts AS TIMESTAMP) < (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL {_BACK_FILL_DAYS} DAYS"""


@register("stream_first_copies", f"SELECT event_id, user_id, event_type, value, {_LATE_SQL} AS late FROM events")
def q_stream_first_copies(spark, sf_dir):
    """Events landed in three loads, each streamed when it has landed: most, then the look-back window
    again, then a back-fill of older events that are seen for the first time. All are kept, those of
    the back-fill as late."""
    base = _workdir(spark, "first-copies")
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    newest = ev.agg(F.max("ts")).first()[0]
    withheld = (F.col("event_id") % _WITHHELD == 0) & (F.col("ts") < F.lit(newest) - F.expr(f"INTERVAL {_BACK_FILL_DAYS} DAYS"))
    again = F.col("ts") >= F.lit(EVENTS_AS_OF).cast("timestamp") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    columns = "event_id long, ts timestamp, user_id long, event_type string, value double, late boolean, day string"
    kept = PublishedTable(spark, _table_name("first_copies"), f"{base}/kept", columns, ("day",)).create()
    for load, part in enumerate((~withheld, again & ~withheld, withheld)):
        ev.where(part).write.json(f"{base}/landing/load={load}")
        stream = X.landed_stream(spark, f"{base}/landing", EVENTS_SCHEMA).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
        X.run_available(stream, f"{base}/checkpoint", foreach_batch=X.first_copies(kept, ["event_id"], "ts", LOOKBACK_DAYS))
    return kept.read().select("event_id", "user_id", "event_type", "value", "late")


_LATEST_ORDERS_SQL = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                                                            o_orderkey DESC NULLS LAST) AS rn
  FROM orders) r
WHERE rn = 1"""


@register("stream_latest_orders", _LATEST_ORDERS_SQL)
def q_stream_latest_orders(spark, sf_dir):
    """Orders landed per year and streamed two files at a time; a bucketed
    state table keeps the latest order per customer across micro-batches."""
    base = _workdir(spark, "latest")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderstatus"
    )
    o.withColumn("yr", F.year("o_orderdate")).repartition("yr").write.partitionBy("yr").json(f"{base}/landing")
    stream = X.landed_stream(spark, f"{base}/landing", ORDERS_SCHEMA, max_files_per_trigger=2)
    columns = "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double, o_orderstatus string, state_bucket int"
    state = PublishedTable(spark, _table_name("latest_orders"), f"{base}/state", columns, ("state_bucket",)).create()
    merge = X.latest_state(state, ["o_custkey"], desc("o_orderdate", "o_orderkey"), buckets=16)
    X.run_available(stream, f"{base}/checkpoint", foreach_batch=merge)
    return state.read().select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"
    )


@register(
    "stream_stage_rates",
    O.with_ctes(["stg_se_rates"], "SELECT rate_date, series_id, series_name, category, "
                "CAST(value AS DOUBLE) AS value FROM stg_se_rates"),
)
def q_stream_stage_rates(spark, sf_dir):
    """Rate observations landed as a full load, in which the last year has other
    values (lower or higher by series), plus a re-delivery of that year, streamed
    a few files per batch and merged by (date, series) into a month-partitioned
    staged table, newest delivery first: equals the batch staging."""
    base = _workdir(spark, "rates")
    raw = se_rates_raw(spark, sf_dir)
    revised = F.col("rate_date") >= "2000-08-01"
    change = F.when(F.crc32("series_id") % 2 == 0, 0.25).otherwise(-0.25)
    earlier = raw.withColumn("value", F.when(revised, F.col("value") + change).otherwise(F.col("value")))
    earlier.withColumn(DELIVERED, F.lit("2001-07-01 06:00:00")).repartition(8).write.json(f"{base}/landing/load=0")
    again = raw.where(revised).withColumn(DELIVERED, F.lit("2001-08-01 06:00:00"))
    again.repartition(4).write.json(f"{base}/landing/load=1")
    return staged_stream(spark, base, _table_name("staged_rates")).select(
        "rate_date", "series_id", "series_name", "category", F.col("value").cast("double").alias("value")
    )


def staged_stream(spark, base, name):
    """Streams what has landed under ``base`` since the last call into its staged table, and reads that."""
    schema = T.StructType([*S.SE_RATES_RAW, T.StructField(DELIVERED, T.TimestampType())])
    stream = X.landed_stream(spark, f"{base}/landing", schema, max_files_per_trigger=6)
    typed = typed_rates(stream, keep=(DELIVERED,)).withColumn("month", F.date_format("rate_date", "yyyy-MM"))
    staged = PublishedTable(spark, name, f"{base}/staged", ddl_columns(typed.schema), ("month",)).create()
    X.run_available(typed, f"{base}/checkpoint", foreach_batch=X.merge_by_key(staged, RATE_KEYS, rate_order()))
    return staged.read()


# ---- batch: landed JSON Lines -> declared-schema scan -> staging ----------------------------


@register("landed_stage_rates", O.with_ctes(["stg_se_rates"], "SELECT rate_date, series_id, series_name, category, "
                                           "CAST(value AS DOUBLE) AS value FROM stg_se_rates"))
def q_landed_stage_rates(spark, sf_dir):
    """Rates landed one folder per day (``year=/month=/day=``), read back recursively."""
    base = _workdir(spark, "landed-rates")
    write_periods(se_rates_raw(spark, sf_dir), base, F.col("rate_date"), DAY)
    raw = read_source(spark, "se_rates_raw", base, layout="nested")
    return ST.stage_rates(raw).select("rate_date", "series_id", "series_name", "category",
                                      F.col("value").cast("double").alias("value"))


@register("landed_stage_bank", O.with_ctes(["stg_bank"], "SELECT * FROM stg_bank"))
def q_landed_stage_bank(spark, sf_dir):
    """Bank scrapes landed per scrape day and read with partition discovery."""
    base = _workdir(spark, "landed-bank")
    write_periods(bank_listed_rates_raw(spark, sf_dir), base, F.col("scraped_at"), DAY)
    raw = read_source(spark, "bank_listed_rates_raw", base, layout="hive").drop("year", "month", "day")
    return ST.stage_bank(raw)


@register("landed_stage_scb", O.with_ctes(["stg_scb"], "SELECT * FROM stg_scb"))
def q_landed_stage_scb(spark, sf_dir):
    """Market averages landed per month; a month filter prunes folders, not rows."""
    base = _workdir(spark, "landed-scb")
    write_periods(scb_mortgage_rates_raw(spark, sf_dir), base, F.col("period_month"), MONTH)
    raw = read_source(spark, "scb_mortgage_rates_raw", base, layout="hive").drop("year", "month")
    return ST.stage_scb(raw)


# ---- batch: the collectors' own folders, read by period --------------------------------------

_PERIOD = ("1997-11-01", "1999-02-01")


@register("period_scan", O.with_ctes(["stg_se_rates"], f"""SELECT rate_date, series_id, series_name, category,
CAST(value AS DOUBLE) AS value FROM stg_se_rates WHERE rate_date BETWEEN DATE '{_PERIOD[0]}' AND DATE '{_PERIOD[1]}'"""))
def q_period_scan(spark, sf_dir):
    """Rates landed as ``YYYY/MM/DD`` folders, of which only those of a range are listed and read;
    codes and names come with white space around them."""
    base = _workdir(spark, "nested-rates")
    padded = {c: F.concat(F.lit("\t "), F.col(c), F.lit(" \r\n")) for c in ("series_id", "series_name", "category")}
    nest_periods(se_rates_raw(spark, sf_dir).withColumns(padded), base, F.col("rate_date"), DAY)
    raw = read_source(spark, "se_rates_raw", base, between=_PERIOD)
    return ST.stage_rates(raw).select("rate_date", "series_id", "series_name", "category", F.col("value").cast("double").alias("value"))


def _ci_sql() -> str:
    """The oracle chain of latest listed rates, once over all raw rows and once over those below a rate."""
    chain = [O.RAW["bank_listed_rates_raw"], O.MODELS["stg_bank"], O.MODELS["latest_bank"]]
    short = [m.replace("stg_bank", "stg_bank_ci").replace("latest_bank AS", "latest_bank_ci AS").replace("list_rate IS NOT NULL", f"list_rate < {_CI_BELOW}")
             for m in chain[1:]]
    return "WITH " + ",".join([*chain, *short]) + "\nSELECT 'prod' AS env, * FROM latest_bank UNION ALL SELECT 'ci' AS env, * FROM latest_bank_ci"


#: The environment of the trial run holds listed rates below this only.
_CI_BELOW = 4.0


@register("environments_apart", _ci_sql())
def q_environments_apart(spark, sf_dir):
    """Two environments in one session, each with raw tables, views and marts over its own landing folders."""
    base, run = _workdir(spark, "environments"), uuid.uuid4().hex
    listed = bank_listed_rates_raw(spark, sf_dir)
    shared = {"se_rates_raw": se_rates_raw(spark, sf_dir), "scb_mortgage_rates_raw": scb_mortgage_rates_raw(spark, sf_dir)}
    for name, rows in shared.items():
        rows.write.json(f"{base}/{name}")
    out = []
    for env, rows in (("prod", listed), ("ci", listed.where(F.col("list_rate") < _CI_BELOW))):
        rows.write.json(f"{base}/{env}/bank_listed_rates_raw")
        places = {**{name: f"{base}/{name}" for name in shared}, "bank_listed_rates_raw": f"{base}/{env}/bank_listed_rates_raw"}
        ns = Namespace(env=env, run_id=run, base=f"rates_{run[:12]}")
        build_environment(spark, ns, places, O.AS_OF)
        out.append(spark.table(ns.table("intermediate", "int_latest_bank_listed_rates")).select(F.lit(env).alias("env"), "*"))
    return out[0].unionByName(out[1])
