"""The engine's generic operators applied to the driver tables directly.

These run the same operators the rate models use (top-1 dedup, latest per key,
conditional pivot, freshness, worst-of roll-up, member gates, forward fill,
look-back) on relations that are large and keyed differently, so each operator
is checked on data with many groups and realistic skew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.functions.dates import lookback_start
from ratebridge.operators.gates import missing_members
from ratebridge.operators.graph import reachable
from ratebridge.operators.reshape import ffill, pivot_series
from ratebridge.operators.status import with_freshness, worst_status
from ratebridge.operators.topk import asc, dedup_keep_first, desc, latest_per_key
from ratebridge.plans import oracle as O
from ratebridge.plans.registry import register
from ratebridge.sources.fixtures import bank_listed_rates_raw, table

AS_OF = "2001-08-02"
EVENTS_AS_OF = dt.date(2024, 1, 30)
LOOKBACK_DAYS = 10
# Customer order recency levels (days): fresh <= 30 < aging <= 180 < stale.
CUSTOMER_WARN, CUSTOMER_STALE = 30, 180
# TPC-H order priorities -> pivot column names.
PRIORITIES = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "not_specified",
    "5-LOW": "low",
}


@register(
    "dedup_events",
    """
SELECT event_date, user_id, event_type, event_id, value FROM (
  SELECT CAST(ts AS DATE) AS event_date, user_id, event_type, event_id, value,
         row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type
                            ORDER BY ts NULLS LAST, event_id NULLS LAST) AS rn
  FROM events) r
WHERE rn = 1""",
)
def q_dedup_events(spark, sf_dir):
    """First event per (day, user, event type)."""
    ev = table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    first = dedup_keep_first(ev, ["event_date", "user_id", "event_type"], asc("ts", "event_id"))
    return first.select("event_date", "user_id", "event_type", "event_id", "value")


@register(
    "latest_order_per_customer",
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                                                            o_orderkey DESC NULLS LAST) AS rn
  FROM orders) r
WHERE rn = 1""",
)
def q_latest_order_per_customer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", "o_orderstatus"
    )
    return latest_per_key(o, ["o_custkey"], desc("o_orderdate", "o_orderkey"))


@register(
    "status_pivot_by_month",
    "SELECT strftime(o_orderdate, '%Y-%m') AS order_month, "
    + ", ".join(f"max(CASE WHEN o_orderpriority = '{k}' THEN o_totalprice END) AS {v}" for k, v in PRIORITIES.items())
    + " FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')",
)
def q_status_pivot_by_month(spark, sf_dir):
    """Largest order value per month and priority, one column per priority."""
    o = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), "o_orderpriority", "o_totalprice"
    )
    return pivot_series(o, "order_month", "o_orderpriority", "o_totalprice", PRIORITIES)


_STALENESS_SQL = f"""
SELECT o_custkey AS custkey, last_order_date,
       CAST(date_diff('day', last_order_date, DATE '{AS_OF}') AS INTEGER) AS order_age_days,
       CASE WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= {CUSTOMER_WARN} THEN 'fresh'
            WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= {CUSTOMER_STALE} THEN 'aging'
            ELSE 'stale' END AS order_freshness
FROM (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_order_date FROM orders GROUP BY o_custkey) g"""


def _customer_staleness(spark, sf_dir):
    last = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.max(F.to_date("o_orderdate")).alias("last_order_date"))
    )
    return with_freshness(
        last, "last_order_date", AS_OF, CUSTOMER_WARN, CUSTOMER_STALE, "order_age_days", "order_freshness"
    )


@register("customer_staleness", _STALENESS_SQL)
def q_customer_staleness(spark, sf_dir):
    """Days since each customer's last order and a fresh / aging / stale level."""
    return _customer_staleness(spark, sf_dir)


@register(
    "worst_status_by_nation",
    f"""
WITH s AS ({_STALENESS_SQL})
SELECT c.c_nationkey AS nationkey, count(*) AS customers, max(s.order_age_days) AS max_order_age_days,
       {O.worst_level_sql('s.order_freshness')} AS worst_freshness
FROM s JOIN customer c ON c.c_custkey = s.custkey
GROUP BY c.c_nationkey""",
)
def q_worst_status_by_nation(spark, sf_dir):
    """Per nation: customers with orders, the oldest last order and the worst level.

    The per-customer aggregate is already hash-partitioned on the customer key,
    so joining it to ``customer`` shuffles only the customer side; the nation
    roll-up is a partial/final aggregate (hot nations are pre-aggregated).
    """
    s = _customer_staleness(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = s.join(c, s.custkey == c.c_custkey, "inner")
    return j.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.max("order_age_days").alias("max_order_age_days"),
        worst_status("order_freshness").alias("worst_freshness"),
    )


@register(
    "missing_members",
    """
SELECT 'customer' AS member_kind, n.n_nationkey, n.n_name FROM nation n
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n.n_nationkey)
UNION ALL
SELECT 'supplier' AS member_kind, n.n_nationkey, n.n_name FROM nation n
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = n.n_nationkey)""",
)
def q_missing_members(spark, sf_dir):
    """Nations with no customer, and nations with no supplier (completeness gate)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = None
    for kind, tbl, key in (("customer", "customer", "c_nationkey"), ("supplier", "supplier", "s_nationkey")):
        # Distinct keys are partially aggregated map-side, so only a few rows per
        # task cross the shuffle; AQE then broadcasts them when they prove small.
        present = table(spark, sf_dir, tbl).select(F.col(key).alias("n_nationkey")).distinct()
        miss = nation.join(present, "n_nationkey", "left_anti").select(
            F.lit(kind).alias("member_kind"), "n_nationkey", "n_name"
        )
        out = miss if out is None else out.unionByName(miss)
    return out


@register(
    "member_coverage",
    """
SELECT n.n_nationkey, n.n_name, coalesce(c.customers, 0) AS customers, coalesce(s.suppliers, 0) AS suppliers
FROM nation n
LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey) c
  ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey) s
  ON s.s_nationkey = n.n_nationkey""",
)
def q_member_coverage(spark, sf_dir):
    """Customers and suppliers per nation, zero where a nation has none."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cc = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    sc = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    # Both counts are bounded by the number of distinct nation keys; AQE picks the join.
    return nation.join(cc, "n_nationkey", "left").join(sc, "n_nationkey", "left").select(
        "n_nationkey",
        "n_name",
        F.coalesce("customers", F.lit(0)).alias("customers"),
        F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
    )


@register(
    "missing_required_banks",
    O.with_ctes(
        ["bank_listed_rates_raw"],
        "SELECT bank FROM (VALUES " + ", ".join(f"('{b}')" for b in S.REQUIRED_BANKS) + ") AS r(bank) "
        "WHERE NOT EXISTS (SELECT 1 FROM bank_listed_rates_raw x WHERE x.bank = r.bank)",
    ),
)
def q_missing_required_banks(spark, sf_dir):
    """Required banks absent from the whole bank batch (empty when complete)."""
    return missing_members(bank_listed_rates_raw(spark, sf_dir), "bank", S.REQUIRED_BANKS)


@register(
    "ffill_last_value",
    """
SELECT event_id, user_id, event_type,
       last_value(CASE WHEN event_type = 'error' THEN NULL ELSE value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_value
FROM events""",
)
def q_ffill_last_value(spark, sf_dir):
    """Per user, the last non-error value so far in time order.

    Range-chunked: the events are range-partitioned by (user, ts, id) and each
    range is one chunk, so even a user holding a third of all events is
    scanned as many bounded pieces plus a small carry pass, never in one task.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("v"),
    )
    filled = ffill(ev, ["user_id"], ["ts", "event_id"], "v", "filled_value", chunk="range")
    return filled.select("event_id", "user_id", "event_type", "filled_value")


@register(
    "lookback_filter",
    f"""
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events
WHERE ts >= DATE '{EVENTS_AS_OF.isoformat()}' - INTERVAL {LOOKBACK_DAYS} DAY""",
)
def q_lookback_filter(spark, sf_dir):
    """Events inside the look-back window; the bound is a constant, pushed to the scan."""
    start = lookback_start(EVENTS_AS_OF, LOOKBACK_DAYS)
    ev = table(spark, sf_dir, "events").where(F.col("ts") >= start)
    return ev.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("event_date"))


# ---- reachability across rows (J6) --------------------------------------------------------

#: Shipments of this size are the edges.
_EDGE_QUANTITY, _START_NATION = 50, 0

_REACHED_SQL = f"""
WITH RECURSIVE edges AS (
  SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS month, c.c_nationkey AS src, s.s_nationkey AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c.c_custkey JOIN supplier s ON l_suppkey = s.s_suppkey
  WHERE l_quantity = {_EDGE_QUANTITY}
), reached(month, node) AS (
  SELECT DISTINCT month, {_START_NATION} FROM edges
  UNION
  SELECT e.month, e.dst FROM reached r JOIN edges e ON e.month = r.month AND e.src = r.node
)
SELECT month, CAST(node AS BIGINT) AS nation FROM reached"""


@register("nations_reached", _REACHED_SQL)
def q_nations_reached(spark, sf_dir):
    """Nations that each month's largest shipments lead to from one nation, customer's to supplier's; one graph a month."""
    t = lambda name, *columns: table(spark, sf_dir, name).select(*columns)
    shipped = t("lineitem", "l_orderkey", "l_suppkey", "l_shipdate", "l_quantity").where(F.col("l_quantity") == _EDGE_QUANTITY)
    placed = shipped.join(t("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    placed = placed.join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    placed = placed.join(t("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    month = F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM").alias("month")
    edges = placed.select(month, F.col("c_nationkey").cast("long").alias("src"), F.col("s_nationkey").cast("long").alias("dst"))
    starts = edges.select("month", F.lit(_START_NATION).cast("long").alias("node"))
    return reachable(edges, starts, ["month"]).withColumnRenamed("node", "nation")
