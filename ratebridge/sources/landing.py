"""Render adapter rows as landed response bodies and pages (fixture inputs).

The extractors in ``payloads`` and ``html_tables`` are checked by round trip:
rows derived from the driver tables are rendered into the payload shapes the
sources publish, then extracted again and compared with the unrendered rows.

Each body / page holds the rows of one block of source keys (``src_key div
BLOCK``), so its size is bounded by construction whatever the scale factor;
rows are ordered inside a body by ``src_key`` (sorted array of structs, not
``collect_list`` arrival order) so renders are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.functions.text import NBSP
from ratebridge.sources import fixtures as FX

BLOCK = 256
# Scrapes: one page / offer list per (bank, day, key block), fetched at the
# newest scrape time in it; statistical tables: one body per key block with
# every month, as the real endpoint returns all months at once.
PAGE_BLOCK = 65536
PX_BLOCK = 4096
PX_FROM_MONTH = "1996-01"
PX_CODES_A = ["Referenssektor", "Avtal", "Rantebindningstid", "Tid"]
PX_CODES_B = ["Tid", "Rantebindningstid", "Avtal", "Referenssektor"]
# Swedish month names for header dates ("5 maj 2024").
MONTHS_SV = ["januari", "februari", "mars", "april", "maj", "juni", "juli", "augusti", "september", "oktober",
             "november", "december"]


def block_of(key: str = "src_key", size: int = BLOCK) -> Column:
    return F.floor(F.col(key) / size)


def scrape_day(col: str = "scraped_at") -> Column:
    return F.substring(col, 1, 10)


def _ordered_join(parts: Column, sep: str = "") -> Column:
    """Aggregate: join ``parts`` in src_key order."""
    arr = F.sort_array(F.collect_list(F.struct(F.col("src_key").alias("k"), parts.alias("v"))))
    return F.array_join(F.transform(arr, lambda x: x["v"]), sep)


def _ordered_list(item: Column) -> Column:
    arr = F.sort_array(F.collect_list(F.struct(F.col("src_key").alias("k"), item.alias("v"))))
    return F.transform(arr, lambda x: x["v"])


def _landed(df: DataFrame, source: str, fetched_at: Column, key: Column, body: Column) -> DataFrame:
    return df.select(F.lit(source).alias("source"), fetched_at.alias("fetched_at"), key.alias("key"), body.alias("body"))


def rate_text(col: str, decimal_comma: bool = True, suffix: str = "") -> Column:
    text = F.col(col).cast("string")
    if decimal_comma:
        text = F.replace(text, F.lit("."), F.lit(","))
    return F.concat(text, F.lit(suffix)) if suffix else text


# ---- observation arrays ---------------------------------------------------------------


def observation_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per (series, key block): ``[{"date": ..., "value" | "rate": ...}]``.

    The averages series publishes ``rate`` instead of ``value``; a NULL value
    publishes neither key.
    """
    raw = FX.se_rates_raw(spark, sf_dir, keep_key=True)
    avg = F.col("series_id").isin(list(S.AVERAGE_SERIES))
    entry = F.struct(
        F.col("rate_date").alias("date"),
        F.when(~avg, F.col("value")).alias("value"),
        F.when(avg, F.col("value")).alias("rate"),
    )
    grouped = raw.groupBy("series_id", block_of().alias("blk")).agg(F.to_json(_ordered_list(entry)).alias("body"))
    return _landed(grouped, "observations", F.lit("2001-08-02T07:15:00+00:00"), F.col("series_id"), F.col("body"))


# ---- statistical table -------------------------------------------------------------------


def px_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statistical-table body per key block with all its months; blocks
    alternate the dimension order so positions must be resolved from
    ``columns``; a NULL rate publishes ``..``. ``fetched_at`` is the newest
    scrape time in the block."""
    raw = FX.scb_mortgage_rates_raw(spark, sf_dir, keep_key=True).withColumn("blk", block_of(size=PX_BLOCK))
    month_code = F.replace(F.col("period_month"), F.lit("-"), F.lit("M"))
    even = F.col("blk") % 2 == 0
    key_a = F.array(F.lit("1.1"), F.col("loan_type"), F.col("period_code"), month_code)
    key_b = F.array(month_code, F.col("period_code"), F.col("loan_type"), F.lit("1.1"))
    value = F.coalesce(rate_text("rate"), F.lit(".."))
    row = F.struct(F.when(even, key_a).otherwise(key_b).alias("key"), F.array(value).alias("values"))
    grouped = raw.groupBy("blk").agg(F.max("scraped_at").alias("fetched_at"), _ordered_list(row).alias("data"))

    def codes(names):
        return F.array(*[F.struct(F.lit(n).alias("code")) for n in names])

    columns = F.when(F.col("blk") % 2 == 0, codes(PX_CODES_A)).otherwise(codes(PX_CODES_B))
    body = F.to_json(F.struct(columns.alias("columns"), F.col("data")))
    return _landed(grouped, "scb_px", F.col("fetched_at"), F.col("blk").cast("string"), body)


# ---- bank offers JSON ----------------------------------------------------------------------


def offer_code(label: Column) -> Column:
    """Label -> API period code: 3M -> P_3_MONTHS, 1Y -> P_1_YEAR, 5Y -> P_5_YEARS."""
    n = F.regexp_extract(label, r"^(\d+)", 1)
    return (
        F.when(label.endswith("M"), F.concat(F.lit("P_"), n, F.lit("_MONTHS")))
        .when(label == "1Y", F.lit("P_1_YEAR"))
        .otherwise(F.concat(F.lit("P_"), n, F.lit("_YEARS")))
    )


def offer_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SBAB rows with a rate, one body per (day, key block) fetched at the newest
    scrape time in it; every 7th offer omits ``validFrom``."""
    raw = FX.bank_listed_rates_raw(spark, sf_dir, keep_key=True).where(
        (F.col("bank") == "SBAB") & F.col("list_rate").isNotNull()
    )
    item = F.struct(
        offer_code(F.col("period_label")).alias("period"),
        rate_text("list_rate", decimal_comma=False).alias("interestRate"),
        F.when(F.col("src_key") % 7 != 0, F.substring("scraped_at", 1, 10)).alias("validFrom"),
    )
    grouped = raw.groupBy(scrape_day().alias("day"), block_of(size=PAGE_BLOCK).alias("blk")).agg(
        F.max("scraped_at").alias("fetched_at"), _ordered_list(item).alias("items")
    )
    body = F.to_json(F.struct(F.col("items").alias("listInterests")))
    return _landed(grouped, "sbab_api", F.col("fetched_at"), F.lit("SBAB"), body)


# ---- HTML pages --------------------------------------------------------------------------


def period_text(label: Column) -> Column:
    """Label -> the banks' Swedish period text: 3M -> '3 mån', 5Y -> '5 år'."""
    n = F.regexp_extract(label, r"^(\d+)", 1)
    return F.when(label.endswith("M"), F.concat(n, F.lit(" mån"))).otherwise(F.concat(n, F.lit(" år")))


def _td(text: Column) -> Column:
    return F.concat(F.lit("<td>"), text, F.lit("</td>"))


DECOY_TABLE = "<table><tr><td>Öppettider</td><td>9-17</td></tr></table>"


def nordea_pages(raw: DataFrame) -> DataFrame:
    """Plain tables: decoy table first; the rates table has a caption on about two
    of three pages (the rest are found by the '%' fallback); header row first;
    cells period, rate, change, valid-from (filled on every 5th row)."""
    rows = raw.where(F.col("bank") == "Nordea")
    rate = F.coalesce(rate_text("list_rate", suffix=NBSP + "%"), F.lit("-"))
    vf = F.when(F.col("src_key") % 5 == 0, F.substring("scraped_at", 1, 10)).otherwise(F.lit(""))
    tr = F.concat(F.lit("<tr>"), _td(period_text(F.col("period_label"))), _td(rate), _td(F.lit("-")), _td(vf),
                  F.lit("</tr>"))
    grouped = rows.groupBy(scrape_day().alias("day"), block_of(size=PAGE_BLOCK).alias("blk")).agg(
        F.max("scraped_at").alias("fetched_at"), _ordered_join(tr).alias("trs")
    )
    caption = F.when(F.hash("day") % 3 != 0, F.lit("<caption>Aktuella listräntor</caption>")).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<html><body><h1>Bolån</h1>"),
        F.lit(DECOY_TABLE),
        F.lit("<table>"),
        caption,
        F.lit("<tr><th>Bindningstid</th><th>Ränta</th><th>Förändring</th><th>Gäller från</th></tr>"),
        F.col("trs"),
        F.lit("</table></body></html>"),
    )
    return grouped.select(
        F.concat(F.lit("nordea/"), F.col("day"), F.lit("/"), F.col("blk").cast("string")).alias("url"),
        "fetched_at",
        F.lit("Nordea").alias("bank"),
        html.alias("html"),
    )


def header_date(scraped_at: Column) -> Column:
    """'2001-08-01T...' -> '1 augusti 2001'."""
    d = F.to_date(F.substring(scraped_at, 1, 10), "yyyy-MM-dd")
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.element_at(F.array(*[F.lit(m) for m in MONTHS_SV]), F.month(d)),
                       F.year(d).cast("string"))


def swedbank_pages(raw: DataFrame) -> DataFrame:
    """Sectioned tables: thead headers (average and list columns swap places on
    odd days; the list header carries the valid-from date), tbody rows."""
    rows = raw.where(F.col("bank") == "Swedbank")
    lst = F.coalesce(rate_text("list_rate", suffix=" " + NBSP + "%"), F.lit(""))
    avg = F.coalesce(rate_text("avg_rate", suffix=" %"), F.lit(""))
    odd = F.dayofmonth(F.to_date(scrape_day())) % 2 == 1
    tr_even = F.concat(F.lit("<tr>"), _td(period_text(F.col("period_label"))), _td(lst), _td(avg), F.lit("</tr>"))
    tr_odd = F.concat(F.lit("<tr>"), _td(period_text(F.col("period_label"))), _td(avg), _td(lst), F.lit("</tr>"))
    grouped = rows.groupBy(scrape_day().alias("day"), block_of(size=PAGE_BLOCK).alias("blk")).agg(
        F.max("scraped_at").alias("fetched_at"), _ordered_join(F.when(odd, tr_odd).otherwise(tr_even)).alias("trs")
    )
    list_head = F.concat(F.lit("<th>Listränta från "), header_date(F.col("day")), F.lit("</th>"))
    avg_head = F.lit("<th>Snittränta <span>förra månaden</span></th>")
    heads = F.when(F.dayofmonth(F.to_date("day")) % 2 == 1, F.concat(avg_head, list_head)).otherwise(
        F.concat(list_head, avg_head)
    )
    html = F.concat(
        F.lit("<html><body><table><caption>Våra bolåneräntor</caption><thead><tr><th>Bindningstid</th>"),
        heads,
        F.lit("</tr></thead><tbody>"),
        F.col("trs"),
        F.lit("</tbody></table></body></html>"),
    )
    return grouped.select(
        F.concat(F.lit("swedbank/"), F.col("day"), F.lit("/"), F.col("blk").cast("string")).alias("url"),
        "fetched_at",
        F.lit("Swedbank").alias("bank"),
        html.alias("html"),
    )


def bank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages ``(page_id, url, fetched_at, bank, html)`` for both HTML banks."""
    raw = FX.bank_listed_rates_raw(spark, sf_dir, keep_key=True)
    pages = nordea_pages(raw).unionByName(swedbank_pages(raw))
    return pages.withColumn("page_id", F.xxhash64("url"))


# ---- app contracts ---------------------------------------------------------------------

#: Faults of documents, by number: what is replaced in the text, and by what. Two more follow, which
#: hang on the document: a label that is a number, and transitions that are an object.
CONTRACT_EDITS = [
    ('"version":1,', '"version":"one",'),
    ('"version":1,', '"version":1.5,'),
    ('"version":1,', '"version":0.5,'),
    (r'"terminal":\[[^\]]*\]', '"terminal":"zzz"'),
    ('"type":"number","description":"Loan amount"', '"type":5,"description":"Loan amount"'),
    ('"description":"Loan amount"', '"description":"Loan amount","sensitive":"yes","enum":[null,1,1.0],"scale":2,"range":3'),
    ('"owner":"webapp"', '"owner":["webapp"]'),
    (r'"states":\{.*$', '"states":[]}'),
    ("}}$", ""),
    ('"initial":"[^"]*"', '"initial":null'),
    ("^.*$", "[]"),
    ('"event":"back"', '"event":7'),
    (r'"states":\{', '"states":{"broken":5,'),
]
CONTRACT_EDIT_CYCLE = 211

CONTRACT_BLOCK = 1024
STATUS_CONTEXT = {"F": "loan_amount", "O": "current_rate", "P": "target_rate"}


def contract_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state-machine contract per (customer, order-key block): ``(path, doc)``.

    States are the block's orders (``s<orderkey>``) in key order; each state
    links forward to the next order unless that one is pending ('P', which
    leaves it and its successors unreachable) and back to the previous one (a
    cycle); low-priority orders also point at a missing state and a missing
    data product. Some documents break the structure rules (upper-case id,
    an unknown member, a state without purpose) or name a missing initial or
    terminal state; those without such a fault whose customer is in
    ``CONTRACT_EDITS`` modulo ``CONTRACT_EDIT_CYCLE`` have values of a wrong type.
    Built per bounded block with windows and one aggregate.
    """
    from pyspark.sql import Window

    o = FX.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("ck"),
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"),
        F.floor(F.col("o_orderkey") / CONTRACT_BLOCK).alias("blk"),
    )
    w = Window.partitionBy("ck", "blk").orderBy("k")
    o = o.withColumns({"nk": F.lead("k").over(w), "nst": F.lead("st").over(w), "pk": F.lag("k").over(w)})

    def sname(col: str) -> Column:
        return F.concat(F.lit("s"), F.col(col).cast("string"))

    def tr(event: str, target: Column) -> Column:
        return F.struct(F.lit(event).alias("event"), target.alias("target"))

    low = F.col("pr") == "5-LOW"
    transitions = F.filter(
        F.array(
            F.when(F.col("nk").isNotNull() & (F.col("nst") != "P"), tr("next", sname("nk"))),
            F.when(F.col("pk").isNotNull(), tr("back", sname("pk"))),
            F.when(low, tr("escalate", F.concat(F.lit("x"), F.col("k").cast("string")))),
        ),
        lambda x: x.isNotNull(),
    )
    ctx = F.create_map(*[F.lit(x) for kv in STATUS_CONTEXT.items() for x in kv])[F.col("st")]
    state = F.struct(
        F.concat(F.lit("Order "), F.col("k").cast("string")).alias("label"),
        F.lit("OrderStep").alias("component"),
        F.when(F.col("k") % 101 != 0, F.lit("Review the order")).alias("purpose"),
        F.array(ctx).alias("requires_context"),
        F.array(F.concat(F.lit("p"), F.substring("pr", 1, 1))).alias("data"),
        transitions.alias("transitions"),
    )
    docs = o.groupBy("ck", "blk").agg(
        F.min("k").alias("k0"),
        F.max("k").alias("k1"),
        F.bool_or(F.col("k") % 101 == 0).alias("no_purpose"),
        F.map_from_entries(F.collect_list(F.struct(sname("k"), state))).alias("states"),
    )
    ck = F.col("ck")

    def ctx_entry(desc: str) -> Column:
        return F.struct(F.lit("number").alias("type"), F.lit(desc).alias("description"))

    ctx_map = F.when(
        ck % 2 == 0,
        F.create_map(F.lit("loan_amount"), ctx_entry("Loan amount"), F.lit("current_rate"), ctx_entry("Current rate")),
    ).otherwise(F.create_map(F.lit("loan_amount"), ctx_entry("Loan amount")))
    def product(owner: str, relation: Column, field: Column) -> Column:
        return F.struct(
            F.lit(owner).alias("owner"),
            relation.alias("relation"),
            F.lit("Market context").alias("description"),
            field.alias("freshness_field"),
        )

    # p4 names a relation / freshness field that does not exist for some customers.
    p4_rel = F.when(ck % 7 == 0, F.lit("rates_weekly")).otherwise(F.lit("bank_vs_market_analysis"))
    p4_field = F.when(ck % 3 == 0, F.lit("scrape_date")).otherwise(F.lit("funding_date"))
    products = F.create_map(
        F.lit("p1"), product("dbt", F.lit("rates_daily"), F.lit("rate_date")),
        F.lit("p2"), product("dbt", F.lit("bank_margin_analysis"), F.lit("scrape_date")),
        F.lit("p3"), product("webapp", F.lit("computed_from_context"), F.lit(None).cast("string")),
        F.lit("p4"), product("dbt", p4_rel, p4_field),
    )
    last = F.concat(F.lit("s"), F.col("k1").cast("string"))
    doc = F.to_json(
        F.struct(
            F.when(ck % 19 == 0, F.concat(F.lit("C"), ck.cast("string")))
            .otherwise(F.concat(F.lit("c"), ck.cast("string"), F.lit("_"), F.col("blk").cast("string")))
            .alias("id"),
            F.lit(1).alias("version"),
            F.when(ck % 13 == 0, F.lit("start")).otherwise(F.concat(F.lit("s"), F.col("k0").cast("string")))
            .alias("initial"),
            F.when(ck % 11 == 0, F.array(last, F.lit("closed"))).otherwise(F.array(last)).alias("terminal"),
            F.when(ck % 17 == 0, F.lit("rates")).alias("owner_team"),
            ctx_map.alias("context_schema"),
            products.alias("data_products"),
            F.col("states"),
        )
    )
    path = F.concat(F.lit("contracts/c"), ck.cast("string"), F.lit("_"), F.col("blk").cast("string"), F.lit(".json"))
    faulty = (ck % 19 == 0) | (ck % 17 == 0) | F.col("no_purpose")
    named = docs.select(path.alias("path"), doc.alias("doc"), "k0", F.when(~faulty, ck % CONTRACT_EDIT_CYCLE).alias("edit"))
    return named.select("path", _edited(F.col("doc"), F.col("edit"), F.col("k0").cast("string")).alias("doc"))


def _edited(doc: Column, edit: Column, k0: Column) -> Column:
    """The text of a document with the fault of that number (see ``CONTRACT_EDITS``), or as it is."""
    label = F.concat(F.lit('"label":"Order '), k0, F.lit('"'))
    out = F.when(edit == len(CONTRACT_EDITS), F.regexp_replace(doc, label, F.concat(F.lit('"label":'), k0)))
    no_list = F.regexp_replace(doc, F.concat(F.lit("("), label, F.lit(r'.*?"transitions":)\[[^\]]*\]')), F.lit("$1{}"))
    out = out.when(edit == len(CONTRACT_EDITS) + 1, no_list)
    for number, (pattern, replacement) in enumerate(CONTRACT_EDITS):
        out = out.when(edit == number, F.regexp_replace(doc, pattern, replacement))
    return out.otherwise(doc)
