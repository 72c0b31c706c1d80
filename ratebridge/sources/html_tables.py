"""Bank rates from HTML tables.

Only tokenising is Python: ``page_tables`` runs the standard-library HTML parser
inside ``mapInArrow`` and returns one row a page, with its tables as a nested
value (``html_parse.TABLES``): each table's own text, first caption, heads of the
first thead, and rows of cells. Choosing the table, locating header columns,
skipping rows and forward-filling the valid-from date are array expressions on
that value; the rows of the chosen table are exploded last. Nothing is shuffled.

No-break spaces inside cell texts become plain spaces. Nested tables are
treated as tables of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge import schemas as S
from ratebridge.functions.text import VALID_FROM_PATTERN, normalize_cell, parse_rate
from ratebridge.sources.html_parse import TABLES, pages_fn, parse_tables  # noqa: F401
from ratebridge.sources.payloads import with_period


def page_tables(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``pages(page_id, html, *carry)`` -> (page_id, *carry, tables): a row a page."""
    kept = ("page_id", *carry)
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField("tables", T.DataType.fromDDL(TABLES))])
    return pages.select(*kept, "html").mapInArrow(pages_fn(len(kept)), schema)


def chosen_table(needle: str, fallback_pct: bool) -> Column:
    """The first table whose caption contains ``needle`` (lower-cased); with
    ``fallback_pct``, else the first with a '%' anywhere in its text; null for none."""
    captioned = F.filter("tables", lambda t: F.lower(t["caption"]).contains(needle))
    if not fallback_pct:
        return F.try_element_at(captioned, F.lit(1))
    percent = F.filter("tables", lambda t: t["text"].contains("%"))
    return F.coalesce(F.try_element_at(captioned, F.lit(1)), F.try_element_at(percent, F.lit(1)))


def _cell(cells: Column, idx0: Column | int) -> Column:
    """0-based cell of an array; null where out of range or without a position."""
    return F.try_element_at(cells, (idx0 if isinstance(idx0, Column) else F.lit(idx0)) + 1)


def _rows(pages: DataFrame, found: Column) -> DataFrame:
    """(page_id, scraped_at, period_text, list_rate, avg_rate, valid_from) of an array of records a page."""
    return pages.select("page_id", F.col("fetched_at").alias("scraped_at"), F.inline(found)).select(
        "page_id", "scraped_at", normalize_cell(F.col("period")).alias("period_text"), parse_rate(F.col("list_text")).alias("list_rate"),
        parse_rate(F.col("avg_text")).alias("avg_rate"), "valid_from")


def _record(period: Column, list_text: Column, avg_text: Column, valid_from: Column) -> Column:
    return F.struct(period.alias("period"), list_text.alias("list_text"), avg_text.alias("avg_text"), valid_from.alias("valid_from"))


def plain_table_rows(pages: DataFrame, needle: str) -> DataFrame:
    """Plain tables (first row is a header): period, rate, -, valid-from cells.

    Rows with fewer than two td cells are skipped; valid-from is the last
    non-empty 4th cell so far in row order (rows dropped later still update it).
    """
    body = F.filter(F.col("table.rows"), lambda r, i: (i >= 1) & (F.size(r["cells"]) >= 2))

    def carry_on(acc: Column, r: Column) -> Column:
        own = F.nullif(normalize_cell(_cell(r["cells"], 3)), F.lit(""))
        last = F.coalesce(own, acc["last"])
        record = _record(_cell(r["cells"], 0), _cell(r["cells"], 1), F.lit(None).cast("string"), last)
        return F.struct(last.alias("last"), F.concat(acc["out"], F.array(record)).alias("out"))

    none = F.array().cast("array<struct<period:string,list_text:string,avg_text:string,valid_from:string>>")
    filled = F.aggregate(body, F.struct(F.lit("").alias("last"), none.alias("out")), carry_on, lambda acc: acc["out"])
    return _rows(pages.withColumn("table", chosen_table(needle, fallback_pct=True)), filled)


def sectioned_table_rows(pages: DataFrame, needle: str) -> DataFrame:
    """Tables with thead headers and tbody rows (both required).

    List-rate column: first header containing 'list' (else column 1); average
    column: first containing 'snitt' (else none); valid-from: the first
    day-month-year phrase among the lower-cased headers (else '').
    """
    heads = F.transform("table.heads", lambda h: F.lower(h))
    place = lambda text: F.nullif(F.array_position(F.transform(F.col("heads"), lambda h: h.contains(text)), True), F.lit(0)).cast("int") - 1
    dates = F.filter(F.transform(F.col("heads"), lambda h: F.regexp_extract(h, VALID_FROM_PATTERN, 1)), lambda d: d != "")
    laid = pages.withColumn("table", chosen_table(needle, fallback_pct=False)).withColumn("heads", heads).where("heads IS NOT NULL")
    laid = laid.withColumns({"list_at": F.coalesce(place("list"), F.lit(1)), "avg_at": place("snitt"),
                             "dated": F.coalesce(F.try_element_at(dates, F.lit(1)), F.lit(""))})
    body = F.filter(F.col("table.rows"), lambda r: (r["section"] == "tbody") & (r["section_idx"] == 0) & (F.size(r["cells"]) >= 2))
    records = F.transform(body, lambda r: _record(_cell(r["cells_spaced"], 0), _cell(r["cells_spaced"], F.col("list_at")),
                                                  _cell(r["cells_spaced"], F.col("avg_at")), F.col("dated")))
    return _rows(laid, records)


def to_bank_rows(rows: DataFrame, bank: str) -> DataFrame:
    """Map periods (drop unmapped), drop rows without a list rate, stamp constants."""
    mapped = with_period(rows, "period_text").where(F.col("list_rate").isNotNull())
    return mapped.select(
        F.lit(bank).alias("bank"),
        "period_label",
        "period_years",
        "list_rate",
        "avg_rate",
        "valid_from",
        "scraped_at",
        F.lit(S.BANK_SOURCES[bank]).alias("source"),
    )


PLAIN_NEEDLE = "listräntor"
SECTIONED_NEEDLE = "bolåneräntor"


def extract_bank_pages(pages: DataFrame) -> DataFrame:
    """``pages(page_id, bank, fetched_at, html)`` of both HTML banks -> bank_listed_rates_raw rows.

    One narrow pass; the fetch time rides along with each page, so no join back to pages."""
    nordea = page_tables(pages.where(F.col("bank") == "Nordea"), carry=("fetched_at",))
    swed = page_tables(pages.where(F.col("bank") == "Swedbank"), carry=("fetched_at",))
    plain = plain_table_rows(nordea, PLAIN_NEEDLE)
    sectioned = sectioned_table_rows(swed, SECTIONED_NEEDLE)
    return to_bank_rows(plain, "Nordea").unionByName(to_bank_rows(sectioned, "Swedbank"))
