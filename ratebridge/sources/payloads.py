"""Turn landed API response bodies into raw-table rows, as distributed expressions.

Input is a table of landed bodies, one response per row:
``(source STRING, fetched_at STRING, key STRING, body STRING)``. Fetching is
not done here; whatever lands the bodies (a file drop, a stream) feeds these
jobs. Every step is a JVM-side expression (``from_json``, ``explode``, literal
map lookups), so a body never visits Python and bodies spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge import schemas as S
from ratebridge.functions.dates import month_code_to_iso
from ratebridge.functions.text import parse_decimal_comma

BODY_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def literal_map(pairs) -> Column:
    """A literal MAP for a small fixed dimension: lookups are expressions, not joins."""
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def parse_body(schema) -> Column:
    """The parsed body; a truncated or otherwise malformed one fails the job."""
    return F.from_json("body", schema, {"mode": "FAILFAST"})


# ---- observation arrays (one series per body) ---------------------------------------


def with_series_meta(df: DataFrame, series_col: str = "series_id") -> DataFrame:
    """Add series_name and category; series without metadata are dropped."""
    names = literal_map([(sid, name) for sid, name, _, _ in S.SERIES])
    cats = literal_map([(sid, cat) for sid, _, cat, _ in S.SERIES])
    s = F.col(series_col)
    return df.withColumn("series_name", names[s]).withColumn("category", cats[s]).where(F.col("series_name").isNotNull())


def extract_observations(bodies: DataFrame) -> DataFrame:
    """Bodies of ``[{date, value | rate}, ...]`` keyed by series id -> se_rates_raw rows.

    A body that is not a JSON array (e.g. an error object) yields no rows. ``value`` wins over
    ``rate`` wherever the key is present, even if its value is null.
    """
    # Only array bodies carry observations. The test is part of the expression, as
    # the optimizer may move a filter behind the parse.
    is_array = F.col("body").rlike(r"^\s*\[")
    parsed = bodies.select(F.col("key").alias("series_id"), F.when(is_array, parse_body(S.OBSERVATIONS_PAYLOAD)).alias("obs"))
    flat = parsed.select("series_id", F.explode("obs").alias("o")).select(
        F.col("o")["date"].alias("rate_date"),
        "series_id",
        F.when(F.map_contains_key("o", "value"), F.col("o")["value"]).otherwise(F.col("o")["rate"]).cast("double").alias("value"),
    )
    return with_series_meta(flat).select(*S.SE_RATES_RAW.fieldNames())


# ---- statistical (PX) table -------------------------------------------------------------

PX_LOAN_DIM = "Avtal"
PX_PERIOD_DIM = "Rantebindningstid"
PX_MONTH_DIM = "Tid"
PX_MISSING = ["", ".."]


def _dim_index(codes: Column, code: str) -> Column:
    """1-based position of ``code`` among the table's dimension codes; fails the job if absent."""
    pos = F.coalesce(F.array_position(codes, code), F.lit(0)).cast("int")
    return F.when(pos == 0, F.raise_error(F.lit(f"unexpected statistical table shape: no {code} column"))).otherwise(pos)


def extract_px_table(bodies: DataFrame, from_month: str | None = None) -> DataFrame:
    """Statistical-table bodies -> scb_mortgage_rates_raw rows.

    Dimension positions are resolved per body from ``columns[].code``; cells
    whose first value is empty, ``..`` or NULL are skipped; months before
    ``from_month`` (``yyyy-MM``, compared as text) are skipped; the decimal
    comma is parsed strictly (bad text fails the job); code labels fall back to
    ``unknown`` and loan-type names to the code itself.
    """
    p = bodies.select("fetched_at", parse_body(S.PX_TABLE_PAYLOAD).alias("p"))
    codes = F.transform(F.col("p.columns"), lambda c: c["code"])
    loan_idx = _dim_index(codes, PX_LOAN_DIM)
    period_idx = _dim_index(codes, PX_PERIOD_DIM)
    month_idx = _dim_index(codes, PX_MONTH_DIM)
    # Resolve every cell inside the array, then explode the small resolved
    # structs: exploding the raw data while still referencing the body would
    # carry the whole parsed body on every generated row.
    cells_arr = F.transform(
        F.col("p.data"),
        lambda r: F.struct(
            F.element_at(r["key"], month_idx).alias("month_code"),
            F.element_at(r["key"], loan_idx).alias("loan_type"),
            F.element_at(r["key"], period_idx).alias("period_code"),
            F.element_at(r["values"], 1).alias("raw_value"),
        ),
    )
    located = p.select("fetched_at", F.explode(cells_arr).alias("c")).select("fetched_at", "c.*")
    raw_value = F.col("raw_value")
    cells = located.where(raw_value.isNotNull() & ~raw_value.isin(PX_MISSING)).select(
        "fetched_at",
        month_code_to_iso("month_code").alias("period_month"),
        "loan_type",
        "period_code",
        "raw_value",
    )
    if from_month is not None:
        cells = cells.where(F.col("period_month") >= F.lit(from_month))
    labels = literal_map([(code, label) for code, label, _ in S.SCB_PERIODS])
    names = literal_map(S.SCB_LOAN_TYPES)
    return cells.select(
        "period_month",
        "loan_type",
        F.coalesce(names[F.col("loan_type")], F.col("loan_type")).alias("loan_type_name"),
        "period_code",
        F.coalesce(labels[F.col("period_code")], F.lit(S.SCB_UNKNOWN_LABEL)).alias("period_label"),
        parse_decimal_comma("raw_value").alias("rate"),
        F.col("fetched_at").alias("scraped_at"),
    )


# ---- bank offers JSON ---------------------------------------------------------------------


def with_period(df: DataFrame, code_col: str) -> DataFrame:
    """Map a bank period text / code to (period_years, period_label); unmapped rows are dropped."""
    years = literal_map([(code, y) for code, y, _ in S.BANK_PERIODS])
    labels = literal_map([(code, label) for code, _, label in S.BANK_PERIODS])
    c = F.col(code_col)
    return (
        df.withColumn("period_label", labels[c])
        .withColumn("period_years", years[c])
        .where(F.col("period_label").isNotNull())
    )


def extract_offers_json(bodies: DataFrame, bank: str = "SBAB") -> DataFrame:
    """``{"listInterests": [{period, interestRate, validFrom}]}`` bodies -> bank rows.

    The rate text is cast strictly (a bad number fails the job, as the source
    API is trusted); a missing validFrom becomes ''.
    """
    p = bodies.select("fetched_at", F.explode(parse_body(S.OFFERS_PAYLOAD)["listInterests"]).alias("i"))
    items = p.select(
        "fetched_at",
        F.col("i.period").alias("code"),
        F.col("i.interestRate").cast("double").alias("list_rate"),
        F.coalesce(F.col("i.validFrom"), F.lit("")).alias("valid_from"),
    )
    return with_period(items, "code").select(
        F.lit(bank).alias("bank"),
        "period_label",
        "period_years",
        "list_rate",
        F.lit(None).cast("double").alias("avg_rate"),
        "valid_from",
        F.col("fetched_at").alias("scraped_at"),
        F.lit(S.BANK_SOURCES[bank]).alias("source"),
    )
