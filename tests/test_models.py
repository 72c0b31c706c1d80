"""Hand-made rows for staging, latest and the marts (edge cases of the semantics)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.plans import latest as L
from ratebridge.plans import marts as M
from ratebridge.plans import staging as ST

D = dt.date


def rates_raw(spark, rows):
    return spark.createDataFrame(rows, S.SE_RATES_RAW)


def bank_raw(spark, rows):
    return spark.createDataFrame(rows, S.BANK_LISTED_RATES_RAW)


def scb_raw(spark, rows):
    return spark.createDataFrame(rows, S.SCB_MORTGAGE_RATES_RAW)


SERIES = {sid: (name, cat) for sid, name, cat, _ in S.SERIES}


def obs(date, sid, value):
    name, cat = SERIES[sid]
    return (date, sid, name, cat, value)


def full_day(date, base=1.0, skip=()):
    return [obs(date, sid, base + i / 10) for i, sid in enumerate(S.SERIES_IDS) if sid not in skip]


def test_stage_rates_dedup_trim_and_filters(spark):
    rows = [
        ("2024-01-02", " SECBREPOEFF ", "Policy rate", "central_bank", 4.0),
        ("2024-01-02", "SECBREPOEFF", "Policy rate", "central_bank", 3.9),
        ("2024-01-02", "SECBREPOEFF", "Policy rate", "central_bank", None),
        (None, "SECBREPOEFF", "Policy rate", "central_bank", 1.0),
        ("2024-01-02", None, "x", "y", 1.0),
        ("2024-01-03", "SEGVB2YC", "Govt bond 2Y", "government_bond", 2.123456),
    ]
    out = {(r.rate_date, r.series_id): r for r in ST.stage_rates(rates_raw(spark, rows)).collect()}
    assert set(out) == {(D(2024, 1, 2), "SECBREPOEFF"), (D(2024, 1, 3), "SEGVB2YC")}
    assert float(out[(D(2024, 1, 2), "SECBREPOEFF")].value) == 3.9   # smallest value survives
    assert str(out[(D(2024, 1, 3), "SEGVB2YC")].value) == "2.1235"   # DECIMAL(10,4), half up


def test_stage_rates_order_invariant_and_idempotent(spark):
    rows = [obs("2024-02-01", sid, v) for sid in S.SERIES_IDS[:4] for v in (1.5, 1.25, 2.0)]
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    a = sorted(ST.stage_rates(rates_raw(spark, rows)).collect())
    b = sorted(ST.stage_rates(rates_raw(spark, shuffled)).collect())
    assert a == b
    once = ST.stage_rates(rates_raw(spark, rows))
    twice = ST.stage_rates(once.select(
        F.col("rate_date").cast("string").alias("rate_date"), "series_id", "series_name", "category",
        F.col("value").cast("double").alias("value")))
    assert sorted(once.collect()) == sorted(twice.collect())


def bank_row(bank, label, years, rate, scraped_at, avg=None, vf=""):
    return (bank, label, years, rate, avg, vf, scraped_at, S.BANK_SOURCES[bank])


def test_stage_bank_keeps_earliest_scrape_and_null_last(spark):
    rows = [
        bank_row("SBAB", "3M", 0.25, 4.10, "2024-03-01T09:00:00+00:00"),
        bank_row("SBAB", "3M", 0.25, 4.05, "2024-03-01T07:00:00+00:00"),
        bank_row("SBAB", "3M", 0.25, 4.00, "2024-03-01T07:00:00+00:00"),   # equal time: tie-break on rate
        bank_row("SBAB", "3M", 0.25, None, "2024-03-01T06:00:00+00:00"),   # no rate: filtered first
        bank_row("SBAB", "1Y", 1.0, 4.20, None),
    ]
    out = ST.stage_bank(bank_raw(spark, rows)).collect()
    by = {(r.scrape_date, r.period_label): r for r in out}
    assert by[(D(2024, 3, 1), "3M")].list_rate == 4.00
    assert by[(None, "1Y")].list_rate == 4.20


def test_bad_scrape_time_raises_or_quarantines(spark):
    rows = [bank_row("SBAB", "3M", 0.25, 4.1, "not-a-date")]
    with pytest.raises(Exception):
        ST.stage_bank(bank_raw(spark, rows)).collect()
    lenient = ST.stage_bank(bank_raw(spark, rows), strict_dates=False).collect()
    assert lenient[0].scrape_date is None


def test_latest_bank_with_lagging_bank_and_levels(spark):
    rows = [
        bank_row("SBAB", "3M", 0.25, 4.0, "2024-03-10T07:00:00+00:00"),
        bank_row("SBAB", "3M", 0.25, 4.1, "2024-03-09T07:00:00+00:00"),
        bank_row("Nordea", "3M", 0.25, 4.3, "2024-03-08T07:00:00+00:00"),   # lags 2 days
        bank_row("Swedbank", "3M", 0.25, 4.4, "2024-03-06T07:00:00+00:00"),  # lags 4 days
    ]
    out = {r.bank: r for r in L.latest_bank(ST.stage_bank(bank_raw(spark, rows)), "2024-03-10").collect()}
    assert out["SBAB"].list_rate == 4.0 and out["SBAB"].listed_rate_freshness == "fresh"
    assert out["Nordea"].listed_rate_age_days == 2 and out["Nordea"].listed_rate_freshness == "aging"
    assert out["Swedbank"].listed_rate_age_days == 4 and out["Swedbank"].listed_rate_freshness == "stale"


def scb_row(month, loan, code, label, rate, scraped="2024-06-01T00:00:00+00:00"):
    name = dict(S.SCB_LOAN_TYPES).get(loan, loan)
    return (month, loan, name, code, label, rate, scraped)


@pytest.mark.parametrize("age,level", [(45, "fresh"), (46, "aging"), (75, "aging"), (76, "stale")])
def test_scb_freshness_boundaries(spark, age, level):
    stg = ST.stage_scb(scb_raw(spark, [scb_row("2024-01", "0100", "1.1.1", "3M", 4.0)]))
    as_of = D(2024, 1, 1) + dt.timedelta(days=age)
    r = L.latest_scb(stg, as_of).collect()[0]
    assert r.scb_rate_age_days == age and r.scb_rate_freshness == level


def test_scb_latest_revision_wins(spark):
    rows = [
        scb_row("2024-01", "0100", "1.1.1", "3M", 4.0, "2024-02-01T00:00:00+00:00"),
        scb_row("2024-01", "0100", "1.1.1", "3M", 4.2, "2024-02-15T00:00:00+00:00"),
    ]
    r = ST.stage_scb(scb_raw(spark, rows)).collect()
    assert len(r) == 1 and r[0].rate == 4.2 and r[0].period_date == D(2024, 1, 1)


def test_latest_complete_skips_partial_day_and_empty_law(spark):
    rows = full_day("2024-01-01") + full_day("2024-01-02", base=2.0, skip=("SEMB5YCACOMB",))
    daily = M.rates_daily(ST.stage_rates(rates_raw(spark, rows)))
    m = M.latest_market(daily).collect()
    assert len(m) == 1 and m[0].funding_date == D(2024, 1, 1)
    none = M.rates_daily(ST.stage_rates(rates_raw(spark, full_day("2024-01-02", skip=("SECBREPOEFF",)))))
    assert M.latest_market(none).count() == 0
    listed = L.latest_bank(ST.stage_bank(bank_raw(spark, [bank_row("SBAB", "3M", 0.25, 4.0,
                                                                    "2024-01-02T07:00:00+00:00")])), "2024-01-02")
    assert M.bank_margin(none, listed).count() == 0


def test_bank_vs_market_buckets_and_gaps(spark):
    daily = M.rates_daily(ST.stage_rates(rates_raw(spark, full_day("2024-05-31", base=2.0))))
    listed_rows = [
        bank_row("Swedbank", "3M", 0.25, 4.0, "2024-06-01T07:00:00+00:00", avg=3.9),
        bank_row("Swedbank", "6M", 0.5, 4.1, "2024-06-01T07:00:00+00:00"),       # off-grid: no bucket
        bank_row("Swedbank", "4Y", 4.0, 4.2, "2024-06-01T07:00:00+00:00"),
        bank_row("Swedbank", "7Y", 7.0, 4.3, "2024-06-01T07:00:00+00:00"),
    ]
    listed = L.latest_bank(ST.stage_bank(bank_raw(spark, listed_rows)), "2024-06-02")
    scb = L.latest_scb(ST.stage_scb(scb_raw(spark, [
        scb_row("2024-04", "0100", "1.1.1", "3M", 4.5),
        scb_row("2024-04", "0200", "1.1.1", "3M", 4.6),
        scb_row("2024-04", "0100", "1.1.2.2.2", "3-5Y", 4.7),   # bucket with one loan type only
    ])), "2024-06-02")
    out = {r.period_label_display: r for r in M.bank_vs_market(daily, listed, scb).collect()}
    assert out["3M"].scb_bucket == "3M" and out["3M"].scb_new_loan_rate == 4.5
    assert out["3M"].scb_outstanding_rate == 4.6
    assert out["3M"].list_vs_mkt_discount == pytest.approx(-0.5)
    assert out["6M"].scb_bucket is None and out["6M"].scb_new_loan_rate is None
    assert out["4Y"].scb_new_loan_rate == 4.7 and out["4Y"].scb_outstanding_rate is None
    assert out["4Y"].scb_period_month == "2024-04"
    assert out["7Y"].scb_bucket == "5Y+" and out["7Y"].scb_rate_freshness is None
    assert out["3M"].period_label == "0.25Y" and out["4Y"].period_label == "04Y"


def test_worst_status_rollup(spark):
    from ratebridge.operators.status import worst_status

    df = spark.createDataFrame(
        [("a", "fresh"), ("a", "aging"), ("b", "fresh"), ("b", None), ("c", "stale"), ("c", "aging")], "k string, s string"
    )
    out = dict(df.groupBy("k").agg(worst_status("s").alias("w")).collect())
    assert out == {"a": "aging", "b": "fresh", "c": "stale"}


def test_latest_complete_generic_keeps_all_rows_of_the_date(spark):
    from ratebridge.operators.snapshot import latest_complete, latest_complete_row

    df = spark.createDataFrame(
        [(D(2024, 1, 1), 1.0, 2.0), (D(2024, 1, 2), 1.0, 2.0), (D(2024, 1, 2), None, 3.0), (D(2024, 1, 3), 1.0, None)],
        "d date, a double, b double",
    )
    got = sorted((r.d, r.b) for r in latest_complete(df, "d", ["a", "b"]).collect())
    assert got == [(D(2024, 1, 2), 2.0), (D(2024, 1, 2), 3.0)]      # every row of the chosen date
    assert latest_complete(df.where("d = '2024-01-03'"), "d", ["a", "b"]).count() == 0
    unique = df.dropDuplicates(["d"]).where("d <> '2024-01-02'")
    one = latest_complete_row(unique, "d", ["a", "b"], ["d", "a", "b"]).collect()
    assert [tuple(r) for r in one] == [(D(2024, 1, 1), 1.0, 2.0)]
