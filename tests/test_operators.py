"""Generic operators: gates, checks, forward fill, pivot."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ratebridge.operators import quality as Q
from ratebridge.operators.gates import GateError, missing_members, require_members, require_rows
from ratebridge.operators.reshape import ffill, pivot_series


def test_gates(spark):
    df = spark.createDataFrame([("SBAB",), ("Nordea",)], "bank string")
    assert [r.bank for r in missing_members(df, "bank", ["SBAB", "Nordea", "Swedbank"]).collect()] == ["Swedbank"]
    with pytest.raises(GateError, match="Swedbank"):
        require_members(df, "bank", ["SBAB", "Swedbank"])
    assert require_members(df, "bank", ["SBAB"]) is df
    with pytest.raises(GateError):
        require_rows(df.where("false"))


def test_checks_ignore_null_in_accepted_values(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", None)], "c string, n int")
    checks = [Q.Check("t", "c", "accepted_values", ("a", "b")), Q.Check("t", "c", "not_null"), Q.Check("t", "n", "not_null")]
    out = {(r.column_name, r.check_name): (r.failures, r.status) for r in Q.run_checks({"t": df}, checks).collect()}
    assert out == {("c", "accepted_values"): (1, "fail"), ("c", "not_null"): (1, "fail"), ("n", "not_null"): (1, "fail")}


def test_source_freshness_levels_and_empty(spark):
    from ratebridge import schemas as S

    bank = spark.createDataFrame([("SBAB", "3M", 0.25, 4.0, None, "", "2024-05-01T12:00:00+00:00", "x")], S.BANK_LISTED_RATES_RAW)
    rates = spark.createDataFrame([("2024-04-28", "A", "a", "c", 1.0)], S.SE_RATES_RAW)
    scb = spark.createDataFrame([], S.SCB_MORTGAGE_RATES_RAW)
    out = {r.source: r.status for r in Q.source_freshness(
        {"bank_listed_rates_raw": bank, "se_rates_raw": rates, "scb_mortgage_rates_raw": scb},
        dt.datetime(2024, 5, 2, 18, 0)).collect()}
    assert out == {"bank_listed_rates_raw": "warn", "se_rates_raw": "error", "scb_mortgage_rates_raw": "error"}


def test_missing_columns_contract(spark):
    df = spark.createDataFrame([(1,)], "rate_date int")
    assert ("rates_daily", "spread_2y") in Q.missing_columns({"rates_daily": df})


def test_chunked_ffill_equals_running_window(spark):
    rng = random.Random(3)
    rows = []
    for user in range(5):
        for i in range(200):
            day = rng.randrange(12)
            v = None if rng.random() < 0.6 or day in (3, 4) else round(rng.random(), 3)
            rows.append((user, i, dt.datetime(2024, 1, 1 + day, rng.randrange(24)), v))
    df = spark.createDataFrame(rows, "u int, id int, ts timestamp, v double")
    plain = ffill(df, ["u"], ["ts", "id"], "v", "f")
    chunked = ffill(df, ["u"], ["ts", "id"], "v", "f", chunk=F.to_date("ts"))
    ranged = ffill(df, ["u"], ["ts", "id"], "v", "f", chunk="range", partitions=7)
    a = sorted((r.id, r.u, r.f) for r in plain.collect())
    b = sorted((r.id, r.u, r.f) for r in chunked.collect())
    c = sorted((r.id, r.u, r.f) for r in ranged.collect())
    assert a == b == c


def test_range_ffill_splits_one_hot_group(spark):
    rows = [(1, i, None if i % 3 else float(i)) for i in range(3000)] + [(2, i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "u int, id int, v double")
    out = ffill(df, ["u"], ["id"], "v", "f", chunk="range", partitions=16)
    got = {(r.u, r.id): r.f for r in out.collect()}
    assert all(got[(1, i)] == float(i - i % 3) for i in range(3000))
    assert all(got[(2, i)] == float(i) for i in range(10))


def test_pivot_keeps_keys_of_unmapped_codes(spark):
    df = spark.createDataFrame([("d1", "A", 1.0), ("d1", "B", 2.0), ("d2", "Z", 3.0)], "k string, c string, v double")
    out = {r.k: (r.a, r.b) for r in pivot_series(df, "k", "c", "v", {"A": "a", "B": "b"}).collect()}
    assert out == {"d1": (1.0, 2.0), "d2": (None, None)}
