"""Payload extractors on hand-made bodies."""

import json

import pytest

from ratebridge.functions.text import parse_rate
from ratebridge.sources import payloads as P


def bodies(spark, rows):
    return spark.createDataFrame(rows, P.BODY_SCHEMA)


def test_observations_value_else_rate_and_non_list(spark):
    b = bodies(spark, [
        ("obs", "t", "SECBREPOEFF", json.dumps([{"date": "2024-01-02", "value": 4.0}, {"date": "2024-01-03"}])),
        ("obs", "t", "SWESTRAVG3M", json.dumps([{"date": "2024-01-02", "rate": 3.9}])),
        ("obs", "t", "SECBREPOEFF", json.dumps({"error": "not found"})),
        ("obs", "t", "UNKNOWN", json.dumps([{"date": "2024-01-02", "value": 1.0}])),
    ])
    out = sorted(((r.series_id, r.rate_date, r.value, r.category) for r in P.extract_observations(b).collect()),
                 key=lambda t: t[:2])
    assert out == [
        ("SECBREPOEFF", "2024-01-02", 4.0, "central_bank"),
        ("SECBREPOEFF", "2024-01-03", None, "central_bank"),
        ("SWESTRAVG3M", "2024-01-02", 3.9, "money_market"),
    ]


def px(columns, rows):
    return json.dumps({"columns": [{"code": c} for c in columns],
                       "data": [{"key": k, "values": v} for k, v in rows]})


def test_px_table_positions_missing_cells_and_labels(spark):
    cols = ["Tid", "Avtal", "Referenssektor", "Rantebindningstid"]
    b = bodies(spark, [("scb", "2024-06-01T00:00:00+00:00", "x", px(cols, [
        (["2024M04", "0100", "1.1", "1.1.1"], ["3,5"]),
        (["2024M04", "0200", "1.1", "9.9"], ["4,25"]),
        (["2024M04", "0300", "1.1", "1.1.1"], [".."]),
        (["2024M03", "0100", "1.1", "1.1.1"], [""]),
        (["2023M12", "0100", "1.1", "1.1.1"], ["1,0"]),
    ]))])
    out = sorted(tuple(r) for r in P.extract_px_table(b, from_month="2024-01").collect())
    assert out == [
        ("2024-04", "0100", "Nya och omförhandlade avtal", "1.1.1", "3M", 3.5, "2024-06-01T00:00:00+00:00"),
        ("2024-04", "0200", "Utestående avtal", "9.9", "unknown", 4.25, "2024-06-01T00:00:00+00:00"),
    ]


def test_px_table_unknown_shape_fails(spark):
    b = bodies(spark, [("scb", "t", "x", px(["Tid", "Avtal"], [(["2024M04", "0100"], ["3,5"])]))])
    with pytest.raises(Exception, match="Rantebindningstid"):
        P.extract_px_table(b).collect()


def test_px_bad_number_fails(spark):
    cols = ["Referenssektor", "Avtal", "Rantebindningstid", "Tid"]
    b = bodies(spark, [("scb", "t", "x", px(cols, [(["1.1", "0100", "1.1.1", "2024M04"], ["3,5x"])]))])
    with pytest.raises(Exception):
        P.extract_px_table(b).collect()


def test_offers_drop_unknown_codes_and_default_valid_from(spark):
    body = json.dumps({"listInterests": [
        {"period": "P_3_MONTHS", "interestRate": "4.05", "validFrom": "2024-05-02"},
        {"period": "P_5_YEARS", "interestRate": "3.60"},
        {"period": "P_6_MONTHS", "interestRate": "4.00"},
    ]})
    out = sorted((tuple(r) for r in P.extract_offers_json(bodies(spark, [("sbab", "T", "SBAB", body)])).collect()),
                 key=lambda t: t[1])
    assert out == [
        ("SBAB", "3M", 0.25, 4.05, None, "2024-05-02", "T", "sbab_api"),
        ("SBAB", "5Y", 5.0, 3.6, None, "", "T", "sbab_api"),
    ]


@pytest.mark.parametrize("text,value", [
    ("4,25 %", 4.25), ("4,25 %", 4.25), (" 3.10% ", 3.1), (" 4,5 ", 4.5), ("-", None),
    ("", None), ("n/a", None), ("1,2,3", None), (None, None),
])
def test_parse_rate(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_rate("t")).first()[0] == value
