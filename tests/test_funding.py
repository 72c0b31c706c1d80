"""Funding model at every CASE boundary, against a plain-Python statement of the rules."""

import math

import pytest
from pyspark.sql import functions as F

from ratebridge.functions import funding as FN

YEARS = [None, 0.0, 0.25, 0.5, 0.9, 1.0, 1.5, 2.0, 2.0001, 2.5, 3.0, 4.0, 4.9999, 5.0, 5.0001, 7.0, 10.0, 100.0]
G2, G5, S2, S5, POLICY, SWESTR_SPREAD = 2.5, 2.9, 0.6, 0.8, 3.75, -0.1


def half_up(x, nd=4):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-nd), rounding=ROUND_HALF_UP))


def expected(y):
    """The rules, written out directly (NULL tenor behaves as 'not <= / <')."""
    short = y is not None and y <= 1.0
    upto2 = y is not None and y <= 2.0
    below5 = y is not None and y < 5.0
    model = "swapped_covered_bond_variable_proxy" if short else (
        "interpolated_covered_bond_curve" if below5 else "five_year_covered_bond_proxy")
    w2 = 1.0 if upto2 else (half_up((5.0 - y) / 3.0) if below5 else 0.0)
    w5 = 0.0 if upto2 else (half_up((y - 2.0) / 3.0) if below5 else 1.0)
    if short:
        rf, cb = 0.0, S5
    elif upto2:
        rf, cb = G2, S2
    elif below5:
        rf = half_up((5.0 - y) / 3.0 * G2 + (y - 2.0) / 3.0 * G5)
        cb = half_up((5.0 - y) / 3.0 * S2 + (y - 2.0) / 3.0 * S5)
    else:
        rf, cb = G5, S5
    policy = POLICY if short else 0.0
    spread = SWESTR_SPREAD if short else 0.0
    return model, w2, w5, policy, spread, rf, cb


@pytest.fixture(scope="module")
def computed(spark):
    df = spark.createDataFrame([(y,) for y in YEARS], "period_years double").withColumns(
        {"policy_rate": F.lit(POLICY), "swestr_policy_spread_3m": F.lit(SWESTR_SPREAD), "govbond_2y": F.lit(G2),
         "govbond_5y": F.lit(G5), "spread_2y": F.lit(S2), "spread_5y": F.lit(S5)}
    )
    out = FN.with_funding_components(df).withColumns(
        {"label": FN.tenor_label("period_years"), "bucket": FN.market_bucket("period_years")}
    )
    return {r["period_years"]: r for r in out.collect()}


@pytest.mark.parametrize("y", YEARS)
def test_components_match_rules(computed, y):
    r = computed[y]
    model, w2, w5, policy, spread, rf, cb = expected(y)
    assert r["funding_model"] == model
    assert r["funding_weight_2y"] == pytest.approx(w2, abs=0)
    assert r["funding_weight_5y"] == pytest.approx(w5, abs=0)
    assert r["policy_anchor_component"] == policy
    assert r["short_rate_spread_component"] == spread
    assert r["risk_free_curve_component"] == pytest.approx(rf, abs=1e-12)
    assert r["covered_bond_spread_component"] == pytest.approx(cb, abs=1e-12)


def test_weights_sum_to_one(computed):
    for y, r in computed.items():
        assert r["funding_weight_2y"] + r["funding_weight_5y"] == pytest.approx(1.0, abs=2e-4), y


def test_curve_continuous_at_knots(computed):
    def total(r):
        return r["risk_free_curve_component"] + r["covered_bond_spread_component"]

    assert total(computed[2.0001]) == pytest.approx(total(computed[2.0]), abs=1e-3)
    assert total(computed[4.9999]) == pytest.approx(total(computed[5.0]), abs=1e-3)


def test_tenor_labels(computed):
    assert computed[0.25]["label"] == "0.25Y"
    assert computed[1.0]["label"] == "01Y"
    assert computed[0.9]["label"] == "01Y"          # nearest quarter
    assert computed[0.5]["label"] == "006M"
    assert computed[1.5]["label"] == "018M"
    assert computed[10.0]["label"] == "10Y"
    assert computed[100.0]["label"] == "120M"       # lpad truncates to 3 characters
    assert computed[None]["label"] is None


def test_market_buckets(computed):
    want = {0.25: "3M", 1.0: "1Y", 2.0: "2Y", 3.0: "3-5Y", 4.0: "3-5Y", 5.0: "3-5Y", 5.0001: "5Y+", 7.0: "5Y+",
            0.5: None, 1.5: None, 2.5: None, 0.9: None, None: None}
    for y, b in want.items():
        assert computed[y]["bucket"] == b, y


def test_null_tenor_takes_long_model(computed):
    r = computed[None]
    assert r["funding_model"] == "five_year_covered_bond_proxy"
    assert r["risk_free_curve_component"] == G5 and not math.isnan(r["covered_bond_spread_component"])
