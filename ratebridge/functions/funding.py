"""Funding-proxy expressions over a tenor in years (pure Column builders).

Every function returns a ``Column`` so the whole funding model stays inside
whole-stage codegen; none of them touches Python at execution time.

Boundaries (tenor ``y`` in years): ``y <= 1`` short (variable) bucket,
``1 < y <= 2`` 2Y point, ``2 < y < 5`` linear blend of the 2Y and 5Y points,
``y >= 5`` 5Y point. A NULL tenor fails every comparison and lands in the last
branch, as a searched CASE does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratebridge import schemas as S

SHORT_MAX = 1.0
LOW_POINT = 2.0
HIGH_POINT = 5.0
SPAN = HIGH_POINT - LOW_POINT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def funding_model(y: Column | str) -> Column:
    y = _c(y)
    return (
        F.when(y <= SHORT_MAX, F.lit(S.FUNDING_MODEL_SHORT))
        .when(y < HIGH_POINT, F.lit(S.FUNDING_MODEL_INTERPOLATED))
        .otherwise(F.lit(S.FUNDING_MODEL_LONG))
    )


def funding_source(y: Column | str) -> Column:
    y = _c(y)
    return (
        F.when(y <= SHORT_MAX, F.lit(S.FUNDING_SOURCE_SHORT))
        .when(y < HIGH_POINT, F.lit(S.FUNDING_SOURCE_INTERPOLATED))
        .otherwise(F.lit(S.FUNDING_SOURCE_LONG))
    )


def _low_weight(y: Column) -> Column:
    return (F.lit(HIGH_POINT) - y) / SPAN


def _high_weight(y: Column) -> Column:
    return (y - F.lit(LOW_POINT)) / SPAN


def weight_low(y: Column | str) -> Column:
    """Display weight on the 2Y point, rounded to 4 dp (1.0 for short tenors too)."""
    y = _c(y)
    return (
        F.when(y <= LOW_POINT, F.lit(1.0))
        .when(y < HIGH_POINT, F.round(_low_weight(y), 4))
        .otherwise(F.lit(0.0))
    )


def weight_high(y: Column | str) -> Column:
    """Display weight on the 5Y point, rounded to 4 dp."""
    y = _c(y)
    return (
        F.when(y <= LOW_POINT, F.lit(0.0))
        .when(y < HIGH_POINT, F.round(_high_weight(y), 4))
        .otherwise(F.lit(1.0))
    )


def interpolate_two_point(y: Column | str, low: Column | str, high: Column | str) -> Column:
    """round(w2 * low + w5 * high, 4) with the UNROUNDED weights."""
    y = _c(y)
    return F.round(_low_weight(y) * _c(low) + _high_weight(y) * _c(high), 4)


def policy_anchor(y: Column | str, policy_rate: Column | str) -> Column:
    y = _c(y)
    return F.when(y <= SHORT_MAX, _c(policy_rate)).otherwise(F.lit(0.0))


def short_rate_spread(y: Column | str, short_spread: Column | str) -> Column:
    y = _c(y)
    return F.when(y <= SHORT_MAX, F.coalesce(_c(short_spread), F.lit(0.0))).otherwise(F.lit(0.0))


def risk_free_curve(y: Column | str, gov_low: Column | str, gov_high: Column | str) -> Column:
    y = _c(y)
    return (
        F.when(y <= SHORT_MAX, F.lit(0.0))
        .when(y <= LOW_POINT, _c(gov_low))
        .when(y < HIGH_POINT, interpolate_two_point(y, gov_low, gov_high))
        .otherwise(_c(gov_high))
    )


def covered_bond_spread(y: Column | str, spread_low: Column | str, spread_high: Column | str) -> Column:
    """Short tenors use the 5Y spread (swapped long funding), not the 2Y one."""
    y = _c(y)
    return (
        F.when(y <= SHORT_MAX, _c(spread_high))
        .when(y <= LOW_POINT, _c(spread_low))
        .when(y < HIGH_POINT, interpolate_two_point(y, spread_low, spread_high))
        .otherwise(_c(spread_high))
    )


COMPONENT_COLUMNS = [
    "policy_anchor_component",
    "short_rate_spread_component",
    "risk_free_curve_component",
    "covered_bond_spread_component",
]


def component_sum() -> Column:
    """Unrounded sum of the four components (margins use this, not funding_cost)."""
    total = F.col(COMPONENT_COLUMNS[0])
    for name in COMPONENT_COLUMNS[1:]:
        total = total + F.col(name)
    return total


def margin_over_funding(rate: Column | str) -> Column:
    return F.round(_c(rate) - component_sum(), 4)


def tenor_label(y: Column | str) -> Column:
    """Sortable label: quarter-year grid points map to fixed labels, the rest to NNNM."""
    y = _c(y)
    quarters = F.round(y * 4).cast("int")
    months = F.lpad(F.round(y * 12).cast("int").cast("string"), 3, "0")
    expr = None
    for q, label in S.TENOR_LABELS:
        expr = F.when(quarters == q, F.lit(label)) if expr is None else expr.when(quarters == q, F.lit(label))
    return expr.otherwise(F.concat(months, F.lit("M")))


def market_bucket(y: Column | str) -> Column:
    """SCB bucket of a bank tenor; off-grid tenors (0.5, 1.5, 2.5, ...) give NULL."""
    y = _c(y)
    return (
        F.when(y == 0.25, F.lit("3M"))
        .when(y == 1.0, F.lit("1Y"))
        .when(y == 2.0, F.lit("2Y"))
        .when((y >= 3.0) & (y <= 5.0), F.lit("3-5Y"))
        .when(y > 5.0, F.lit("5Y+"))
    )


def with_funding_components(df, years: str = "period_years"):
    """Add funding model, weights and the four components; expects market columns
    policy_rate, swestr_policy_spread_3m, govbond_2y, govbond_5y, spread_2y, spread_5y."""
    y = F.col(years)
    return df.withColumns(
        {
            "funding_model": funding_model(y),
            "funding_weight_2y": weight_low(y),
            "funding_weight_5y": weight_high(y),
            "policy_anchor_component": policy_anchor(y, "policy_rate"),
            "short_rate_spread_component": short_rate_spread(y, "swestr_policy_spread_3m"),
            "risk_free_curve_component": risk_free_curve(y, "govbond_2y", "govbond_5y"),
            "covered_bond_spread_component": covered_bond_spread(y, "spread_2y", "spread_5y"),
        }
    )
