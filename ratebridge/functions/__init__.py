"""Column-expression builders (JVM-side, codegen-friendly)."""

from ratebridge.functions.dates import (  # noqa: F401
    age_days,
    as_of_column,
    freshness_level,
    lookback_month,
    lookback_start,
    month_code_to_iso,
    month_start,
)
from ratebridge.functions.funding import (  # noqa: F401
    covered_bond_spread,
    funding_model,
    funding_source,
    interpolate_two_point,
    market_bucket,
    policy_anchor,
    risk_free_curve,
    short_rate_spread,
    tenor_label,
    weight_high,
    weight_low,
    with_funding_components,
)
from ratebridge.functions.text import normalize_cell, parse_decimal_comma, parse_rate, valid_from_in  # noqa: F401
