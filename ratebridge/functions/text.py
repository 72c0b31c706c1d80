"""Text-to-number parsing used by the payload extractors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = "\u00a0"
# Leading or trailing Unicode white space (Java's \s is ASCII-only without (?U)).
EDGE_SPACE = r"(?U)^\s+|\s+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_rate(text: Column | str) -> Column:
    """'4,25 %' / '4.25%' / with no-break spaces -> 4.25; anything unparsable -> NULL."""
    t = _c(text)
    cleaned = F.replace(F.replace(F.replace(t, F.lit(NBSP), F.lit("")), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return F.regexp_replace(cleaned, EDGE_SPACE, "").try_cast("double")


def parse_decimal_comma(text: Column | str) -> Column:
    """Strict decimal-comma number ('3,5' -> 3.5); bad text raises under ANSI."""
    return F.replace(_c(text), F.lit(","), F.lit(".")).cast("double")


def normalize_cell(text: Column | str) -> Column:
    """No-break spaces become plain spaces, then edge white space is removed."""
    return F.regexp_replace(F.replace(_c(text), F.lit(NBSP), F.lit(" ")), EDGE_SPACE, "")


# Day, month word and year, as an effective-from date appears in a header.
VALID_FROM_PATTERN = r"(?U)(\d{1,2}\s+\w+\s+\d{4})"


def valid_from_in(text: Column | str) -> Column:
    """First day-month-year phrase in the text, '' when there is none."""
    return F.regexp_extract(_c(text), VALID_FROM_PATTERN, 1)
