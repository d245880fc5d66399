"""Numeric coercion, Likert clipping, rescaling and rounding (native expressions).

Rounding is always banker's rounding on the decimal representation
(``F.bround``); ``F.round`` (half-up) is never used for report values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal or scientific number, optionally signed and space-padded.
# Spark's cast would also accept "3.5d", "NaN" and "Infinity"; those are not
# numbers for a survey cell, so they are rejected before the cast.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Likert answers live on 1..4, the report scale is 0..10.
LIKERT_MIN = 1.0
LIKERT_MAX = 4.0
TEN_OVER_THREE = 10.0 / 3.0


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text -> DOUBLE, junk -> NULL. Numeric input columns pass straight through."""
    s = _as_col(c).cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))


def to_number_decimal_comma(c: Column | str) -> Column:
    """C14: like C5 but "1,5" reads as 1.5."""
    return to_number(F.regexp_replace(_as_col(c).cast("string"), ",", "."))


def clip_likert(v: Column | str) -> Column:
    """Clamp to [1, 4] keeping NULL as NULL (bare greatest/least would not)."""
    v = _as_col(v)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(LIKERT_MIN)), F.lit(LIKERT_MAX)))


def likert_score(c: Column | str) -> Column:
    """C5 + C6: the per-cell value every 1..4 average is built from."""
    return clip_likert(to_number(c))


def round_half_even(v: Column | str, scale: int) -> Column:
    """C7."""
    return F.bround(_as_col(v), scale)


def scale4_to_10(mean4: Column | str) -> Column:
    """Round the 1..4 mean to 1 dp, map onto 0..10, round to 1 dp."""
    m = F.bround(_as_col(mean4), 1)
    return F.bround((m - F.lit(1.0)) * F.lit(TEN_OVER_THREE), 1)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """Num / den as DOUBLE, 0.0 when the denominator is 0 or NULL."""
    num, den = _as_col(num), _as_col(den)
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """round((num / den) * 100, scale); 0.0 for an empty denominator."""
    return F.bround(safe_ratio(num, den) * F.lit(100.0), scale)


def zero_as_null(v: Column | str) -> Column:
    """0.0 means "no data"; turn it (and NULL) into NULL."""
    return F.nullif(_as_col(v), F.lit(0.0))


def or_zero(v: Column | str) -> Column:
    """Report surface: NULL -> 0.0."""
    return F.coalesce(_as_col(v), F.lit(0.0))


def fixed(v: Column | str, decimals: int) -> Column:
    """Display text with a fixed number of decimals (for report rendering only)."""
    return F.format_string(f"%.{int(decimals)}f", _as_col(v))
