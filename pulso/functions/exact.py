"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a mean that lies on a rounding tie could fall either way with another partitioning. Here a double is
taken apart into integers without loss, the integers are added as DECIMAL(38, 0), and one double is made of the sum.

* Any value: the whole part and the fraction in units of 2^-84, which holds every bit of a double from about 1e-9 on (smaller values are
  cut there, each on its own, so the sum still has no order). Infinite, NaN and beyond 2^62, where no survey value lies, are added as doubles aside.
* Likert scores (1 to 4): one integer in units of 2^-52, exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"
PARTS = ("sum", "part", "odd")      # column suffixes of an exact sum
_HALF = 42                          # bits of the fraction taken at once
_LIKERT_UNIT = 2.0**52


def sums(v: Column, name: str) -> list[Column]:
    """Aggregates {name}_sum, {name}_part and {name}_odd of a double column."""
    usual = F.abs(v) < F.lit(2.0**62)       # false for NaN, which is greater than all
    whole = F.floor(v)
    fine = (v - whole) * F.lit(2.0**_HALF)
    first = F.floor(fine)
    second = F.floor((fine - first) * F.lit(2.0**_HALF))
    part = first.cast(WIDE) * F.lit(2**_HALF).cast("decimal(13,0)") + second.cast(WIDE)
    return [F.sum(F.when(usual, whole.cast(WIDE))).alias(f"{name}_sum"), F.sum(F.when(usual, part.cast(WIDE))).alias(f"{name}_part"),
            F.sum(F.when(~usual, v)).alias(f"{name}_odd")]


def no_sums(name: str) -> list[Column]:
    """The columns of ``sums`` over nothing."""
    return [F.lit(None).cast("double" if p == "odd" else WIDE).alias(f"{name}_{p}") for p in PARTS]


def add_up(name: str) -> list[Column]:
    """Aggregates that add up rows of ``sums``."""
    return [F.sum(f"{name}_{p}").alias(f"{name}_{p}") for p in PARTS]


def total(name: str, cond: Column | None = None) -> Column:
    """The aggregate sum as a double, over rows of ``sums`` that fulfil a condition; NULL over nothing."""
    whole, part, odd = (F.sum(F.col(f"{name}_{p}") if cond is None else F.when(cond, F.col(f"{name}_{p}"))) for p in PARTS)
    unit = F.lit(str(2 ** (2 * _HALF))).cast("decimal(26,0)")
    rest = F.pmod(part, unit)
    carried = ((part - rest) / unit).cast(WIDE)
    usual = (whole + carried).cast("double") + rest.cast("double") / F.lit(2.0 ** (2 * _HALF))
    return F.when(odd.isNull(), usual).otherwise(F.coalesce(usual, F.lit(0.0)) + odd)


def likert_sum(s: Column) -> Column:
    """Aggregate sum of clipped scores in units of 2^-52."""
    return F.sum((s * F.lit(_LIKERT_UNIT)).cast("bigint").cast("decimal(28,0)"))


def likert_mean(total_units: Column, count: Column) -> Column:
    """Mean of clipped scores from ``likert_sum`` and their count; NULL without any."""
    return F.try_divide(total_units.cast("double") / F.lit(_LIKERT_UNIT), count.cast("double"))
