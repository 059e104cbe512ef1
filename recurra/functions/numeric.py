"""Ratios and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE: null when the divisor is zero or null; computed in double."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def relative_gap(value: Column, reference: Column) -> Column:
    """|value - reference| / reference in double, null when reference is 0."""
    return safe_divide(F.abs(value.cast("double") - reference.cast("double")), reference)


def threshold_status(gap: Column, threshold: float = 0.001) -> Column:
    """'OK' when gap <= threshold (inclusive), else 'KO'."""
    return F.when(gap <= F.lit(threshold), F.lit("OK")).otherwise(F.lit("KO"))
