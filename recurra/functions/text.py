"""Formatting helpers used in ids and alert text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, n: Column, width: int) -> Column:
    """'PREFIX-000042': padded to ``width``, and never cut."""
    digits = n.cast("string")
    return F.concat(F.lit(prefix + "-"), F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits))


def money_text(c: Column) -> Column:
    """1234.5 -> '1,234.50'."""
    return F.format_number(c, 2)


def percent_text(ratio: Column, digits: int = 4) -> Column:
    """0.0012345 -> '0.1235%'."""
    return F.concat(F.format_string(f"%.{digits}f", ratio * F.lit(100.0)), F.lit("%"))
