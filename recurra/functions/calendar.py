"""Calendar helpers. All take and return Columns; no Python per row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column | str) -> Column:
    """DATE_TRUNC(DATE(x), MONTH) as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(c), "MM")


def next_billing_date(c: Column | str, months: int = 1) -> Column:
    """d + n months, clamped to the month end (2024-01-31 -> 2024-02-29)."""
    return F.add_months(c, months)


def not_after_day(ts: Column | str, day: dt.date | str) -> Column:
    """``DATE(ts) <= day`` in a sargable form (``ts < day + 1``) that the
    Parquet reader can push down."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    bound = dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
    return F.col(ts) < F.lit(bound).cast("timestamp_ntz") if isinstance(ts, str) \
        else ts < F.lit(bound).cast("timestamp_ntz")
