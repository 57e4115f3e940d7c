"""Time helpers used by the window and age operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours_between(later: Column, earlier: Column) -> Column:
    """(unix seconds of ``later`` - unix seconds of ``earlier``) / 3600, seconds truncated."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(3600)


def plus_hours(ts: Column, hours) -> Column:
    """``ts + hours`` to the second, fractions of an hour included."""
    h = hours if isinstance(hours, Column) else F.lit(float(hours))
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (h * 3600).cast("decimal(18,6)"))


def years_by_months(later: Column, earlier: Column) -> Column:
    """``months_between(later, earlier) / 12`` (Spark rounds months_between to 8 dp)."""
    return F.months_between(later, earlier) / F.lit(12)


def years_by_days(later: Column, earlier: Column) -> Column:
    """``datediff(later, earlier) / 365.25`` as double (the SQL literal form yields a decimal)."""
    return F.datediff(later.cast("date"), earlier.cast("date")).cast("double") / F.lit(365.25)
