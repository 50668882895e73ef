"""Ages, month keys and default timestamps. The reference day is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _month_day(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def age_calendar_years(birth: Column, as_of: Column) -> Column:
    """Difference of the year numbers, whether or not the birthday has come."""
    return F.year(as_of) - F.year(birth)


def age_completed_years(birth: Column, as_of: Column) -> Column:
    """Completed years, towards zero.

    Someone born on 29 February completes a year on 1 March of common years.
    ``months_between`` is not used because it calls 28 February a full month for them.
    """
    early, late = F.least(birth, as_of), F.greatest(birth, as_of)
    not_reached = (_month_day(late) < _month_day(early)).cast("int")
    years = F.year(late) - F.year(early) - not_reached
    known = birth.isNotNull() & as_of.isNotNull()
    return F.when(known, F.when(birth <= as_of, years).otherwise(-years))


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def or_now(ts: Column) -> Column:
    """Column default of the load timestamps."""
    return F.coalesce(ts, F.current_timestamp())
