"""Time helpers.  All report timestamps are wall-clock ``timestamp_ntz`` values.

None of these depends on the session time zone for ``timestamp_ntz`` input: the zone shift is
``convert_timezone`` between named zones and epoch seconds are computed from the wall-clock
fields.  A ``timestamp`` (with zone) input is first read as wall clock in the session zone,
which a cluster pins to UTC.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------------------
LOCAL_TZ = "Asia/Bahrain"  # report time zone (UTC+3, no daylight saving)
DAYS_PER_MONTH = Decimal("30.417")  # contract length in months = days / 30.417, rounded
# -------------------------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock(ts: str | Column) -> Column:
    return _c(ts).cast("timestamp_ntz")


def local_time(ts: str | Column, tz: str = LOCAL_TZ) -> Column:
    """UTC wall clock -> local wall clock (what ``from_utc_timestamp(ts, tz)`` does)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), wall_clock(ts))


def local_date(ts: str | Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def on_or_after(day: Column, start: str) -> Column:
    """``to_date(...) >= 'yyyy-mm-dd'`` with the literal typed as a date."""
    return day >= F.lit(start).cast("date")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 of the wall clock (``cast(ts as bigint)``: the
    fraction of the second is dropped, i.e. floored)."""
    w = wall_clock(ts)
    return (
        F.unix_date(F.to_date(w)).cast("long") * 86400
        + F.hour(w) * 3600
        + F.minute(w) * 60
        + F.second(w)
    )


def days_between(end: str | Column, start: str | Column) -> Column:
    """``datediff(end, start)``: calendar days from start to end."""
    return F.datediff(_c(end), _c(start))


def contract_months(end: str | Column, start: str | Column) -> Column:
    """``round(datediff(end, start) / 30.417, 0)`` as a double."""
    return F.round(days_between(end, start) / F.lit(DAYS_PER_MONTH), 0).cast("double")


def sales_date(ts: str | Column) -> Column:
    return F.to_date(_c(ts))


def sales_hour(ts: str | Column) -> Column:
    return F.hour(_c(ts))
