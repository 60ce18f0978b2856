"""Report-window arithmetic.

The report for date D covers the closed interval [D-1 08:00, D 08:00].  A range
of report dates [start, end] is handled in one pass: every activity time is
mapped to the report date(s) whose window holds it, so no range join is needed.
A timestamp exactly at 08:00 lies in two consecutive windows and maps to both.
A DATE value means midnight, which only the window of that same date holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from reachlens.specs import WINDOW_HOUR


def _shift() -> Column:
    return F.expr(f"INTERVAL {WINDOW_HOUR} HOURS")


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def window_bounds(start: dt.date | str, end: dt.date | str | None = None
                  ) -> tuple[dt.datetime, dt.datetime]:
    """Lowest and highest instant covered by report dates start..end."""
    start = as_date(start)
    end = as_date(end) if end is not None else start
    hour = dt.time(WINDOW_HOUR)
    lo = dt.datetime.combine(start - dt.timedelta(days=1), hour)
    hi = dt.datetime.combine(end, hour)
    return lo, hi


def in_window(col: str, dtype: DataType, start, end=None) -> Column:
    """Closed-window test written on the column's own type so the scan can
    push it down (no cast on the column side)."""
    start = as_date(start)
    end = as_date(end) if end is not None else start
    if isinstance(dtype, DateType):
        return F.expr(f"`{col}` BETWEEN DATE'{start}' AND DATE'{end}'")
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        lo, hi = window_bounds(start, end)
        return F.expr(f"`{col}` BETWEEN timestamp_ntz'{lo}' AND timestamp_ntz'{hi}'")
    raise TypeError(f"window column {col} has unsupported type {dtype}")


def report_dates(col: str, dtype: DataType) -> Column:
    """Array of the report dates whose window holds the value (one, or two for
    a timestamp exactly on the 08:00 boundary)."""
    if isinstance(dtype, DateType):
        return F.expr(f"array(`{col}`)")
    shifted = f"(`{col}` - INTERVAL {WINDOW_HOUR} HOURS)"
    day = f"CAST({shifted} AS DATE)"
    return F.expr(f"CASE WHEN {shifted} = CAST({day} AS TIMESTAMP_NTZ) "
                  f"THEN array({day}, date_add({day}, 1)) ELSE array(date_add({day}, 1)) END")


def in_date_range(col: str, start, end) -> Column:
    return F.expr(f"`{col}` BETWEEN DATE'{as_date(start)}' AND DATE'{as_date(end)}'")


def date_range_column(start, end) -> Column:
    """Array of all report dates start..end (one row per date after explode)."""
    return F.expr(f"sequence(DATE'{as_date(start)}', DATE'{as_date(end)}', INTERVAL 1 DAY)")


def window_start(report_date: Column) -> Column:
    return F.date_sub(report_date, 1).cast("timestamp_ntz") + _shift()


def window_end(report_date: Column) -> Column:
    return report_date.cast("timestamp_ntz") + _shift()


def period_label(ts: Column) -> Column:
    """e.g. ``14-Jan-2024 (08:00 AM)``."""
    return F.date_format(ts, "dd-MMM-yyyy (hh:mm a)")
