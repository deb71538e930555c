"""Date-range handling: bounds, default range, rendering, request checks.

* A range ``start..end`` (``YYYY-MM-DD``) covers ``start 00:00:00`` to
  ``end 23:59:59`` in whole seconds, both ends inclusive, in one explicit
  time zone (default UTC). The bounds are literals, so the filter reaches
  the scan (``PushedFilters``) when ``created_at`` is a typed column.
* The default range is one month before ``as_of`` (day clamped to the
  month's end) to the day before ``as_of``.
* A request is checked in this order: start required, end required, start
  format, end format, start not after end (equal is valid); extra keys are
  ignored. Error codes replace the reference's message texts.
"""

from __future__ import annotations

import calendar
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: accepted date text and rendered formats -----------------
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DATE_FORMAT = "yyyy-MM-dd"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def range_bounds(start: str, end: str, tz: str = "UTC") -> tuple[int, int]:
    """Epoch seconds of ``start 00:00:00`` and ``end 23:59:59`` in ``tz``."""
    zone = ZoneInfo(tz)
    lo = dt.datetime.strptime(start, "%Y-%m-%d").replace(tzinfo=zone)
    hi = dt.datetime.strptime(end, "%Y-%m-%d").replace(hour=23, minute=59, second=59, tzinfo=zone)
    return int(lo.timestamp()), int(hi.timestamp())


def filter_date_range(df: DataFrame, start: str, end: str, column: str | Column = "created_at",
                      tz: str = "UTC") -> DataFrame:
    lo, hi = range_bounds(start, end, tz)
    col = F.col(column) if isinstance(column, str) else column
    return df.filter((col >= F.lit(lo)) & (col <= F.lit(hi)))


def default_range(as_of: dt.date) -> tuple[str, str]:
    """(as_of minus one month, as_of minus one day) as ``YYYY-MM-DD``."""
    year, month = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    day = min(as_of.day, calendar.monthrange(year, month)[1])
    return dt.date(year, month, day).isoformat(), (as_of - dt.timedelta(days=1)).isoformat()


def default_range_columns(as_of: Column) -> tuple[Column, Column]:
    """Same rule as ``default_range`` for a column of dates."""
    return F.add_months(as_of, -1), F.date_sub(as_of, 1)


def rendered_dates(created_at: Column, tz: str = "UTC") -> tuple[Column, Column]:
    """(``date``, ``timestamp``) text of an epoch in zone ``tz``, NULL when the
    epoch is 0 or missing. Built from day numbers and seconds of the day, so
    the result does not depend on the session time zone."""
    secs = F.floor(created_at).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(secs / 86400).cast("int"))
    sod = secs - F.floor(secs / 86400).cast("long") * 86400
    wall = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                (sod / 3600).cast("int"), ((sod % 3600) / 60).cast("int"), (sod % 60).cast("int"))
    if tz != "UTC":
        wall = F.convert_timezone(F.lit("UTC"), F.lit(tz), wall)
    present = F.coalesce(created_at, F.lit(0)) != 0
    return (F.when(present, F.date_format(wall, DATE_FORMAT)),
            F.when(present, F.date_format(wall, ISO_FORMAT)))


def epoch_seconds(ts: Column, dtype: str) -> Column:
    """Epoch seconds of a timestamp column; a TIMESTAMP_NTZ value is read as
    UTC wall-clock time whatever the session time zone."""
    if dtype == "timestamp_ntz":
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.unix_seconds(ts)


def is_valid_date_text(text: Column) -> Column:
    """``YYYY-MM-DD`` that names a real calendar day (year 1 or later)."""
    parsed = F.try_to_date(text, DATE_FORMAT)
    return F.coalesce(
        text.rlike(DATE_PATTERN) & parsed.isNotNull() & (F.substring(text, 1, 4) != "0000"),
        F.lit(False),
    )


def request_error(start: Column, end: Column) -> Column:
    """Error code of an extraction request, NULL when it is valid."""
    missing = lambda c: c.isNull() | (c == "")
    return (
        F.when(missing(start), F.lit("start_required"))
        .when(missing(end), F.lit("end_required"))
        .when(~is_valid_date_text(start), F.lit("start_invalid"))
        .when(~is_valid_date_text(end), F.lit("end_invalid"))
        .when(F.try_to_date(start, DATE_FORMAT) > F.try_to_date(end, DATE_FORMAT),
              F.lit("start_after_end"))
    )
