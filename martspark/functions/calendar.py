"""Month-to-date windows and local dates of UTC instants.

The reference derives ``start_date``/``end_date`` from ``CURRENT_DATE()``
in a one-row relation cross-joined into every branch. Here the run date is
an explicit argument and the bounds become literals, so every date
predicate folds to a constant range that reaches the parquet scan.

Instants are TIMESTAMP_NTZ columns holding the UTC wall clock (the
declared source schemas, and how the driver tables store them);
``convert_timezone`` with explicit zones and string-built literals keep
every result independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "Asia/Jakarta"


@dataclass(frozen=True)
class MonthWindow:
    """Inclusive local-date window ``[start, end]``."""

    start: dt.date
    end: dt.date

    @property
    def month(self) -> dt.date:
        return self.start.replace(day=1)

    def contains(self, col: Column) -> Column:
        """Inclusive BETWEEN on a DATE column."""
        return col.between(F.lit(self.start), F.lit(self.end))


def ntz_literal(value: dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal, independent of driver and session zones."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def month_to_date(run_date: dt.date) -> MonthWindow:
    """First of yesterday's month .. yesterday.

    On the 1st of a month this is the whole previous month.
    """
    end = run_date - dt.timedelta(days=1)
    return MonthWindow(start=end.replace(day=1), end=end)


FAST_FROM = dt.datetime(1970, 1, 1)
FAST_UNTIL = dt.datetime(2100, 1, 1)


@lru_cache(maxsize=64)
def constant_offset(tz: str) -> dt.timedelta | None:
    """The zone's UTC offset when it is the same on every day from 1970 to
    2100 (no DST, no rule change), else None. Checked daily on the driver."""
    zone = ZoneInfo(tz)
    utc = dt.timezone.utc
    first = None
    day = FAST_FROM
    while day < FAST_UNTIL:
        off = day.replace(tzinfo=utc).astimezone(zone).utcoffset()
        if first is None:
            first = off
        elif off != first:
            return None
        day += dt.timedelta(days=1)
    return first


def local_datetime(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    """Wall clock in ``tz`` of a UTC instant (TIMESTAMP_NTZ result).

    For a zone with one offset since 1970 (e.g. Asia/Jakarta, +07:00), the
    wall clock of an instant from 1970 on is ``ts + offset``: plain
    arithmetic inside codegen instead of a per-row zone-rules lookup.
    Other instants and other zones use ``convert_timezone``; both give the
    same result.
    """
    exact = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)
    off = constant_offset(tz)
    if off is None:
        return exact
    secs = int(off.total_seconds())
    shifted = ts + F.make_dt_interval(secs=F.lit(secs))
    lo = ntz_literal(FAST_FROM)
    hi = ntz_literal(FAST_UNTIL - dt.timedelta(days=1))
    return F.when((ts >= lo) & (ts < hi), shifted).otherwise(exact)


def local_date(ts: Column, tz: str = DEFAULT_TZ) -> Column:
    """``DATE(ts, tz)`` of a UTC instant."""
    return F.to_date(local_datetime(ts, tz))


def utc_bounds(window: MonthWindow, tz: str = DEFAULT_TZ) -> tuple[dt.datetime, dt.datetime]:
    """UTC instants ``[lo, hi)`` covering local dates ``window.start..end``.

    Computed on the driver so the range predicate is a pushable literal
    comparison on the raw column (a timezone shift in the predicate would
    leave only ``IsNotNull`` in PushedFilters).
    """
    zone = ZoneInfo(tz)
    utc = dt.timezone.utc

    def to_utc(day: dt.date) -> dt.datetime:
        local = dt.datetime.combine(day, dt.time(0), tzinfo=zone)
        return local.astimezone(utc).replace(tzinfo=None)

    return to_utc(window.start), to_utc(window.end + dt.timedelta(days=1))


def in_local_window(ts: Column, window: MonthWindow, tz: str = DEFAULT_TZ) -> Column:
    """``DATE(ts, tz) BETWEEN start AND end`` as a pushable UTC range."""
    lo, hi = utc_bounds(window, tz)
    return (ts >= ntz_literal(lo)) & (ts < ntz_literal(hi))


def local_datetime_between_dates(ts: Column, window: MonthWindow,
                                 tz: str = DEFAULT_TZ) -> Column:
    """C3 literal form: ``DATETIME(ts, tz) BETWEEN start AND end``.

    The DATE bounds compare as midnight, so everything after 00:00:00 of
    the end date falls out. Kept for the side-by-side query; marts use
    :func:`in_local_window`.
    """
    start = ntz_literal(dt.datetime.combine(window.start, dt.time(0)))
    end = ntz_literal(dt.datetime.combine(window.end, dt.time(0)))
    return local_datetime(ts, tz).between(start, end)


def month_of(date_col: Column) -> Column:
    """I4 on a DATE: first day of its month, as DATE."""
    return F.trunc(date_col, "MM")
