"""Time parsing, rounding and key formatting."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from railpulse import settings as S


def wall_clock(moment: datetime | None) -> Column:
    """A wall-clock time of the session zone as a timestamp.

    ``F.lit`` of a datetime without a zone would read it in the zone of the driver's
    machine, which need not be the session's. The cast folds to a constant, so
    comparisons with it still reach the file scan.
    """
    text = None if moment is None else f"{moment:%Y-%m-%d %H:%M:%S.%f}"
    return F.lit(text).cast("timestamp")


class Window(NamedTuple):
    """A half-open range ``[start, end)`` of local wall-clock time."""

    start: datetime
    end: datetime

    def holds(self, column: Column) -> Column:
        return (column >= wall_clock(self.start)) & (column < wall_clock(self.end))


class DayParts(NamedTuple):
    year: int
    month: int
    day: int


def parse_ts(column: Column, patterns: Sequence[str] = S.TIMESTAMP_PATTERNS) -> Column:
    """Timestamp from text by the first pattern that fits, null when none does."""
    return F.coalesce(*(F.try_to_timestamp(column, F.lit(p)) for p in patterns))


def parse_iso_ts(column: Column) -> Column:
    """Timestamp from ISO text (or a timestamp passed through), null when unreadable."""
    return column.try_cast("timestamp")


def parse_day(column: Column, pattern: str = S.DAY_PATTERN) -> Column:
    """Date from text such as ``20240131``, null when unreadable."""
    return F.try_to_timestamp(column.cast("string"), F.lit(pattern)).cast("date")


def first_time(*columns: str | Column) -> Column:
    """Event time: the first of the given times that is known."""
    return F.coalesce(
        *(parse_iso_ts(F.col(c) if isinstance(c, str) else c) for c in columns)
    )


def floor_time(column: Column, minutes: int = S.SLIDE_MINUTES) -> Column:
    """Start of the ``minutes``-long slot, aligned to the epoch, that holds the time."""
    micros = F.unix_micros(column)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(minutes * 60_000_000)))


def floor_instant(moment: datetime, minutes: int = S.SLIDE_MINUTES) -> datetime:
    """Driver-side twin of :func:`floor_time` for wall-clock run arguments."""
    return moment - timedelta(
        minutes=moment.minute % minutes,
        seconds=moment.second,
        microseconds=moment.microsecond,
    )


def window_ending_at(
    as_of: datetime,
    *,
    minutes: int = S.WINDOW_MINUTES,
    slide: int = S.SLIDE_MINUTES,
) -> Window:
    """The newest complete window at ``as_of``."""
    end = floor_instant(as_of, slide)
    return Window(end - timedelta(minutes=minutes), end)


def day_parts(ymd: str) -> DayParts:
    """Year, month and day of a ``yyyyMMdd`` run argument."""
    parsed = datetime.strptime(ymd, "%Y%m%d")
    return DayParts(parsed.year, parsed.month, parsed.day)


def day_part_columns(day: Column) -> dict[str, Column]:
    """Integer partition columns of a date or timestamp column."""
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def hour_part_columns(moment: Column) -> dict[str, Column]:
    return {**day_part_columns(moment), "hour": F.hour(moment)}


def day_before(day: str | date, lag_days: int) -> date:
    """The date ``lag_days`` before a run day given as ``yyyyMMdd`` text or date."""
    if isinstance(day, str):
        day = date(*day_parts(day))
    return day - timedelta(days=lag_days)


def run_day(
    requested: str | None = None,
    *,
    now: datetime | None = None,
    lag_days: int = 0,
    zone: str = S.SERVICE_ZONE,
) -> str:
    """Target day of a run: the requested one, else local today less a lag."""
    if requested:
        day_parts(requested)
        return requested
    now = now or datetime.now(timezone.utc)
    local_today = now.astimezone(ZoneInfo(zone)).date()
    return f"{day_before(local_today, lag_days):%Y%m%d}"


def minute_key(column: Column) -> Column:
    return F.date_format(column, S.MINUTE_PATTERN)


def day_key(column: Column) -> Column:
    return F.date_format(column, S.DAY_PATTERN)


def run_key(column: Column) -> Column:
    return F.date_format(column, S.RUN_PATTERN)


def display_time(column: Column) -> Column:
    return F.date_format(column, S.DISPLAY_PATTERN)


def local_time(utc: Column, zone: str = S.SERVICE_ZONE) -> Column:
    """UTC wall-clock time shown in the service zone."""
    return F.from_utc_timestamp(utc, zone)
