"""Report windows as pure functions of ``now``.

``now`` is the naive UTC wall clock of the run and is always passed in, so a run
can be repeated.  ``zone`` is the zone local dates are taken in and ``bounds`` the
zone window bounds are stored in (both default to no shift).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.functions.timefn import ColumnLike, col

MALAYSIA = "Asia/Kuala_Lumpur"
FILED_MONTH = "FiledMonth"  # partition column, yyyymm, of tables that are filed by month


@dataclass(frozen=True)
class Window:
    """A range over a timestamp or date column; half-open unless told otherwise."""

    start: datetime | None
    end: datetime | None
    start_closed: bool = True
    end_closed: bool = False

    def shift(self, hours: int) -> "Window":
        """The same window moved, so a shifted column can be tested unshifted."""
        delta = timedelta(hours=hours)
        return Window(
            self.start + delta if self.start else None,
            self.end + delta if self.end else None,
            self.start_closed,
            self.end_closed,
        )

    def covers(self, c: ColumnLike) -> Column:
        """Bounds as literals on the bare column, so they reach the scan."""
        column, tests = col(c), []
        if self.start is not None:
            tests.append(column >= stamp(self.start) if self.start_closed else column > stamp(self.start))
        if self.end is not None:
            tests.append(column <= stamp(self.end) if self.end_closed else column < stamp(self.end))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def of(self, df: DataFrame, c: str) -> DataFrame:
        """Rows of the window. Of a table filed by the month of ``c`` only its months are read."""
        out = df.where(self.covers(c))
        if FILED_MONTH in df.columns:
            for end, late in ((self.start, False), (self.end, True)):
                if end is not None:
                    month = end.year * 100 + end.month
                    out = out.where(F.col(FILED_MONTH) <= month if late else F.col(FILED_MONTH) >= month)
        return out


def stamp(ts: datetime) -> Column:
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def day_literal(d: datetime | date) -> Column:
    return F.lit(d.strftime("%Y-%m-%d")).cast("date")


def to_local(now: datetime, zone: str | None) -> datetime:
    if zone is None:
        return now
    return now.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def to_utc(local: datetime, zone: str | None) -> datetime:
    if zone is None:
        return local
    return local.replace(tzinfo=ZoneInfo(zone)).astimezone(ZoneInfo("UTC")).replace(tzinfo=None)


def midnight(ts: datetime) -> datetime:
    return ts.replace(hour=0, minute=0, second=0, microsecond=0)


def month_start(ts: datetime, months: int = 0) -> datetime:
    index = ts.year * 12 + ts.month - 1 + months
    return datetime(index // 12, index % 12 + 1, 1)


def year_start(ts: datetime, years: int = 0) -> datetime:
    return datetime(ts.year + years, 1, 1)


def same_day_other_year(ts: datetime, years: int) -> datetime:
    try:
        return ts.replace(year=ts.year + years)
    except ValueError:  # 29 February
        return ts.replace(year=ts.year + years, day=28)


def yesterday(now: datetime) -> Window:
    today = midnight(now)
    return Window(today - timedelta(days=1), today)


def month_to_date_with_cutoff(now: datetime, bounds: str | None = None) -> tuple[Window, bool]:
    """Month to date; from 11:00 today counts, before that only up to yesterday.

    The second value tells whether this is the morning run.
    """
    morning = now.hour <= 10
    last = midnight(now) - timedelta(days=1) if morning else midnight(now)
    start = month_start(to_utc(last, bounds))
    return Window(start, to_utc(last + timedelta(days=1), bounds)), morning


def month_of_yesterday_to_date(now: datetime) -> Window:
    return Window(month_start(now - timedelta(days=1)), midnight(now))


def previous_month(now: datetime) -> Window:
    return Window(month_start(now, -1), month_start(now))


def trailing_week(now: datetime, end_offset: int = 0, bounds: str | None = None) -> Window:
    """Seven whole days ending ``end_offset`` days before today."""
    end = midnight(now) - timedelta(days=end_offset)
    return Window(to_utc(end - timedelta(days=7), bounds), to_utc(end, bounds))


def yesterday_or_month_on_day_five(now: datetime) -> Window:
    plain = yesterday(now)
    return Window(month_start(now, -1), plain.end) if now.day == 5 else plain


def trailing_31_days(now: datetime) -> tuple[Window, Window]:
    """Booking window and the open capacity window that goes with it."""
    start = midnight(now) - timedelta(days=31)
    booking = Window(start, midnight(now) + timedelta(days=1))
    return booking, Window(min(start, year_start(now)), None)


def previous_month_plus_six(now: datetime) -> Window:
    ref = now - timedelta(days=1)
    return Window(month_start(ref, -1), month_start(ref, 6))


def previous_month_to_year_end(now: datetime) -> Window:
    return Window(month_start(now, -1), datetime(now.year, 12, 31))


def two_back_five_ahead(now: datetime) -> Window:
    return Window(month_start(now, -2), month_start(now, 5), start_closed=False, end_closed=True)


def season(now: datetime, lag_days: int) -> Window:
    """1 January (of ``now`` less a lag) to the end of the eleventh month ahead."""
    start = year_start(now - timedelta(days=lag_days))
    end = month_start(now, 12) - timedelta(minutes=1)
    return Window(start, end, end_closed=True)


@dataclass(frozen=True)
class YearOnYear:
    """Booking and departure windows of the three compared snapshots."""

    captured: datetime
    booked_now: Window
    booked_last_year: Window
    booked_year_end: Window
    departs: Window
    departs_last_year: Window

    @property
    def departs_all(self) -> Window:
        return Window(self.departs_last_year.start, self.departs.end, end_closed=True)


def year_on_year(now: datetime) -> YearOnYear:
    today = midnight(now)
    last_year = midnight(same_day_other_year(now, -1))
    return YearOnYear(
        captured=today,
        booked_now=Window(None, today),
        booked_last_year=Window(None, last_year),
        booked_year_end=Window(None, datetime(last_year.year, 12, 31), end_closed=True),
        departs=Window(year_start(today), datetime(today.year + 1, 12, 31), end_closed=True),
        departs_last_year=Window(year_start(last_year), datetime(today.year, 12, 31), end_closed=True),
    )


def fly_thru(now: datetime) -> tuple[Window, Window]:
    """Purchases before Monday of this Sunday-start week; departures to a year later."""
    today = midnight(now)
    sunday = today - timedelta(days=(today.weekday() + 1) % 7)
    monday = sunday + timedelta(days=1)
    departures = Window(year_start(now), same_day_other_year(monday, 1), end_closed=True)
    return Window(None, monday), departures


def five_months_back(as_of: datetime) -> Window:
    return Window(month_start(as_of, -5), midnight(as_of))


def month_before_to_date(as_of: datetime) -> Window:
    return Window(month_start(as_of, -1), midnight(as_of))


def from_today(now: datetime) -> Window:
    return Window(midnight(now), None)
