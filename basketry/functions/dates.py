"""Date and time expressions. The reference moment is always an argument, never the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = Column | datetime | date | str


def moment(as_of: Moment) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return F.lit(as_of)


def days_before(as_of: Moment, days: int) -> Column:
    return moment(as_of) - F.expr(f"interval {int(days)} days")


def in_window(ts: Column, as_of: Moment, days: int, closed: bool = True) -> Column:
    """``ts`` within the last ``days``; ``closed`` also bounds it by ``as_of`` itself."""
    start = days_before(as_of, days)
    return ts.between(start, moment(as_of)) if closed else ts >= start


def on_day(ts: Column, as_of: Moment) -> Column:
    """``ts`` on the calendar day of ``as_of``, as a range so a scan can prune with it."""
    start = F.date_trunc("day", moment(as_of))
    return (ts >= start) & (ts < start + F.expr("interval 1 day"))


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def is_weekday(ts: Column) -> Column:
    return F.weekday(ts) < 5


def sunday_to_thursday(ts: Column) -> Column:
    """Day numbers 1-5 where the week starts on Sunday (the golden run's 'weekday')."""
    return F.dayofweek(ts).between(1, 5)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def parse_event_time(col: Column, run_time: Moment) -> Column:
    """Envelope time; a missing or unreadable one becomes the time of the run."""
    return F.coalesce(F.try_to_timestamp(col), moment(run_time))
