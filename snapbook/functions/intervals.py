"""Date predicates: validity intervals and account windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F


def _day(asof: date) -> Column:
    return F.lit(asof).cast("date")


def valid_on(start: Column, end: Column, asof: date) -> Column:
    """Closed interval: start <= asof <= end, an open end counts as asof."""
    day = _day(asof)
    return day.between(start, F.coalesce(end, day))


def opened(start: Column, closed: Column, asof: date) -> Column:
    """Half-open interval start <= asof < closed; without a start the row is not opened."""
    day = _day(asof)
    return F.coalesce((start <= day) & (closed.isNull() | (day < closed)), F.lit(False))


def is_closed(closed: Column, asof: date) -> Column:
    """Closed on the day itself or earlier."""
    return F.coalesce(closed <= _day(asof), F.lit(False))


def account_window(date_open: Column, date_close: Column, asof: date, depth: int = 0) -> Column:
    """Account opened by the date and not closed before ``asof - depth``.

    Both columns may carry a time of day; comparing against midnight bounds leaves the columns bare,
    so the predicate can be pushed to the scan.
    """
    next_midnight = F.lit(asof + timedelta(days=1)).cast("timestamp_ntz")
    floor = F.lit(asof - timedelta(days=depth)).cast("timestamp_ntz")
    return (date_open < next_midnight) & (date_close.isNull() | (date_close >= floor))


def closed_within(closed: Column, asof: date, depth: int) -> Column:
    """Closed between ``asof - depth`` and the day before; an open end counts as asof, hence never."""
    return F.coalesce(
        closed.between(_day(asof - timedelta(days=depth)), _day(asof - timedelta(days=1))), F.lit(False)
    )
