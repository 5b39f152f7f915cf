"""Bars of n minutes anchored at the session's open, not at midnight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANCHOR = 9 * 60 + 15  # minute of the day at which bars are anchored


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def minutes(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n if isinstance(n, Column) else F.lit(n), F.lit(0))


def floor_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def bar_start(ts: Column, n: int | Column, anchor: int = ANCHOR) -> Column:
    """Start of the n-minute bar that holds ts."""
    width = n if isinstance(n, Column) else F.lit(n)
    return floor_minute(ts) - minutes(F.pmod(minute_of_day(ts) - anchor, width))


def bar_close(ts: Column, n: int | Column, anchor: int = ANCHOR) -> Column:
    """When that bar's values can first be known."""
    return bar_start(ts, n, anchor) + minutes(n)


def candle(ts: Column, n: int) -> Column:
    """Start of the n-minute candle from midnight."""
    return bar_start(ts, n, 0)


def epoch_micros(ts: Column) -> Column:
    """Microseconds of a zoneless time since 1970."""
    return F.unix_micros(ts.cast("timestamp"))
