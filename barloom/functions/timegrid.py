"""Timeframe strings and time expressions that do not depend on the session zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from barloom.schema import quoted

_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3_600, "d": 86_400, "w": 604_800}
_PATTERN = re.compile(r"^(\d+)([smhdw])$")

DEFAULT_TIMEFRAMES = ("5m", "30m", "1d")


def step_seconds(timeframe: str) -> int:
    """Length of a timeframe such as ``5m``, ``30m``, ``1h`` or ``1d`` in seconds."""
    match = _PATTERN.match(timeframe)
    if not match or int(match[1]) < 1:
        raise ValueError(f"not a timeframe: {timeframe!r} (want e.g. 5m, 30m, 1h, 1d)")
    return int(match[1]) * _UNIT_SECONDS[match[2]]


def bucket_start(ts: str | Column, timeframe: str) -> Column:
    """Start of the left-closed tumbling window that holds ``ts``.

    Built on ``window`` so it is exact for naive timestamps in any session zone.
    Windows are counted from the epoch; weeks start on Monday.  Catalyst takes
    one ``window`` call per projection.
    """
    seconds, offset = step_seconds(timeframe), bucket_offset(timeframe)
    if offset:
        return F.window(ts, f"{seconds} seconds", startTime=f"{-offset} seconds")["start"]
    return F.window(ts, f"{seconds} seconds")["start"]


def session_of(ts: str | Column) -> Column:
    return F.to_date(ts)


def day_number_sql(ts: str) -> str:
    """Days since the epoch of a naive timestamp column."""
    return f"unix_date(to_date({quoted(ts)}))"


def epoch_seconds_sql(ts: str) -> str:
    """Whole seconds since the epoch of a naive timestamp column."""
    t = quoted(ts)
    return (
        f"(CAST({day_number_sql(ts)} AS BIGINT) * 86400"
        f" + hour({t}) * 3600 + minute({t}) * 60 + second({t}))"
    )


def epoch_micros_sql(ts: str) -> str:
    """Microseconds since the epoch of a naive timestamp column."""
    t = quoted(ts)
    return (
        f"((CAST({day_number_sql(ts)} AS BIGINT) * 86400"
        f" + hour({t}) * 3600 + minute({t}) * 60) * 1000000"
        f" + CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT))"
    )


def plus_days(ts: Column, days: Column | int) -> Column:
    """Move a timestamp by whole days."""
    return ts + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days)


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from one column to another, truncated toward zero."""
    return F.expr(f"({epoch_micros_sql(end)} - {epoch_micros_sql(start)}) div 1000000")


def bucket_offset(timeframe: str) -> int:
    """Seconds to add so that weeks count from Monday, 5 January 1970; other buckets from the epoch."""
    return -4 * 86_400 if timeframe.endswith("w") else 0


def bucket_start_of_bar(ts: str, timeframe: str) -> Column:
    """:func:`bucket_start` as plain arithmetic on whole seconds, for bar times."""
    size, offset = step_seconds(timeframe), bucket_offset(timeframe)
    number = f"floor(({epoch_seconds_sql(ts)} + {offset}) / {size})"
    seconds = f"CAST({number} * {size} - {offset} AS DECIMAL(18, 6))"
    return F.expr(
        f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    )


def naive_utc(time: str) -> Column:
    """A time-zone timestamp expression as the naive time it shows in UTC."""
    seconds = f"CAST(unix_micros({time}) / 1000000BD AS DECIMAL(18, 6))"
    return F.expr(
        f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    )


def clock_label(ts: str) -> Column:
    t = quoted(ts)
    return F.expr(f"format_string('%02d:%02d', hour({t}), minute({t}))")
