"""The session calendar: which minutes a full trading day should hold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions.timegrid import session_of
from barloom.schema import KEYS, SESSION, TIMESTAMP, require_window

# The session runs from 09:30 to 15:59, 390 one-minute bars.
SESSION_OPEN = (9, 30)
SESSION_MINUTES = 390


def minutes_of(session: Column, minutes: int = SESSION_MINUTES) -> Column:
    """The minute starts of a session date, as an array."""
    hour, minute = SESSION_OPEN
    opening = session.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(hour), F.lit(minute)
    )
    closing = opening + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes - 1))
    return F.sequence(opening, closing, F.expr("interval 1 minute"))


def sessions(
    spark: SparkSession, first: date, num_days: int, *, weekdays_only: bool = False
) -> DataFrame:
    """``num_days`` consecutive calendar days as ``session_date``."""
    require_window(num_days, "num_days")
    days = spark.range(num_days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias(SESSION)
    )
    return days.where(F.weekday(SESSION) < 5) if weekdays_only else days


def session_spine(session_days: DataFrame) -> DataFrame:
    """Every expected minute of the given sessions; other columns are repeated.

    Each input row grows by a fixed 390 rows, so the spine is as spread out as
    its input.
    """
    return session_days.select("*", F.explode(minutes_of(F.col(SESSION))).alias(TIMESTAMP))


def traded_sessions(
    bars: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """The sessions in which each symbol has at least one bar."""
    return bars.select(*keys, session_of(ts).alias(SESSION)).distinct()


def missing_minutes(
    bars: DataFrame,
    session_days: DataFrame | None = None,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Expected minutes that have no bar.

    ``session_days`` holds the keys and ``session_date`` to check, by default
    the sessions each symbol traded in.
    """
    days = traded_sessions(bars, keys=keys, ts=ts) if session_days is None else session_days
    present = bars.select(*keys, F.col(ts).alias(TIMESTAMP))
    return session_spine(days).join(present, [*keys, TIMESTAMP], "left_anti")
