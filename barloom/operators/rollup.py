"""Rolling ticks or fine bars up into coarser bars.

The hot-key story: the aggregates all combine on the map side, so a symbol that
holds a third of the ticks still sends at most one partial row per bucket and
map task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom.functions.timegrid import (
    DEFAULT_TIMEFRAMES,
    bucket_offset,
    bucket_start,
    bucket_start_of_bar,
    epoch_micros_sql,
    step_seconds,
)
from barloom.schema import KEYS, OHLCV, PRICES, TIMEFRAME, TIMESTAMP, quoted, require_columns

# Twice the span of a bigint tie-breaker, so equal timestamps keep their order.
_TIE_SPAN = "20000000000000000000BD"
# Below every bigint, so a missing tie-breaker comes first.
_NULL_TIE = "-9223372036854775809BD"


def order_key(df: DataFrame, ts: str = TIMESTAMP, tiebreak: Sequence[str] = ()) -> str:
    """SQL of one orderable value for "earliest" and "latest".

    Fixed-width values keep the aggregation hash-based: the timestamp alone when
    it is unique per key, or timestamp and one integer tie-breaker packed into a
    decimal.  Several tie-breakers need a struct, which Spark aggregates by
    sorting.
    """
    if not tiebreak:
        return quoted(ts)
    if len(tiebreak) == 1 and isinstance(
        df.schema[tiebreak[0]].dataType, (T.LongType, T.IntegerType, T.ShortType)
    ):
        time = f"CAST({epoch_micros_sql(ts)} AS DECIMAL(18, 0)) * {_TIE_SPAN}"
        tie = f"coalesce(CAST({quoted(tiebreak[0])} AS DECIMAL(19, 0)), {_NULL_TIE})"
        return f"CAST({time} + {tie} AS DECIMAL(38, 0))"
    return f"struct({', '.join(quoted(c) for c in (ts, *tiebreak))})"


def drop_null_bars(df: DataFrame) -> DataFrame:
    """Remove bars that miss any of the four prices."""
    return df.where(" AND ".join(f"{p} IS NOT NULL" for p in PRICES))


def bucket_aggregates(ordering: str) -> list[Column]:
    return [
        F.expr(sql)
        for sql in (
            f"min_by(open, {ordering}) AS open",
            "max(high) AS high",
            "min(low) AS low",
            f"max_by(close, {ordering}) AS close",
            "CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume",
        )
    ]


def roll_up(
    df: DataFrame,
    timeframe: str,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Bars of one timeframe: first open, top high, bottom low, last close, summed volume.

    Buckets are left-closed and labelled by their start; empty buckets are not
    emitted.  ``tiebreak`` names the columns that order rows of one timestamp.
    """
    require_columns(df, [*keys, ts, *OHLCV, *tiebreak])
    bars = df.groupBy(*keys, bucket_start(ts, timeframe).alias(ts)).agg(
        *bucket_aggregates(order_key(df, ts, tiebreak))
    )
    return drop_null_bars(bars)


def _common_base(timeframes: Sequence[str]) -> int:
    """Seconds of the coarsest bucket that nests in all of them, week starts included."""
    edges = [e for tf in timeframes for e in (step_seconds(tf), bucket_offset(tf)) if e]
    return gcd(*edges)


def _coarser(
    bars: DataFrame, timeframe: str, keys: Sequence[str], ts: str
) -> DataFrame:
    """Roll bars up once more.

    The bucket is plain arithmetic: ``window`` would add a filter that Spark
    pushes below the finer shuffle, which could then no longer be shared.
    """
    return (
        bars.withColumn("_start", bucket_start_of_bar(ts, timeframe))
        .groupBy(*keys, "_start")
        .agg(*bucket_aggregates(quoted(ts)))
        .withColumnRenamed("_start", ts)
    )


def roll_up_frames(
    df: DataFrame,
    timeframes: Sequence[str] = DEFAULT_TIMEFRAMES,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Bars of several timeframes that are used together, one frame each.

    The input is scanned and shuffled once, into bars of the coarsest length
    that nests in all timeframes (usually the finest of them).  Every other
    timeframe aggregates the coarsest bars it can.  A query over several of the
    frames shares the finer shuffles.  All five aggregates decompose, and bars
    with null prices are dropped only at the end, so the rows equal those of
    :func:`roll_up`.
    """
    require_columns(df, [*keys, ts, *OHLCV, *tiebreak])
    base = _common_base(timeframes)
    planned = {
        f"{base}s": df.groupBy(
            *keys, F.window(ts, f"{base} seconds")["start"].alias(ts)
        ).agg(*bucket_aggregates(order_key(df, ts, tiebreak)))
    }
    wanted: dict[str, DataFrame] = {}
    for tf in sorted(set(timeframes), key=step_seconds):
        size, offset = step_seconds(tf), bucket_offset(tf)
        if size == base:
            wanted[tf] = planned[f"{base}s"]
            continue
        nested = [
            p
            for p in planned
            if size % step_seconds(p) == 0
            and (offset - bucket_offset(p)) % step_seconds(p) == 0
        ]
        parent = max(nested, key=step_seconds)
        wanted[tf] = planned[tf] = _coarser(planned[parent], tf, keys, ts)
    return {tf: drop_null_bars(wanted[tf]) for tf in timeframes}


def roll_up_many(
    df: DataFrame, timeframes: Sequence[str] = DEFAULT_TIMEFRAMES, **options
) -> DataFrame:
    """:func:`roll_up_frames` in long form, with a ``timeframe`` column."""
    return stack_frames(roll_up_frames(df, timeframes, **options))


def split_frames(stacked: DataFrame, timeframes: Sequence[str]) -> dict[str, DataFrame]:
    """The frames inside a long table, best one stored by ``timeframe``."""
    return {
        tf: stacked.where(F.col(TIMEFRAME) == tf).drop(TIMEFRAME) for tf in timeframes
    }


def stack_frames(frames: dict[str, DataFrame]) -> DataFrame:
    """Long form: one table with a ``timeframe`` column."""
    labelled = [df.withColumn(TIMEFRAME, F.lit(tf)) for tf, df in frames.items()]
    return reduce(DataFrame.unionByName, labelled)
