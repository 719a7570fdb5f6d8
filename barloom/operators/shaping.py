"""Row selection, unions and joins of bar frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from barloom.functions.bar_columns import (
    CANDLE_HALF_WIDTH,
    body_base,
    body_height,
    candle_color,
    is_overbought,
    is_oversold,
    repaired_high,
    repaired_low,
    scaled_level,
)
from barloom.functions.timegrid import bucket_start, clock_label, plus_days, step_seconds
from barloom.schema import (
    KEYS,
    OHLCV,
    TIMESTAMP,
    indicator_columns,
    require_columns,
    require_window,
)


def head_rows(df: DataFrame, n: int = 5, *, ts: str = TIMESTAMP, keys: Sequence[str] = KEYS) -> DataFrame:
    """The earliest ``n`` rows of the whole table."""
    require_window(n, "n")
    return df.orderBy(ts, *keys).limit(n)


def first_rows(
    df: DataFrame, n: int, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """The earliest ``n`` rows of each symbol.

    Spark limits each group before the shuffle, so a long series costs ``n``
    rows per map task.
    """
    require_window(n, "n")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(ts))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def frame_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and column names as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def shift_days(df: DataFrame, days: int, *, ts: str = TIMESTAMP) -> DataFrame:
    """Move every timestamp by whole days."""
    return df.withColumn(ts, plus_days(F.col(ts), days))


def union_days(*frames: DataFrame) -> DataFrame:
    """Bag union of day frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def duplicate_bars(
    df: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """Keys that occur more than once, e.g. after a union of unshifted days."""
    return (
        df.groupBy(*keys, ts)
        .agg(F.count(F.lit(1)).alias("n_copies"))
        .where(F.col("n_copies") > 1)
    )


def repair_bars(df: DataFrame) -> DataFrame:
    """Widen high and low so that they enclose the body."""
    return df.withColumns({"high": repaired_high(), "low": repaired_low()})


def join_on_time(
    left: DataFrame, right: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """Inner join of two frames of one timeframe on symbol and time."""
    return left.join(right, [*keys, ts], "inner")


def align_timeframes(
    fine: DataFrame,
    coarse: DataFrame,
    timeframe: str,
    *,
    columns: Sequence[str] = OHLCV,
    prefix: str = "coarse_",
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Each fine bar with the coarse bar that encloses it.

    An equi-join on symbol and bucket start: a symbol's bars are spread over its
    buckets, none of which exceeds the coarse length over the fine length.
    """
    require_columns(coarse, [*keys, ts, *columns])
    start = f"{prefix}{ts}"
    enclosing = coarse.select(
        *keys, F.col(ts).alias(start), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )
    return fine.withColumn(start, bucket_start(ts, timeframe)).join(
        enclosing, [*keys, start], "inner"
    )


def candles(df: DataFrame, timeframe: str) -> DataFrame:
    """Candle geometry: colour, body, wick and half width in seconds."""
    return df.withColumns(
        {
            "color": candle_color(),
            "body_height": body_height(),
            "body_base": body_base(),
            "wick_low": F.col("low"),
            "wick_high": F.col("high"),
            "half_width_seconds": F.lit(step_seconds(timeframe) * CANDLE_HALF_WIDTH),
        }
    )


def rsi_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"overbought": is_overbought(), "oversold": is_oversold()})


def indicator_lines(
    df: DataFrame, limit: int = 5, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """Close, the first few indicators of the frame, and RSI if it has one."""
    shown = [*indicator_columns(df, keys, limit), *[c for c in ("rsi",) if c in df.columns]]
    return df.select(*keys, ts, "close", *dict.fromkeys(shown))


def scaled_first_rows(
    df: DataFrame,
    n: int = 20,
    *,
    price_levels: int = 20,
    volume_levels: int = 30,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Chart levels of the first ``n`` closes and volumes of each symbol."""
    rows = first_rows(df.select(*keys, ts, "close", "volume"), n, keys=keys, ts=ts)
    whole = Window.partitionBy(*keys)
    ranged = rows.withColumns(
        {
            "_c_lo": F.min("close").over(whole),
            "_c_hi": F.max("close").over(whole),
            "_v_lo": F.min("volume").over(whole),
            "_v_hi": F.max("volume").over(whole),
        }
    )
    levels = ranged.withColumns(
        {
            "label": clock_label(ts),
            "price_level": scaled_level(
                F.col("close"), F.col("_c_lo"), F.col("_c_hi"), price_levels
            ),
            "volume_level": scaled_level(
                F.col("volume").cast("double"),
                F.col("_v_lo").cast("double"),
                F.col("_v_hi").cast("double"),
                volume_levels,
            ),
        }
    )
    return levels.withColumns(
        {
            "price_bar_length": F.col("price_level") + 1,
            "volume_bar_length": F.floor(F.col("volume_level") / 2) + 1,
        }
    ).drop("_c_lo", "_c_hi", "_v_lo", "_v_hi")
