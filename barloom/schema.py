"""The bar data model: column names, declared types and plan-time checks.

A *bar* table has one row per ``(symbol, timestamp)``; timestamps are naive
(``timestamp_ntz``).  A *tick* table has one price per row and usually needs
further columns to break ties between ticks of one timestamp.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

SYMBOL = "symbol"
TIMESTAMP = "timestamp"
TIMEFRAME = "timeframe"
SESSION = "session_date"
PRICES = ("open", "high", "low", "close")
OHLCV = (*PRICES, "volume")
KEYS = (SYMBOL,)

BAR_SCHEMA = T.StructType(
    [
        T.StructField(SYMBOL, T.StringType()),
        T.StructField(TIMESTAMP, T.TimestampNTZType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICES],
        T.StructField("volume", T.LongType()),
    ]
)


def quoted(name: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


class SchemaError(ValueError):
    """A DataFrame lacks a column, or has it with a type an operator cannot use."""


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SchemaError(f"missing column(s) {missing}; present: {df.columns}")


def require_window(window: int, name: str = "window") -> int:
    if isinstance(window, bool) or not isinstance(window, int) or window < 1:
        raise ValueError(f"{name} must be an integer >= 1, got {window!r}")
    return window


def require_non_negative(value: float, name: str) -> float:
    if value < 0:
        raise ValueError(f"{name} must be non-negative, got {value!r}")
    return value


def require_positive(value: float, name: str) -> float:
    if value <= 0:
        raise ValueError(f"{name} must be positive, got {value!r}")
    return value


def conform(df: DataFrame, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """Cast the declared columns whose type differs; leave all others alone.

    Prices given as integers become doubles, time-zone timestamps and dates
    become naive timestamps.  A frame that already conforms is returned as is.
    """
    require_columns(df, [f.name for f in schema.fields])
    casts = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in schema.fields
        if df.schema[f.name].dataType != f.dataType
    }
    return df.withColumns(casts) if casts else df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the double and bigint columns, in frame order."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.LongType)) and f.name not in skip
    ]


def indicator_columns(
    df: DataFrame, keys: Iterable[str] = KEYS, limit: int | None = None
) -> list[str]:
    """Every column that is neither key, time nor OHLCV; optionally the first few."""
    skip = {*keys, TIMESTAMP, TIMEFRAME, SESSION, *OHLCV}
    names = [c for c in df.columns if c not in skip]
    return names if limit is None else names[:limit]
