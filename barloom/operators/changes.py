"""Row-to-row operators: differences, returns, price index, opens, spacing.

All need only the previous row or a running product, so blocks of a long series
are joined by one carry row each, without a halo.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from barloom.functions.timegrid import seconds_between, session_of
from barloom.operators.indicators import Indicator, add_indicators, rolling_volatility_of
from barloom.operators.series import over_series
from barloom.schema import (
    KEYS,
    SESSION,
    TIMESTAMP,
    quoted,
    require_columns,
    require_positive,
    require_window,
)


def with_previous(df: DataFrame, column: str, name: str, **series) -> DataFrame:
    """The column one row earlier in the series; null on the first row."""
    require_columns(df, [column])
    return over_series(
        df,
        lambda w: [{"_before": f"lag(_source) {w.ordered}"}],
        {name: "_before"},
        carry={"_source": (quoted(column), "last")},
        **series,
    )


def with_change(
    df: DataFrame, column: str = "close", name: str = "price_change", **series
) -> DataFrame:
    """Difference to the previous row."""
    require_columns(df, [column])
    return over_series(
        df,
        lambda w: [{"_before": f"lag(_source) {w.ordered}"}],
        {name: f"{quoted(column)} - _before"},
        carry={"_source": (quoted(column), "last")},
        **series,
    )


def with_returns(
    df: DataFrame, column: str = "close", name: str = "returns", **series
) -> DataFrame:
    """Relative change against the last known (non-null) earlier value."""
    require_columns(df, [column])
    return over_series(
        df,
        lambda w: [{"_before": f"last(_source, true) {w.before}"}],
        {name: f"try_divide(coalesce({quoted(column)}, _before), _before) - 1.0D"},
        carry={"_source": (quoted(column), "last_valid")},
        **series,
    )


def with_open_from_previous_close(
    df: DataFrame, initial_price: float = 100.0, name: str = "open", **series
) -> DataFrame:
    """Open each bar at the close before it; the first at ``initial_price``."""
    require_positive(initial_price, "initial_price")
    return over_series(
        df,
        lambda w: [{"_before": f"lag(_source) {w.ordered}"}],
        {name: f"coalesce(_before, {float(initial_price)!r}D)"},
        carry={"_source": ("close", "last")},
        **series,
    )


def with_price_index(
    df: DataFrame,
    returns: str = "returns",
    initial_price: float = 100.0,
    name: str = "price_index",
    **series,
) -> DataFrame:
    """Compound per-bar returns from ``initial_price``; an unknown return changes nothing."""
    require_columns(df, [returns])
    require_positive(initial_price, "initial_price")
    return over_series(
        df,
        lambda w: [{"_growth": w.running_product("_factor")}],
        {name: f"{float(initial_price)!r}D * coalesce(_growth, 1.0D)"},
        carry={"_factor": (f"1.0D + {quoted(returns)}", "product")},
        **series,
    )


def with_running_sum(
    df: DataFrame, column: str = "volume", name: str | None = None, **series
) -> DataFrame:
    """Sum from the start of the series; a missing value stays missing on its own row."""
    require_columns(df, [column])
    return over_series(
        df,
        lambda w: [{"_sum": f"sum(_source) {w.running}"}],
        {name or f"running_{column}": "CASE WHEN _source IS NOT NULL THEN _sum END"},
        carry={"_source": (quoted(column), "sum")},
        **series,
    )


def with_gap_seconds(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    name: str = "gap_seconds",
) -> DataFrame:
    """Seconds since the previous bar of the same session; null on its first bar.

    A session is one day, which bounds every window.
    """
    by_session = ", ".join(quoted(k) for k in (*keys, SESSION))
    before = f"lag({quoted(ts)}) OVER (PARTITION BY {by_session} ORDER BY {quoted(ts)})"
    return (
        df.withColumn(SESSION, session_of(ts))
        .selectExpr("*", f"{before} AS _before")
        .withColumn(name, seconds_between("_before", ts))
        .drop("_before")
    )


def rolling_volatility(df: DataFrame, window: int = 20, **series) -> DataFrame:
    """Add ``returns``, by the rule of :func:`with_returns`, and their ``volatility``."""
    return add_indicators(with_returns(df, **series), rolling_volatility_of(window), **series)


def _average_returns(window: int) -> Indicator:
    require_window(window)
    return Indicator(
        lambda w: [
            {"_average": f"avg(close) {w.last(window)}"},
            {"_average_before": f"lag(_average) {w.ordered}"},
        ],
        outputs={"ma_returns": "try_divide(_average, _average_before) - 1.0D"},
        lookback=window,
    )


def smoothness(df: DataFrame, window: int = 30, *, keys: Sequence[str] = KEYS, **series) -> DataFrame:
    """Deviation of moving-average returns against that of price returns, per series."""
    known = with_returns(df, keys=keys, **series)
    both = add_indicators(known, _average_returns(window), keys=keys, **series)
    return (
        both.groupBy(*keys)
        .agg(
            F.stddev_samp("returns").alias("returns_std"),
            F.stddev_samp("ma_returns").alias("ma_returns_std"),
        )
        .selectExpr(
            "*",
            "try_divide(ma_returns_std, returns_std) AS smoothness_ratio",
            "ma_returns_std < returns_std AS is_smoother",
        )
    )
