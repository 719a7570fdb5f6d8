"""Technical indicators over bars, per symbol, on row-count windows.

Each indicator is a list of stages (see :mod:`barloom.operators.series`), so that
any set of them shares one shuffle, one sort and one set of halo rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from barloom.functions.timegrid import session_of
from barloom.operators.order_stats import moving_quantile
from barloom.operators.series import (
    BLOCK_DAYS,
    DEFAULT_BLOCK_DAYS,
    SeriesWindow,
    Stages,
    in_lockstep,
    over_series,
)
from barloom.schema import (
    KEYS,
    SESSION,
    TIMESTAMP,
    quoted,
    require_columns,
    require_non_negative,
    require_window,
)

TYPICAL_PRICE = "((high + low + close) / 3.0D)"


@dataclass(frozen=True)
class Indicator:
    """Columns over a series: SQL of the stages, of the results and of what is carried."""

    stages: Callable[[SeriesWindow], Stages]
    outputs: Mapping[str, str]
    lookback: int = 0
    carry: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    needs: tuple[str, ...] = ("close",)


def add_indicators(
    df: DataFrame,
    *indicators: Indicator,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    block_days: int | None = DEFAULT_BLOCK_DAYS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Append the columns of several indicators in one pass over each series.

    New columns follow the frame's own, in the order of the indicators.
    """
    require_columns(df, [c for i in indicators for c in i.needs])
    return over_series(
        df,
        lambda w: in_lockstep([i.stages(w) for i in indicators]),
        {name: sql for i in indicators for name, sql in i.outputs.items()},
        keys=keys,
        ts=ts,
        lookback=max(i.lookback for i in indicators),
        carry={name: c for i in indicators for name, c in i.carry.items()},
        block_days=block_days,
        tiebreak=tiebreak,
    )


# --- definitions -----------------------------------------------------------


def moving_average_of(window: int = 30, column: str = "close", name: str | None = None) -> Indicator:
    require_window(window)
    mean = quoted(f"_mean_{window}_{column}")
    return Indicator(
        lambda w: [{mean: f"avg({quoted(column)}) {w.last(window)}"}],
        outputs={name or f"ma_{window}": mean},
        lookback=window - 1,
        needs=(column,),
    )


def moving_median_of(window: int = 30, column: str = "close", name: str | None = None) -> Indicator:
    require_window(window)
    held = quoted(f"_sorted_{window}_{column}")
    middle = (
        f"(get({held}, (size({held}) - 1) div 2) + get({held}, size({held}) div 2)) / 2.0D"
    )
    return Indicator(
        lambda w: [{held: f"sort_array(collect_list({quoted(column)}) {w.last(window)})"}],
        outputs={name or f"median_{window}": middle},
        lookback=window - 1,
        needs=(column,),
    )


def vwap_of(
    name: str = "vwap",
    *,
    turnover: str = f"{TYPICAL_PRICE} * volume",
    traded: str = "volume",
    totals: tuple[str, str] | None = None,
) -> Indicator:
    """Running volume-weighted typical price; null while no volume was traded.

    ``turnover`` and ``traded`` are what a row adds to the two running sums;
    ``totals`` names result columns that keep the sums.
    """
    kept = dict(zip(totals or (), ("_turnover_sum", "_traded_sum")))
    return Indicator(
        lambda w: [
            {
                "_turnover_sum": f"sum(_turnover) {w.running}",
                "_traded_sum": f"sum(_traded) {w.running}",
            }
        ],
        outputs={
            name: "CASE WHEN _turnover IS NOT NULL"
            " THEN try_divide(_turnover_sum, _traded_sum) END",
            **kept,
        },
        carry={"_turnover": (turnover, "sum"), "_traded": (traded, "sum")},
        needs=("high", "low", "close", "volume"),
    )


def bollinger_of(
    window: int = 20, num_std: float = 2.0, middle: str = "bb_middle"
) -> Indicator:
    """Bands around a moving average; a one-row deviation counts as zero."""
    require_window(window)
    require_non_negative(num_std, "num_std")
    mean, spread = quoted(f"_mean_{window}_close"), f"_spread_{window}"
    width = f"coalesce({spread}, 0.0D) * {float(num_std)!r}D"
    return Indicator(
        lambda w: [
            {
                mean: f"avg(close) {w.last(window)}",
                spread: f"stddev_samp(close) {w.last(window)}",
            }
        ],
        outputs={
            middle: mean,
            "bb_upper": f"{mean} + {width}",
            "bb_lower": f"{mean} - {width}",
        },
        lookback=window - 1,
    )


def rsi_of(window: int = 14, name: str = "rsi") -> Indicator:
    """Relative strength from plain means of gains and losses; 100 without losses."""
    require_window(window)
    up, down = f"_mean_gain_{window}", f"_mean_loss_{window}"

    def stages(w: SeriesWindow) -> Stages:
        gain = "CASE WHEN _change > 0 THEN _change ELSE 0.0D END"
        loss = "CASE WHEN _change < 0 THEN -_change ELSE 0.0D END"
        return [
            {"_change": f"close - lag(close) {w.ordered}"},
            {
                "_gain": f"CASE WHEN {w.real} THEN {gain} END",
                "_loss": f"CASE WHEN {w.real} THEN {loss} END",
            },
            {up: f"avg(_gain) {w.last(window)}", down: f"avg(_loss) {w.last(window)}"},
        ]

    strength = f"100.0D - 100.0D / (1.0D + {up} / nullif({down}, 0.0D))"
    return Indicator(
        stages,
        outputs={name: f"CASE WHEN {down} = 0 THEN 100.0D ELSE {strength} END"},
        lookback=window,
    )


def rolling_volatility_of(
    window: int = 20, returns: str = "returns", name: str = "volatility"
) -> Indicator:
    """Deviation of a column of returns over ``window`` rows, null until all are known."""
    require_window(window)
    known, spread = f"_known_{window}", f"_return_spread_{window}"
    return Indicator(
        lambda w: [
            {
                known: f"count({quoted(returns)}) {w.last(window)}",
                spread: f"stddev_samp({quoted(returns)}) {w.last(window)}",
            },
        ],
        outputs={name: f"CASE WHEN {known} = {window} THEN {spread} END"},
        lookback=window - 1,
        needs=(returns,),
    )


# --- operators -------------------------------------------------------------

# Rows of a window that is sorted anew for every row.
LONG_WINDOW = 128


def moving_average(df: DataFrame, window: int = 30, column: str = "close", **series) -> DataFrame:
    """Add ``ma_{window}``; early rows average what there is."""
    return add_indicators(df, moving_average_of(window, column), **series)


def moving_median(df: DataFrame, window: int = 30, column: str = "close", **series) -> DataFrame:
    """Add ``median_{window}``; the middle pair is averaged.

    Windows over ``LONG_WINDOW`` rows are not sorted row by row: their time does not depend
    on the window.
    """
    if window > LONG_WINDOW:
        return moving_quantile(df, window, column, 0.5, f"median_{window}", **series)
    return add_indicators(df, moving_median_of(window, column), **series)


def vwap(
    df: DataFrame,
    *,
    anchor: str = "series",
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    block_days: int | None = DEFAULT_BLOCK_DAYS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Add ``vwap``, accumulated from the start of the series or of each session."""
    options = {"ts": ts, "tiebreak": tiebreak}
    if anchor == "series":
        return add_indicators(df, vwap_of(), keys=keys, block_days=block_days, **options)
    if anchor != "session":
        raise ValueError(f"anchor must be 'series' or 'session', got {anchor!r}")
    # A session is one day: bounded, so it needs no blocks.
    by_day = df.withColumn(SESSION, session_of(ts))
    out = add_indicators(by_day, vwap_of(), keys=[*keys, SESSION], block_days=None, **options)
    return out if SESSION in df.columns else out.drop(SESSION)


def bollinger_bands(
    df: DataFrame, window: int = 20, num_std: float = 2.0, **series
) -> DataFrame:
    """Add ``bb_middle``, ``bb_upper`` and ``bb_lower``."""
    return add_indicators(df, bollinger_of(window, num_std), **series)


def rsi(df: DataFrame, window: int = 14, **series) -> DataFrame:
    """Add ``rsi`` in 0..100."""
    return add_indicators(df, rsi_of(window), **series)


@dataclass(frozen=True)
class WindowSet:
    ma: int
    median: int
    bands: int
    rsi: int


# Row-count windows per bar length.
STANDARD_WINDOWS = {
    "1m": WindowSet(30, 30, 20, 14),
    "5m": WindowSet(6, 6, 4, 3),
    "30m": WindowSet(1, 1, 1, 1),
    "1d": WindowSet(1, 1, 1, 1),
}
COMPACT_RSI_WINDOW = 14
COMPACT_NUM_STD = 2.0


def standard_set(
    timeframe: str, windows: WindowSet | None = None, vwap_indicator: Indicator | None = None
) -> list[Indicator]:
    """The indicators of :func:`standard_metrics`; timeframes outside the table use ones."""
    w = windows or STANDARD_WINDOWS.get(timeframe, WindowSet(1, 1, 1, 1))
    return [
        moving_average_of(w.ma),
        moving_median_of(w.median),
        vwap_indicator or vwap_of(),
        bollinger_of(w.bands),
        rsi_of(w.rsi),
    ]


def standard_metrics(
    df: DataFrame, timeframe: str, windows: WindowSet | None = None, **series
) -> DataFrame:
    """The full set, with window sizes that fit the bar length.

    Adds ``ma_{w}``, ``median_{w}``, ``vwap``, ``bb_middle``, ``bb_upper``,
    ``bb_lower`` and ``rsi``.
    """
    blocks = {"block_days": BLOCK_DAYS.get(timeframe, DEFAULT_BLOCK_DAYS)}
    return add_indicators(df, *standard_set(timeframe, windows), **{**blocks, **series})


def standard_metrics_by_timeframe(
    frames: Mapping[str, DataFrame], timeframes: Sequence[str] = ("1m", "5m", "30m"), **series
) -> dict[str, DataFrame]:
    """:func:`standard_metrics` on each of the named frames."""
    return {tf: standard_metrics(frames[tf], tf, **series) for tf in timeframes}


def compact_metrics(df: DataFrame, window: int, **series) -> DataFrame:
    """One window size for all: ``ma``, ``median``, ``vwap``, ``bb_upper``, ``bb_lower``, ``rsi``.

    Relative strength keeps 14 rows and the bands two deviations; the middle
    band is the moving average.
    """
    return add_indicators(
        df,
        moving_average_of(window, name="ma"),
        moving_median_of(window, name="median"),
        vwap_of(),
        bollinger_of(window, COMPACT_NUM_STD, middle="ma"),
        rsi_of(COMPACT_RSI_WINDOW),
        **series,
    )
