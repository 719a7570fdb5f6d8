"""Indicators over a stream of closed bars, with a ring of rows per series as state.

Row-count windows need the last few bars of a series and its running totals, and no more:
that is the state of a key, in Spark's own state store, whatever the number of batches.
A series that has been silent for long can be forgotten (``forget_after``).

Bars of a series have to come in time order, as they do from :func:`stream_bars`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.functions.timegrid import epoch_micros_sql
from barloom.operators.indicators import STANDARD_WINDOWS, WindowSet
from barloom.schema import KEYS, OHLCV, TIMESTAMP, quoted, require_columns
from barloom.streaming.bars import stream_session

_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "at long, closes array<double>, turnover double, traded double, seen long"


def keyed_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A :func:`stream_session` whose state store keeps state of keys on disk."""
    child = stream_session(spark, state_partitions)
    child.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
    return child


def _last(values: np.ndarray, window: int, n: int) -> np.ndarray:
    """The windows of the last n rows, filled up with NaN at the start of the series."""
    padded = np.concatenate([np.full(window - 1, np.nan), values])
    return np.lib.stride_tricks.sliding_window_view(padded, window)[-n:]


def metrics_after(closes: np.ndarray, first: bool, n: int, w: WindowSet, num_std: float = 2.0) -> dict[str, np.ndarray]:
    """Indicators of the last n closes; those before them are the ring. ``first``: the series begins with them."""
    change = np.diff(closes, prepend=np.nan)
    gain, loss = np.where(change > 0, change, 0.0), np.where(change < 0, -change, 0.0)
    if not first:  # the ring's oldest close only serves the change after it
        closes, gain, loss = closes[1:], gain[1:], loss[1:]

    def mean(values: np.ndarray, window: int) -> np.ndarray:
        return np.nanmean(_last(values, window, n), axis=1)

    bands = _last(closes, w.bands, n)
    middle = np.nanmean(bands, axis=1)
    size = np.count_nonzero(~np.isnan(bands), axis=1)
    spread = np.sqrt(np.nansum((bands - middle[:, None]) ** 2, axis=1) / np.maximum(size - 1, 1))
    up, down = mean(gain, w.rsi), mean(loss, w.rsi)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(down == 0, 100.0, 100 - 100 / (1 + up / down))
    return {
        f"ma_{w.ma}": mean(closes, w.ma),
        f"median_{w.median}": np.nanmedian(_last(closes, w.median, n), axis=1),
        "bb_middle": middle,
        "bb_upper": middle + num_std * spread,
        "bb_lower": middle - num_std * spread,
        "rsi": rsi,
    }


class _Series(StatefulProcessor):
    """Adds the standard indicators to the bars of a key."""

    def __init__(self, columns: list[str], windows: WindowSet, forget_after: int | None, names: list[str]):
        self.columns, self.windows, self.forget_after, self.names = columns, windows, forget_after, names
        # One more than the longest window looks back on, for the change of its first row.
        self.length = max(windows.ma, windows.median, windows.bands, windows.rsi)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", _STATE, self.forget_after)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Names that are no identifiers do not arrive.
        bars = pd.concat([f.set_axis(self.columns, axis=1) for f in rows]).sort_values("_at", kind="stable")
        if bars.empty:
            return
        held = self.state.get() if self.state.exists() else None
        at, ring, turnover, traded, seen = held if held is not None else (None, [], 0.0, 0.0, 0)
        if at is not None and int(bars["_at"].iloc[0]) <= at:
            raise ValueError(f"bars of {key} do not follow those that came before")
        closes = np.concatenate([np.asarray(ring, float), bars["close"].to_numpy(float)])
        found = metrics_after(closes, seen <= self.length and seen == len(ring), len(bars), self.windows)
        typical = ((bars["high"] + bars["low"] + bars["close"]) / 3).to_numpy(float)
        volume = bars["volume"].to_numpy(float)
        sums = turnover + np.cumsum(typical * volume)
        volumes = traded + np.cumsum(volume)
        with np.errstate(divide="ignore", invalid="ignore"):
            found["vwap"] = np.where(volumes == 0, np.nan, sums / volumes)
        n = seen + len(bars)
        self.state.update((int(bars["_at"].iloc[-1]), closes[-(self.length + 1) :].tolist() if n > self.length else closes.tolist(), float(sums[-1]), float(volumes[-1]), n))
        out = bars.drop(columns="_at").assign(**found)
        yield out[self.names]

    def close(self) -> None:
        pass


def keyed_metrics(
    bars: DataFrame,
    timeframe: str,
    *,
    windows: WindowSet | None = None,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    forget_after: int | None = None,
) -> DataFrame:
    """A stream of bars with the columns of ``standard_metrics``, from a state of each key.

    ``forget_after`` are milliseconds without a bar after which a series begins anew.  The
    stream has to be read in a :func:`keyed_session`.  The bars that one batch brings of a
    key are in memory together, so bound the files of a batch where history is read.
    """
    require_columns(bars, [*keys, ts, *OHLCV])
    w = windows or STANDARD_WINDOWS.get(timeframe, WindowSet(1, 1, 1, 1))
    new = [f"ma_{w.ma}", f"median_{w.median}", "vwap", "bb_middle", "bb_upper", "bb_lower", "rsi"]
    kept = [*keys, ts, *OHLCV]
    schema = T.StructType([*[bars.schema[c] for c in kept], *[T.StructField(c, T.DoubleType()) for c in new]])
    rows = bars.select(*[quoted(c) for c in kept], F.expr(f"{epoch_micros_sql(ts)} AS _at"))
    processor = _Series(rows.columns, w, forget_after, [*kept, *new])
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="None" if forget_after is None else "ProcessingTime",
    )
