"""From ticks or minute bars to frames with metrics, checks, reports and charts.

Everything is a lazy plan.  A large input should name a ``store``: the bars are
then rolled up once, in one scan and one shuffle, and every later table reads
the stored frame it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from barloom.operators import quality, shaping, stats
from barloom.operators.changes import rolling_volatility, with_returns
from barloom.operators.indicators import compact_metrics, standard_metrics_by_timeframe
from barloom.operators.rollup import (
    roll_up,
    roll_up_frames,
    roll_up_many,
    split_frames,
    stack_frames,
)
from barloom.operators.series import BLOCK_DAYS
from barloom.schema import KEYS, OHLCV, PRICES, SESSION, TIMEFRAME, TIMESTAMP
from barloom.functions.timegrid import session_of
from barloom.sources.published import PublishedRuns
from barloom.sources.sinks import read_stored_bars, store_frames, write_bars

FRAMES = ("1m", "5m", "30m", "1d")
METRIC_FRAMES = ("1m", "5m", "30m")

# Window sizes of the compact set, for one series and for many.
COMPACT_WINDOWS = {"1m": 20, "5m": 10, "30m": 5}
MANY_SYMBOL_WINDOWS = {"5m": 6, "30m": 1}
BATCH_WINDOW = 6


@dataclass(frozen=True)
class BarRun:
    """The plans of one run, by name."""

    frames: dict[str, DataFrame]
    checks: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    charts: dict[str, DataFrame]


def build_frames(
    source: DataFrame,
    *,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    store: str | None = None,
    timeframes: Sequence[str] = FRAMES,
) -> dict[str, DataFrame]:
    """Bars of every timeframe; stored and read back when ``store`` is given."""
    if store is None:
        return roll_up_frames(source, timeframes, tiebreak=tiebreak, keys=keys, ts=ts)
    stacked = roll_up_many(source, timeframes, tiebreak=tiebreak, keys=keys, ts=ts)
    write_bars(stacked, store, ts=ts)
    fields = [f for f in stacked.schema.fields if f.name != TIMEFRAME]
    stored = read_stored_bars(source.sparkSession, store, bars=fields).drop(SESSION)
    return split_frames(stored, timeframes)


def add_standard_metrics(frames: Mapping[str, DataFrame], **series) -> dict[str, DataFrame]:
    """The standard set on the intraday frames; daily bars stay as they are."""
    return {**frames, **standard_metrics_by_timeframe(frames, METRIC_FRAMES, **series)}


def add_compact_metrics(
    frames: Mapping[str, DataFrame], windows: Mapping[str, int] = COMPACT_WINDOWS, **series
) -> dict[str, DataFrame]:
    done = {
        tf: compact_metrics(
            frames[tf], w, **{"block_days": BLOCK_DAYS.get(tf), **series}
        )
        for tf, w in windows.items()
    }
    return {**frames, **done}


def check_tables(
    frames: Mapping[str, DataFrame], *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> dict[str, DataFrame]:
    """Bar, roll-up, range, spacing, repetition and metric checks of the enriched frames."""
    minute = frames["1m"]
    coarse = {tf: df for tf, df in frames.items() if tf != "1m"}
    return {
        "bars": quality.validate_bars(minute, keys=keys),
        **{
            f"rollup_{tf}": quality.validate_rollup(minute, df, None, keys=keys)
            for tf, df in coarse.items()
        },
        **{
            f"spacing_{tf}": quality.bar_spacing(frames[tf], tf, keys=keys, ts=ts)
            for tf in METRIC_FRAMES
        },
        "repeated": minute.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n_bars")).where("n_bars > 1"),
        "ranges": quality.range_consistency(frames, keys=keys),
        "metrics_5m": quality.validate_metrics(frames["5m"], keys=keys, ts=ts),
        "metrics_30m": quality.validate_metrics(frames["30m"], keys=keys, ts=ts),
    }


def report_tables(
    frames: Mapping[str, DataFrame],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    **series,
) -> dict[str, DataFrame]:
    """What the text reports and the dashboard print, as tables."""
    minute, five, thirty = frames["1m"], frames["5m"], frames["30m"]
    bars = {tf: df.select(*keys, ts, *OHLCV) for tf, df in frames.items()}
    returns = with_returns(bars["1m"], keys=keys, ts=ts, **series)
    return {
        "overview": stats.stack_reports(
            {tf: stats.bar_stats(df, keys=keys, ts=ts) for tf, df in bars.items()}
        ),
        "bar_counts": stats.bar_ratio(stack_frames(bars), list(frames), keys=keys),
        "price_statistics": stats.describe(minute, OHLCV[:4], keys=keys),
        "volume_statistics": stats.describe(minute, ["volume"], keys=keys),
        "returns_statistics": stats.describe(returns, ["returns"], keys=keys),
        "risk": stats.risk_metrics(bars["1m"], keys=keys, ts=ts, **series),
        "completeness": quality.completeness(minute, "1m", keys=keys, ts=ts),
        "indicator_analysis": stats.stack_reports(
            {
                "5m": _plain_names(stats.indicator_summary(five, keys=keys)),
                "30m": _plain_names(stats.indicator_summary(thirty, keys=keys)),
            }
        ),
        "indicator_statistics": stats.describe_indicators(five, keys=keys, ts=ts),
        "price_levels": shaping.scaled_first_rows(five, keys=keys, ts=ts),
        "dashboard": stats.quick_stats(bars["1m"], five, keys=keys, ts=ts, **series),
    }


def _plain_names(df: DataFrame) -> DataFrame:
    """Name moving-average columns without their window size."""
    for c in df.columns:
        for prefix in ("ma", "median", "mean_ma"):
            if c.startswith(f"{prefix}_") and c.removeprefix(f"{prefix}_").isdigit():
                df = df.withColumnRenamed(c, prefix)
    return df


def chart_tables(
    frames: Mapping[str, DataFrame],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    **series,
) -> dict[str, DataFrame]:
    """The data behind every chart, reduced in Spark as far as the chart allows."""
    minute = frames["1m"].select(*keys, ts, *OHLCV)
    moves = rolling_volatility(minute, keys=keys, ts=ts, **series)
    points = stats.normal_points(moves, keys=keys)
    tables = {
        "returns": moves.select(*keys, ts, "returns", "volatility"),
        "returns_histogram": stats.histogram(moves, keys=keys, ts=ts),
        "returns_marks": stats.distribution_summary(moves, keys=keys),
        "normal_points": points,
        "normal_line": stats.normal_fit(points, keys=keys),
        "correlation_5m": stats.correlation_matrix(frames["5m"], keys=keys),
    }
    for tf in ("5m", "30m"):
        bars = frames[tf]
        tables[f"candles_{tf}"] = shaping.candles(
            bars.select(*keys, ts, *OHLCV), tf
        )
        tables[f"indicators_{tf}"] = shaping.indicator_lines(bars, keys=keys, ts=ts)
    return tables


def run_bars(
    source: DataFrame,
    *,
    compact: bool = False,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    store: str | None = None,
    **series,
) -> BarRun:
    """Frames with metrics, and the checks, reports and charts made from them.

    With a ``store`` the bars and then the metrics are written once, and the
    tables read them back with only the columns they need.
    """
    bars_at = f"{store.rstrip('/')}/bars" if store else None
    frames = build_frames(source, tiebreak=tiebreak, keys=keys, ts=ts, store=bars_at)
    add = add_compact_metrics if compact else add_standard_metrics
    enriched = add(frames, keys=keys, ts=ts, **series)
    if store:
        enriched = store_frames(enriched, f"{store.rstrip('/')}/metrics")
    return BarRun(
        frames=enriched,
        checks=check_tables(enriched, keys=keys, ts=ts),
        reports=report_tables(enriched, keys=keys, ts=ts, **series),
        charts=chart_tables(enriched, keys=keys, ts=ts, **series),
    )


def stacked_metrics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Frames with metrics as one long table; frames without them get nulls."""
    plain = {tf: _plain_names(df).withColumn("timeframe", F.lit(tf)) for tf, df in frames.items()}
    stacked: DataFrame | None = None
    for df in plain.values():
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def run_symbols(
    source: DataFrame,
    *,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    store: str | None = None,
    **series,
) -> dict[str, DataFrame]:
    """All symbols at once: minute and daily bars, 5m and 30m bars with compact metrics."""
    bars_at = f"{store.rstrip('/')}/bars" if store else None
    frames = build_frames(source, tiebreak=tiebreak, keys=keys, ts=ts, store=bars_at)
    return add_compact_metrics(frames, MANY_SYMBOL_WINDOWS, keys=keys, ts=ts, **series)


def batch_metrics(
    source: DataFrame,
    *,
    timeframe: str = "5m",
    window: int = BATCH_WINDOW,
    tiebreak: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Roll-up and metrics of each session on its own.

    No state crosses sessions, so a backfill may run any range of days, and no
    window ever holds more than one symbol's day.
    """
    bars = roll_up(source, timeframe, keys=keys, ts=ts, tiebreak=tiebreak)
    return compact_metrics(
        bars.withColumn(SESSION, session_of(ts)),
        window,
        keys=[*keys, SESSION],
        ts=ts,
        block_days=None,
    )


def publish_bars(source: DataFrame, runs: PublishedRuns, *, csv: bool = False, **options) -> int:
    """:func:`run_bars`, all of its tables published as one run; returns the run's number.

    Ticks that reach no bar, for want of a time or a price, are counted in the scan that
    makes the bars.  ``csv`` writes the frames with their metrics as headed CSV.
    """
    ts = options.get("ts", TIMESTAMP)
    folder = f"runs/{uuid.uuid4().hex}"
    seen = Observation()
    price = F.greatest(*[F.col(p).isNull().cast("int") for p in PRICES]) == 1
    watched = source.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(ts).isNull()).alias("no_time"),
        F.count_if(price).alias("no_price"),
    )
    result = run_bars(watched, store=f"{runs.path.rstrip('/')}/{folder}/store", **options)
    tables = {
        f"{kind}_{name}": df
        for kind, group in (("frame", result.frames), ("check", result.checks), ("report", result.reports), ("chart", result.charts))
        for name, df in group.items()
    }
    formats = {f"frame_{tf}": "csv" for tf in result.frames} if csv else {}
    counts = [("source", check, int(n)) for check, n in seen.get.items()]
    return runs.publish(tables, formats=formats, counts=counts, folder=folder)
