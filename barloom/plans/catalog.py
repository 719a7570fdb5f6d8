"""Named queries over the test tables, one or more per operator.

Every query takes a session and a directory of Parquet tables, reads whole
tables, and returns a frame, lazy but where it has to write files or run a stream first.
``oracle.py`` holds the same questions in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barloom.functions.bar_columns import (
    path_from_returns,
    path_high,
    path_low,
    typical_price,
)
from barloom.functions.timegrid import clock_label, session_of
from barloom.operators import changes, indicators, order_stats, quality, rollup, shaping, stats
from barloom.operators.comoments import correlations
from barloom.operators.exact_sums import exact_vwap, with_exact_vwap
from barloom.plans import run
from barloom.schema import OHLCV, SESSION, SYMBOL, TIMEFRAME, TIMESTAMP, conform, numeric_columns
from barloom.sources import calendar, series_store, sinks
from barloom.sources.published import PublishedRuns
from barloom.sources.summaries import SessionSummaries
from barloom.sources.ticks import as_ticks, read_bars
from barloom.streaming import bars as streaming
from barloom.streaming.corrections import CorrectedBars, correct_available
from barloom.streaming.keyed import keyed_metrics, keyed_session
from barloom.streaming.metrics import metrics_handler, read_metrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TICK_TIES = ["event_id"]
# Blocks of the intraday series; short enough that the tables cross several.
INTRADAY = {"block_days": 7}
# Blocks of the daily series of several years.
DAILY = {"block_days": 365}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# A half, and a little for what summation error may take from a tie.
HALF = 0.5001


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles to six places, so that another summation order gives equal values.

    Spelled out in plain arithmetic, because engines round ties differently.
    """
    return df.selectExpr(
        *[
            f"floor(`{c}` * 1000000.0D + {HALF}D) / 1000000.0D AS `{c}`" if t == "double" else f"`{c}`"
            for c, t in df.dtypes
        ]
    )


# --- inputs ------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def ticks_of(events: DataFrame, **bounds) -> DataFrame:
    return as_ticks(
        events,
        symbol="event_type",
        timestamp="ts",
        price="value",
        volume=F.get_json_object("props", "$.k"),
        tiebreak=TICK_TIES,
        **bounds,
    )


def bars(spark: SparkSession, sf_dir: str, timeframe: str) -> DataFrame:
    return rollup.roll_up(ticks(spark, sf_dir), timeframe, tiebreak=TICK_TIES)


LINE_TIES = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
]


def brand_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return as_ticks(
        lines.join(parts, lines.l_partkey == parts.p_partkey),
        symbol="p_brand",
        timestamp="l_shipdate",
        price=F.col("l_extendedprice") / F.col("l_quantity"),
        volume="l_quantity",
        tiebreak=LINE_TIES,
    )


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.roll_up(brand_ticks(spark, sf_dir), "1d", tiebreak=LINE_TIES)


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    order_ticks = as_ticks(
        table(spark, sf_dir, "orders"),
        symbol="o_orderpriority",
        timestamp="o_orderdate",
        price="o_totalprice",
        tiebreak=["o_orderkey"],
    )
    return rollup.roll_up(order_ticks, "1d", tiebreak=["o_orderkey"])


# --- roll-up -----------------------------------------------------------------


@query
def ohlc_1m(spark, sf_dir):
    return bars(spark, sf_dir, "1m")


@query
def ohlc_5m(spark, sf_dir):
    return bars(spark, sf_dir, "5m")


@query
def ohlc_30m(spark, sf_dir):
    return bars(spark, sf_dir, "30m")


@query
def ohlc_1d(spark, sf_dir):
    return bars(spark, sf_dir, "1d")


@query
def ohlc_multi(spark, sf_dir):
    return rollup.roll_up_many(ticks(spark, sf_dir), tiebreak=TICK_TIES)


@query
def ohlc_multi_custom(spark, sf_dir):
    return rollup.roll_up_many(
        ticks(spark, sf_dir), ["2m", "15m", "1h", "1w"], tiebreak=TICK_TIES
    )


@query
def ohlc_weeks(spark, sf_dir):
    """Bars of one and several weeks, alone and in a cascade."""
    source = ticks(spark, sf_dir)
    frames = rollup.roll_up_frames(source, ["1d", "1w", "2w", "4w"], tiebreak=TICK_TIES)
    frames["2w alone"] = rollup.roll_up(source, "2w", tiebreak=TICK_TIES)
    return rollup.stack_frames(frames)


@query
def run_range(spark, sf_dir):
    """Five-minute bars of a range of days; the range reaches the scan."""
    events = table(spark, sf_dir, "events")
    return rollup.roll_up(
        ticks_of(events, start="2024-01-10", end="2024-01-17"), "5m", tiebreak=TICK_TIES
    )


@query
def ohlc_daily_brand(spark, sf_dir):
    return brand_bars(spark, sf_dir)


@query
def ohlc_daily_orders(spark, sf_dir):
    return order_bars(spark, sf_dir)


# --- indicators --------------------------------------------------------------


def thirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir, "30m")


@query
def moving_average(spark, sf_dir):
    return rounded(indicators.moving_average(thirty(spark, sf_dir), 14, **INTRADAY))


@query
def moving_average_volume(spark, sf_dir):
    return rounded(
        indicators.moving_average(thirty(spark, sf_dir), 30, "volume", **INTRADAY)
    )


@query
def moving_median(spark, sf_dir):
    return rounded(indicators.moving_median(thirty(spark, sf_dir), 14, **INTRADAY))


@query
def moving_median_long(spark, sf_dir):
    """The median price of the last 5,000 ticks."""
    rows = ticks(spark, sf_dir).select(SYMBOL, TIMESTAMP, *TICK_TIES, "close")
    return rounded(indicators.moving_median(rows, 5000, tiebreak=TICK_TIES, **INTRADAY))


@query
def moving_quantile_long(spark, sf_dir):
    """The lower quartile of the volume of the last 700 bars."""
    one = bars(spark, sf_dir, "1m")
    return rounded(order_stats.moving_quantile(one, 700, "volume", 0.25, group_rows=1024, **INTRADAY))


@query
def vwap_series(spark, sf_dir):
    return rounded(indicators.vwap(thirty(spark, sf_dir), **INTRADAY))


@query
def vwap_session(spark, sf_dir):
    return rounded(indicators.vwap(thirty(spark, sf_dir), anchor="session"))


@query
def vwap_brand(spark, sf_dir):
    return rounded(indicators.vwap(brand_bars(spark, sf_dir), **DAILY))


@query
def bollinger(spark, sf_dir):
    return rounded(indicators.bollinger_bands(thirty(spark, sf_dir), 20, 2.0, **INTRADAY))


@query
def rsi(spark, sf_dir):
    return rounded(indicators.rsi(thirty(spark, sf_dir), 14, **INTRADAY))


@query
def metrics_standard_1m(spark, sf_dir):
    return rounded(
        indicators.standard_metrics(bars(spark, sf_dir, "1m"), "1m", **INTRADAY)
    )


@query
def metrics_standard(spark, sf_dir):
    return rounded(
        indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    )


@query
def metrics_standard_30m(spark, sf_dir):
    return rounded(
        indicators.standard_metrics(bars(spark, sf_dir, "30m"), "30m", **INTRADAY)
    )


@query
def metrics_compact(spark, sf_dir):
    return rounded(indicators.compact_metrics(thirty(spark, sf_dir), 10, **INTRADAY))


@query
def metrics_brand(spark, sf_dir):
    return rounded(indicators.compact_metrics(brand_bars(spark, sf_dir), 20, **DAILY))


# --- row to row --------------------------------------------------------------


@query
def price_change(spark, sf_dir):
    return rounded(changes.with_change(thirty(spark, sf_dir), **INTRADAY))


@query
def previous_close(spark, sf_dir):
    return changes.with_previous(thirty(spark, sf_dir), "close", "previous_close", **INTRADAY)


@query
def gap_seconds(spark, sf_dir):
    return changes.with_gap_seconds(thirty(spark, sf_dir))


@query
def returns(spark, sf_dir):
    return rounded(changes.with_returns(thirty(spark, sf_dir), **INTRADAY))


@query
def rolling_vol(spark, sf_dir):
    return rounded(changes.rolling_volatility(thirty(spark, sf_dir), 20, **INTRADAY))


@query
def running_volume(spark, sf_dir):
    return changes.with_running_sum(thirty(spark, sf_dir), "volume", **INTRADAY)


@query
def smoothness(spark, sf_dir):
    return rounded(changes.smoothness(order_bars(spark, sf_dir), 30, **DAILY))


@query
def price_index(spark, sf_dir):
    moves = changes.with_returns(order_bars(spark, sf_dir), **DAILY)
    indexed = changes.with_price_index(moves, initial_price=100.0, **DAILY)
    return rounded(indexed.select(SYMBOL, TIMESTAMP, "close", "returns", "price_index"))


@query
def open_from_prev(spark, sf_dir):
    return changes.with_open_from_previous_close(
        thirty(spark, sf_dir), initial_price=100.0, **INTRADAY
    )


# --- scalar work on bars -----------------------------------------------------


@query
def typical_prices(spark, sf_dir):
    return rounded(thirty(spark, sf_dir).withColumn("typical_price", typical_price()))


@query
def repair(spark, sf_dir):
    """Bars whose open was moved to the previous close, then widened to hold it."""
    moved = changes.with_open_from_previous_close(
        thirty(spark, sf_dir), initial_price=100.0, **INTRADAY
    )
    return shaping.repair_bars(moved)


@query
def path_bars(spark, sf_dir):
    """A bar from four in-bar returns of every order line."""
    lines = table(spark, sf_dir, "lineitem")
    moves = F.array(
        F.col("l_discount"), -F.col("l_tax"), F.col("l_tax"), -F.col("l_discount")
    )
    paths = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("open"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("close"),
        path_from_returns("l_extendedprice", moves).alias("path"),
    )
    return rounded(
        paths.select(
            "l_orderkey",
            "l_linenumber",
            "open",
            path_high("open", "path", "close").alias("high"),
            path_low("open", "path", "close").alias("low"),
            "close",
            F.element_at("path", -1).alias("path_end"),
        )
    )


@query
def candles(spark, sf_dir):
    return rounded(shaping.candles(thirty(spark, sf_dir), "30m"))


@query
def scaled(spark, sf_dir):
    return shaping.scaled_first_rows(bars(spark, sf_dir, "5m"), 20)


@query
def rsi_flags(spark, sf_dir):
    return rounded(
        shaping.rsi_flags(indicators.rsi(thirty(spark, sf_dir), 14, **INTRADAY)).select(
            SYMBOL, TIMESTAMP, "rsi", "overbought", "oversold"
        )
    )


@query
def indicator_lines(spark, sf_dir):
    """What an indicator chart draws: close, the first five indicators, RSI."""
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(shaping.indicator_lines(metrics))


@query
def clock_fields(spark, sf_dir):
    return thirty(spark, sf_dir).select(
        SYMBOL,
        TIMESTAMP,
        clock_label(TIMESTAMP).alias("label"),
        F.hour(TIMESTAMP).alias("hour"),
        F.minute(TIMESTAMP).alias("minute"),
        session_of(TIMESTAMP).alias(SESSION),
    )


@query
def conform_types(spark, sf_dir):
    """Order lines as bars whose prices arrive as whole numbers."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(SYMBOL),
        F.col("l_shipdate").cast("date").alias(TIMESTAMP),
        *[F.col("l_orderkey").alias(c) for c in OHLCV[:3]],
        F.col("l_extendedprice").alias("close"),
        F.col("l_linenumber").alias("volume"),
    )
    return conform(lines)


@query
def first_rows(spark, sf_dir):
    return shaping.first_rows(thirty(spark, sf_dir), 20)


@query
def head_rows(spark, sf_dir):
    return shaping.head_rows(thirty(spark, sf_dir), 5)


@query
def frame_summary(spark, sf_dir):
    return shaping.frame_shape(thirty(spark, sf_dir))


# --- joins and unions --------------------------------------------------------


@query
def join_on_time(spark, sf_dir):
    """First closes of each symbol joined with their volumes."""
    five = bars(spark, sf_dir, "5m")
    closes = shaping.first_rows(five.select(SYMBOL, TIMESTAMP, "close"), 20)
    return shaping.join_on_time(closes, five.select(SYMBOL, TIMESTAMP, "volume"))


@query
def align_timeframes(spark, sf_dir):
    return shaping.align_timeframes(
        bars(spark, sf_dir, "5m"), bars(spark, sf_dir, "30m"), "30m"
    )


@query
def shift_days(spark, sf_dir):
    return shaping.shift_days(thirty(spark, sf_dir), 3)


@query
def union_days(spark, sf_dir):
    daily = bars(spark, sf_dir, "1d")
    return shaping.union_days(daily, shaping.shift_days(daily, 30))


@query
def duplicate_bars(spark, sf_dir):
    """Days joined without shifting them repeat their keys."""
    daily = bars(spark, sf_dir, "1d")
    return shaping.duplicate_bars(shaping.union_days(daily, shaping.shift_days(daily, 10)))


# --- calendar ----------------------------------------------------------------


@query
def session_spine(spark, sf_dir):
    days = calendar.traded_sessions(ticks(spark, sf_dir))
    return calendar.session_spine(days)


@query
def missing_minutes(spark, sf_dir):
    return calendar.missing_minutes(bars(spark, sf_dir, "1m"))


# --- checks ------------------------------------------------------------------


@query
def validate_bars(spark, sf_dir):
    return quality.validate_bars(thirty(spark, sf_dir))


@query
def validate_rollup(spark, sf_dir):
    return quality.validate_rollup(ticks(spark, sf_dir), bars(spark, sf_dir, "1d"), 30)


@query
def validate_rollup_odd(spark, sf_dir):
    """A null symbol on both sides, one that was not rolled up, and one that has no source."""
    source = ticks(spark, sf_dir)
    daily = rollup.roll_up(source, "1d", tiebreak=TICK_TIES)
    no_name = F.when(F.col(SYMBOL) != "click", F.col(SYMBOL)).alias(SYMBOL)
    named = F.when(F.col(SYMBOL) == "view", "ghost").when(F.col(SYMBOL) != "click", F.col(SYMBOL)).alias(SYMBOL)
    others = [c for c in daily.columns if c != SYMBOL]
    return quality.validate_rollup(
        source.select(no_name, *[c for c in source.columns if c != SYMBOL]), daily.select(named, *others), 30
    )


@query
def describe_odd(spark, sf_dir):
    """Prices of ticks of which some have no symbol, no price or NaN for one."""
    source = ticks(spark, sf_dir)
    odd = source.select(
        F.when(F.col(SYMBOL) != "click", F.col(SYMBOL)).alias(SYMBOL),
        F.expr("CASE WHEN event_id % 11 = 0 THEN double('NaN') WHEN event_id % 13 = 0 THEN NULL ELSE close END AS close"),
    )
    return rounded(stats.describe(odd, ["close"]))


@query
def validate_metrics(spark, sf_dir):
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(quality.validate_metrics(metrics))


@query
def range_check(spark, sf_dir):
    stacked = rollup.roll_up_many(
        ticks(spark, sf_dir), ["1m", "5m", "30m", "1d"], tiebreak=TICK_TIES
    )
    return quality.range_consistency_long(stacked)


@query
def spacing(spark, sf_dir):
    return quality.bar_spacing(thirty(spark, sf_dir), "30m")


@query
def session_counts(spark, sf_dir):
    return quality.session_counts(thirty(spark, sf_dir), 48, "30m")


@query
def completeness(spark, sf_dir):
    return rounded(quality.completeness(bars(spark, sf_dir, "1m"), "1m"))


# --- statistics --------------------------------------------------------------


@query
def bar_stats(spark, sf_dir):
    stacked = rollup.roll_up_many(ticks(spark, sf_dir), tiebreak=TICK_TIES)
    return rounded(stats.bar_stats(stacked, keys=[SYMBOL, TIMEFRAME]))


@query
def describe_prices(spark, sf_dir):
    return rounded(stats.describe(thirty(spark, sf_dir), OHLCV))


@query
def describe_returns(spark, sf_dir):
    moves = changes.with_returns(thirty(spark, sf_dir), **INTRADAY)
    return rounded(stats.describe(moves, ["returns"]))


@query
def describe_indicators(spark, sf_dir):
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(stats.describe_indicators(metrics))


@query
def describe_brand(spark, sf_dir):
    return rounded(stats.describe(brand_ticks(spark, sf_dir), ["close", "volume"]))


@query
def risk(spark, sf_dir):
    return rounded(stats.risk_metrics(thirty(spark, sf_dir), **INTRADAY))


@query
def correlation(spark, sf_dir):
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(stats.correlation_matrix(metrics))


@query
def correlation_one_pass(spark, sf_dir):
    """The same from matrices of moments."""
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(correlations(metrics, numeric_columns(metrics, exclude=[SYMBOL])))


@query
def exact_totals(spark, sf_dir):
    """Turnover, volume and VWAP of the ticks of each session, the same however rows are dealt."""
    dated = ticks(spark, sf_dir).withColumn(SESSION, session_of(TIMESTAMP))
    return rounded(exact_vwap(dated, price="close", keys=[SYMBOL, SESSION]))


@query
def vwap_exact(spark, sf_dir):
    """The running VWAP from exact totals of blocks."""
    return rounded(with_exact_vwap(thirty(spark, sf_dir), **INTRADAY))


@query
def histogram(spark, sf_dir):
    moves = changes.with_returns(thirty(spark, sf_dir), **INTRADAY)
    return rounded(stats.histogram(moves))


@query
def distribution(spark, sf_dir):
    moves = changes.with_returns(thirty(spark, sf_dir), **INTRADAY)
    return rounded(stats.distribution_summary(moves))


@query
def qq_points(spark, sf_dir):
    moves = changes.with_returns(thirty(spark, sf_dir), **INTRADAY)
    return rounded(stats.normal_points(moves))


@query
def qq_fit(spark, sf_dir):
    moves = changes.with_returns(thirty(spark, sf_dir), **INTRADAY)
    return rounded(stats.normal_fit(stats.normal_points(moves)))


@query
def indicator_summary(spark, sf_dir):
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(stats.indicator_summary(metrics))


@query
def ratio(spark, sf_dir):
    frames = ["1m", "5m", "30m", "1d"]
    stacked = rollup.roll_up_many(ticks(spark, sf_dir), frames, tiebreak=TICK_TIES)
    return stats.bar_ratio(stacked, frames)


@query
def quick_stats(spark, sf_dir):
    metrics = indicators.standard_metrics(bars(spark, sf_dir, "5m"), "5m", **INTRADAY)
    return rounded(stats.quick_stats(bars(spark, sf_dir, "1m"), metrics, **INTRADAY))


# --- whole runs --------------------------------------------------------------


@query
def run_standard(spark, sf_dir):
    frames = run.build_frames(ticks(spark, sf_dir), tiebreak=TICK_TIES)
    return rounded(run.stacked_metrics(run.add_standard_metrics(frames, **INTRADAY)))


@query
def run_compact(spark, sf_dir):
    frames = run.build_frames(ticks(spark, sf_dir), tiebreak=TICK_TIES)
    return rounded(run.stacked_metrics(run.add_compact_metrics(frames, **INTRADAY)))


@query
def run_many_symbols(spark, sf_dir):
    frames = run.run_symbols(ticks(spark, sf_dir), tiebreak=TICK_TIES, **INTRADAY)
    return rounded(run.stacked_metrics(frames))


@query
def session_batches(spark, sf_dir):
    return rounded(run.batch_metrics(ticks(spark, sf_dir), tiebreak=TICK_TIES))


@query
def stored_run(spark, sf_dir):
    """Bars stored by timeframe and session, metrics stored, one report read back."""
    result = run.run_bars(
        ticks(spark, sf_dir),
        tiebreak=TICK_TIES,
        store=sinks.shared_folder(spark, "run"),
        **INTRADAY,
    )
    return rounded(result.reports["indicator_analysis"])


@query
def metrics_stored(spark, sf_dir):
    """Standard metrics of bars that are stored by series and block, read without a shuffle."""
    folder = sinks.shared_folder(spark, "series")
    name = f"series_{folder[-32:]}"
    series_store.store_standard(bars(spark, sf_dir, "5m"), name, folder, "5m", buckets=8, **INTRADAY)
    return rounded(series_store.standard_metrics_of(spark, name, "5m"))


@query
def metrics_stored_week(spark, sf_dir):
    """The same for eight days, of which only the blocks are read."""
    folder = sinks.shared_folder(spark, "series")
    name = f"series_{folder[-32:]}"
    series_store.store_standard(bars(spark, sf_dir, "5m"), name, folder, "5m", buckets=8, **INTRADAY)
    range_of_days = {"start": date(2024, 1, 10), "end": date(2024, 1, 18)}
    return rounded(series_store.standard_metrics_of(spark, name, "5m", **range_of_days))


SOME_DAYS = (date(2024, 1, 10), date(2024, 1, 18))
_SUMMARIES: dict[tuple[str, str, str], SessionSummaries] = {}


def summaries(spark: SparkSession, sf_dir: str, timeframe: str) -> SessionSummaries:
    """Summaries of the standard metrics by session, stored once for all queries of an application."""
    key = (spark.sparkContext.applicationId, sf_dir, timeframe)
    if key in _SUMMARIES and sinks.exists(spark, f"{_SUMMARIES[key].path}/moments/_SUCCESS"):
        return _SUMMARIES[key]
    columns = (*OHLCV, "vwap", "rsi") if timeframe == "5m" else OHLCV
    made = SessionSummaries(sinks.shared_folder(spark, "summaries"), timeframe, columns)
    rows = bars(spark, sf_dir, timeframe)
    made.store(indicators.standard_metrics(rows, "5m", **INTRADAY) if timeframe == "5m" else rows)
    _SUMMARIES[key] = made
    return made


@query
def summary_describe(spark, sf_dir):
    """Prices, volume and returns of eight days described from summaries of their sessions."""
    return rounded(summaries(spark, sf_dir, "30m").describe(spark, *SOME_DAYS))


@query
def summary_describe_all(spark, sf_dir):
    """The same of all sessions."""
    return rounded(summaries(spark, sf_dir, "30m").describe(spark))


@query
def summary_risk(spark, sf_dir):
    return rounded(summaries(spark, sf_dir, "30m").risk(spark, *SOME_DAYS))


@query
def summary_bars(spark, sf_dir):
    return rounded(summaries(spark, sf_dir, "30m").bar_stats(spark, *SOME_DAYS))


@query
def summary_completeness(spark, sf_dir):
    return rounded(summaries(spark, sf_dir, "1m").completeness(spark, *SOME_DAYS))


@query
def summary_dashboard(spark, sf_dir):
    """The dashboard of eight days; VWAP and RSI are those of the whole series."""
    metrics = summaries(spark, sf_dir, "5m")
    return rounded(summaries(spark, sf_dir, "1m").dashboard(metrics, spark, *SOME_DAYS))


_RUNS: dict[tuple[str, str], tuple[str, run.BarRun]] = {}


def whole_run(spark: SparkSession, sf_dir: str) -> run.BarRun:
    """A stored run; queries of one application that read tables of the same run share it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _RUNS and sinks.exists(spark, f"{_RUNS[key][0]}/metrics/1d/_SUCCESS"):
        return _RUNS[key][1]
    folder = sinks.shared_folder(spark, "run")
    _RUNS[key] = folder, run.run_bars(ticks(spark, sf_dir), tiebreak=TICK_TIES, store=folder, **INTRADAY)
    return _RUNS[key][1]


def delivered(kind: str, name: str) -> Query:
    """A table as a run delivers it."""

    def of_run(spark, sf_dir):
        return rounded(getattr(whole_run(spark, sf_dir), f"{kind}s")[name])

    of_run.__name__ = f"{kind}_{name}"
    return query(of_run)


for _report in (
    "overview", "bar_counts", "price_statistics", "volume_statistics", "returns_statistics", "risk",
    "completeness", "indicator_analysis", "indicator_statistics", "price_levels", "dashboard",
):
    delivered("report", _report)
for _chart in (
    "returns", "returns_histogram", "returns_marks", "normal_points", "normal_line",
    "correlation_5m", "candles_5m", "candles_30m", "indicators_5m", "indicators_30m",
):
    delivered("chart", _chart)


@query
def run_checks(spark, sf_dir):
    """The verdicts of all checks of a run, with the number each goes by."""
    found = {"spacing": ("uneven_steps", "evenly_spaced"), "ranges": ("n_timeframes", "consistent"), "repeated": ("n_bars", "false")}
    parts = []
    for name, df in whole_run(spark, sf_dir).checks.items():
        n, ok = found.get(name.split("_")[0], ("n_bars", "valid"))
        parts.append(df.selectExpr(SYMBOL, f"'{name}' AS check_name", f"CAST({n} AS BIGINT) AS n", f"{ok} AS ok"))
    return reduce(DataFrame.unionByName, parts)


@query
def enriched_csv(spark, sf_dir):
    """Frames with their metrics, published as headed CSV and read back as one long table."""
    frames = run.add_standard_metrics(run.build_frames(ticks(spark, sf_dir), tiebreak=TICK_TIES), **INTRADAY)
    runs = PublishedRuns(sinks.shared_folder(spark, "published"))
    runs.publish(frames, formats=dict.fromkeys(frames, "csv"))
    return rounded(run.stacked_metrics(runs.tables(spark)))


@query
def published_counts(spark, sf_dir):
    """What the second of two runs counted while it wrote its tables; ticks of one symbol lack a time or a price."""
    source = ticks(spark, sf_dir)
    odd = source.withColumn(TIMESTAMP, F.expr("IF(symbol = 'click' AND event_id % 10 = 0, NULL, timestamp)"))
    odd = odd.withColumns({c: F.expr(f"IF(symbol = 'view' AND event_id % 7 = 0, NULL, {c})") for c in OHLCV[:4]})
    runs = PublishedRuns(sinks.shared_folder(spark, "published"))
    runs.publish({"bars": rollup.roll_up(source, "1d", tiebreak=TICK_TIES)})
    runs.publish({"ticks": odd, "bars": rollup.roll_up(odd, "1d", tiebreak=TICK_TIES)})
    return runs.counts(spark).where("check IN ('rows', 'no_time', 'no_price')")


# --- sinks and streams -------------------------------------------------------


@query
def csv_export(spark, sf_dir):
    """Roll up, write headed CSV by timeframe, read it back with the declared types."""
    folder = sinks.shared_folder(spark, "csv")
    sinks.write_long_csv(
        rollup.roll_up_many(ticks(spark, sf_dir), tiebreak=TICK_TIES), folder
    )
    return read_bars(spark, folder, fmt="csv", partitions={TIMEFRAME: T.StringType()})


@query
def report_export(spark, sf_dir):
    """A report table written as JSON and read back."""
    folder = sinks.shared_folder(spark, "reports")
    counts = quality.completeness(bars(spark, sf_dir, "1m"), "1m")
    (target,) = sinks.write_reports({"completeness": rounded(counts)}, folder)
    return spark.read.schema(counts.schema).json(target)


STREAM_LATENESS = "10 minutes"
STATE_PARTITIONS = 8


def closed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream of five-minute bars."""
    schema = table(spark, sf_dir, "events").schema
    events = streaming.read_file_stream(
        streaming.stream_session(spark, STATE_PARTITIONS), sf_dir, schema, pattern="events.parquet"
    )
    return streaming.stream_bars(
        ticks_of(events), "5m", lateness=STREAM_LATENESS, tiebreak=TICK_TIES
    )


@query
def streaming_bars(spark, sf_dir):
    """Five-minute bars of the event files as a stream; windows the watermark closed."""
    closed = closed_bars(spark, sf_dir)
    folder = sinks.shared_folder(spark, "stream")
    streaming.write_available(closed, f"{folder}/bars", f"{folder}/state")
    return spark.read.parquet(f"{folder}/bars")


@query
def streaming_all(spark, sf_dir):
    """The same to the end of the data: the windows that were still open, from a batch."""
    closed = closed_bars(spark, sf_dir)
    folder = sinks.shared_folder(spark, "stream")
    stream = streaming.write_available(closed, f"{folder}/bars", f"{folder}/state")
    last = streaming.open_bars(
        ticks(spark, sf_dir), "5m", streaming.watermark_of(stream, f"{folder}/state"), tiebreak=TICK_TIES
    )
    return spark.read.parquet(f"{folder}/bars").unionByName(last)


def arrivals(spark: SparkSession, sf_dir: str, folder: str, parts: list[DataFrame]) -> Iterator[DataFrame]:
    """The stream of a folder, after each of the parts was put there."""
    schema = table(spark, sf_dir, "events").schema
    for i, part in enumerate(parts):
        part.write.parquet(f"{folder}/in/{i}")
        yield ticks_of(streaming.read_file_stream(spark, f"{folder}/in/*", schema))


@query
def streaming_corrected(spark, sf_dir):
    """Bars of ticks that arrive in three parts of all times, one part twice; who changed a bar last."""
    events = table(spark, sf_dir, "events")
    folder = sinks.shared_folder(spark, "stream")
    parts = [events.where(F.pmod("event_id", F.lit(3)) == i) for i in (2, 0, 2, 1)]
    store = CorrectedBars(f"{folder}/store", "5m", TICK_TIES, tiebreak=TICK_TIES)
    for stream in arrivals(spark, sf_dir, folder, parts):
        correct_available(stream, store, f"{folder}/state")
    return store.bars(spark)


@query
def streaming_replaced(spark, sf_dir):
    """The bars as the second of three arrivals left them."""
    events = table(spark, sf_dir, "events")
    folder = sinks.shared_folder(spark, "stream")
    store = CorrectedBars(f"{folder}/store", "30m", TICK_TIES, tiebreak=TICK_TIES)
    for i in (2, 0, 1):
        store.apply(ticks_of(events.where(F.pmod("event_id", F.lit(3)) == i)), (2, 0, 1).index(i))
    return store.as_of(spark, 1)


@query
def streaming_replayed(spark, sf_dir):
    """Bars of a stream whose files, one for each half of the time, come twice."""
    events = table(spark, sf_dir, "events")
    folder = sinks.shared_folder(spark, "stream")
    child = streaming.stream_session(spark, STATE_PARTITIONS)
    first, last = events.select(F.min("ts"), F.max("ts")).first()
    middle = first + (last - first) / 2
    lateness = f"{int((last - first).total_seconds() / 2) + 60} seconds"
    halves = [events.where(F.col("ts") < middle), events.where((F.col("ts") >= middle) | F.col("ts").isNull())]
    for stream in arrivals(child, sf_dir, folder, [halves[0], halves[0], halves[1], halves[1]]):
        closed = streaming.stream_bars(stream, "5m", lateness=lateness, tiebreak=TICK_TIES, tick_key=TICK_TIES)
        done = streaming.write_available(closed, f"{folder}/bars", f"{folder}/state")
    rest = streaming.open_bars(
        ticks(spark, sf_dir), "5m", streaming.watermark_of(done, f"{folder}/state"), tiebreak=TICK_TIES
    )
    return spark.read.schema(rest.schema).parquet(f"{folder}/bars").unionByName(rest)


@query
def streaming_keyed(spark, sf_dir):
    """Standard metrics of streamed bars, from a ring of rows per symbol in the state store."""
    child = keyed_session(spark, STATE_PARTITIONS)
    events = streaming.read_file_stream(child, sf_dir, table(spark, sf_dir, "events").schema, pattern="events.parquet")
    closed = streaming.stream_bars(ticks_of(events), "5m", lateness=STREAM_LATENESS, tiebreak=TICK_TIES)
    folder = sinks.shared_folder(spark, "stream")
    streaming.write_available(keyed_metrics(closed, "5m"), f"{folder}/metrics", f"{folder}/state")
    return rounded(spark.read.parquet(f"{folder}/metrics"))


@query
def streaming_metrics(spark, sf_dir):
    """Standard metrics of streamed bars, continued from batch to batch."""
    closed = closed_bars(spark, sf_dir)
    folder = sinks.shared_folder(spark, "stream")
    handler = metrics_handler(folder, "5m", **INTRADAY)
    streaming.write_batches(closed, handler, f"{folder}/state")
    return rounded(read_metrics(spark, folder))
