"""Report tables over any range of sessions, from small stored summaries and not from bars.

Of each series and session is kept, once:

    days      size, times, extremes, volume, gaps, and the closes at both ends
    moments   of each described column: count, nulls, mean, squared deviations, extremes
    values    its distinct values with their copies

Counts, extremes and moments merge; quantiles come from the counted values.  The return from
one session to the next belongs to no session: it is made from the closes at the ends, so that
a range starts without a return, as its bars alone would.  NaN is missing, like null.  Bars without
a time are in no session and left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from barloom.functions.timegrid import step_seconds
from barloom.operators.changes import with_gap_seconds
from barloom.operators.quality import GAP_FACTOR
from barloom.operators.ranks import unwrapped_keys, wrapped_keys, wrapped_quantiles
from barloom.operators.stats import BARS_PER_YEAR, DESCRIBE_QUANTILES, unpivoted
from barloom.schema import KEYS, OHLCV, SESSION, TIMESTAMP, quoted, require_columns

RETURNS = "returns"
_BEFORE = "_close_before"


def _edged(bars: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """Bars with their session, gap, the known close before them in it, and the return from that."""
    by = ", ".join(map(quoted, (*keys, SESSION)))
    order = ", ".join(map(quoted, (ts, *tiebreak)))
    before = f"last(nullif(close, double('NaN')), true) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    timed = with_gap_seconds(bars.where(F.col(quoted(ts)).isNotNull()), keys=keys, ts=ts)
    moved = f"try_divide(coalesce(nullif(close, double('NaN')), {_BEFORE}), {_BEFORE}) - 1.0D AS {quoted(RETURNS)}"
    return timed.selectExpr("*", f"{before} AS {_BEFORE}").selectExpr("*", moved)


@dataclass(frozen=True)
class SessionSummaries:
    """Summaries of bars of one timeframe, under a folder that all executors share."""

    path: str
    timeframe: str
    columns: tuple[str, ...] = OHLCV
    keys: tuple[str, ...] = KEYS
    ts: str = TIMESTAMP
    tiebreak: tuple[str, ...] = ()

    def _table(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    @cached_property
    def _by_session(self) -> list[str]:
        return [*map(quoted, self.keys), SESSION]

    # --- writing -------------------------------------------------------------

    def store(self, bars: DataFrame) -> None:
        """Write the summaries of the sessions of these bars; other sessions stay as they are.

        Bars of a session have to come whole.  A repeated or broken-off call is mended by the next.
        """
        require_columns(bars, [*self.keys, self.ts, *self.tiebreak, *OHLCV, *self.columns])
        clash = {SESSION, RETURNS, "gap_seconds", _BEFORE, "_before"} & set(bars.columns)
        if clash:
            raise ValueError(f"columns {sorted(clash)} are made here")
        wanted = dict.fromkeys([*self.keys, self.ts, *self.tiebreak, *OHLCV, *self.columns])
        edged = _edged(bars.select(*map(quoted, wanted)), self.keys, self.ts, self.tiebreak)
        self._write(self._days(edged), "days")
        values = self._values(edged)
        self._write(values, "values")
        # From what was just written, of these sessions only.
        sessions = edged.select(SESSION).distinct()
        written = self._read(bars.sparkSession, "values", values.schema).join(sessions, SESSION, "left_semi")
        self._write(self._moments(written), "moments")

    def _write(self, df: DataFrame, name: str) -> None:
        (
            df.hint("rebalance", SESSION)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SESSION)
            .parquet(self._table(name))
        )

    def _read(self, spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self._table(name))

    def _days(self, edged: DataFrame) -> DataFrame:
        known, edge = "nullif(close, double('NaN'))", f"{_BEFORE} IS NULL"
        ends = ", ".join(map(quoted, (self.ts, *self.tiebreak)))
        return edged.groupBy(*self._by_session).agg(
            *[
                F.expr(sql)
                for sql in (
                    "count(1) AS n_bars",
                    f"min({quoted(self.ts)}) AS first_bar",
                    f"max({quoted(self.ts)}) AS last_bar",
                    "min(nullif(low, double('NaN'))) AS low",
                    "max(nullif(high, double('NaN'))) AS high",
                    "sum(volume) AS total_volume",
                    "count(volume) AS n_volumes",
                    f"count_if(gap_seconds > {step_seconds(self.timeframe) * GAP_FACTOR}) AS gap_count",
                    # Bars up to the first known close, whose returns depend on earlier sessions.
                    f"count_if({edge} AND {known} IS NULL) AS n_before_close",
                    f"max(CASE WHEN {edge} THEN {known} END) AS first_close",
                    f"max_by({known}, CASE WHEN {known} IS NOT NULL THEN struct({ends}) END) AS last_close",
                )
            ]
        )

    def _values(self, edged: DataFrame) -> DataFrame:
        by = [*self.keys, SESSION]
        cells = unpivoted(edged, list(self.columns), keys=by)
        inside = edged.where(f"{_BEFORE} IS NOT NULL")
        cells = cells.unionByName(unpivoted(inside, [RETURNS], keys=by))
        cells = cells.withColumn("value", F.expr("nullif(value, double('NaN'))"))
        return cells.groupBy(*self._by_session, "column_name", "value").agg(F.count(F.lit(1)).alias("copies"))

    def _moments(self, values: DataFrame) -> DataFrame:
        by = [*self._by_session, "column_name"]
        known = "CASE WHEN value IS NOT NULL THEN copies ELSE 0 END"
        over = f"OVER (PARTITION BY {', '.join(by)})"
        centred = values.selectExpr("*", f"{known} AS _n", f"try_divide(sum(value * copies) {over}, sum({known}) {over}) AS _mean")
        return centred.groupBy(*by).agg(
            F.expr("sum(_n) AS n"),
            F.expr("sum(copies) - sum(_n) AS null_count"),
            F.expr("max(_mean) AS mean"),
            F.expr("coalesce(sum(copies * (value - _mean) * (value - _mean)), 0.0D) AS spread"),
            F.expr("min(value) AS `min`"),
            F.expr("max(value) AS `max`"),
        )

    # --- reading -------------------------------------------------------------

    def _range(self, spark: SparkSession, name: str, start: date | None, end: date | None) -> DataFrame:
        rows = self._read(spark, name)
        if start is not None:
            rows = rows.where(F.col(SESSION) >= F.lit(start))
        if end is not None:
            rows = rows.where(F.col(SESSION) < F.lit(end))
        return wrapped_keys(rows, self.keys)

    def _between_sessions(self, days: DataFrame) -> DataFrame:
        """Returns of bars up to the first close of their session: ``value, copies``."""
        earlier = Window.partitionBy(*self._keys).orderBy(SESSION).rowsBetween(Window.unboundedPreceding, -1)
        return days.withColumn("_last", F.last("last_close", ignorenulls=True).over(earlier)).selectExpr(
            *map(quoted, self.keys),
            "inline(array("
            "struct(try_divide(_last, _last) - 1.0D AS value, n_before_close AS copies),"
            "struct(try_divide(first_close, _last) - 1.0D AS value, IF(first_close IS NULL, 0L, 1L) AS copies)))",
            f"'{RETURNS}' AS column_name",
        ).where("copies > 0")

    @property
    def _keys(self) -> list[Column]:
        return [F.col(quoted(k)) for k in self.keys]

    def _merged_moments(self, spark: SparkSession, start: date | None, end: date | None, *, only: str | None = None) -> DataFrame:
        """Moments over the range, keys wrapped."""
        by = [*map(quoted, self.keys), "column_name"]
        parts = self._range(spark, "moments", start, end).drop(SESSION)
        edges = self._between_sessions(self._range(spark, "days", start, end)).selectExpr(
            *by,
            "IF(value IS NULL, 0L, copies) AS n",
            "IF(value IS NULL, copies, 0L) AS null_count",
            "value AS mean",
            "0.0D AS spread",
            "value AS `min`",
            "value AS `max`",
        )
        parts = parts.unionByName(edges)
        if only is not None:
            parts = parts.where(F.col("column_name") == only)
        over = f"OVER (PARTITION BY {', '.join(by)})"
        centred = parts.selectExpr("*", f"try_divide(sum(mean * n) {over}, sum(n) {over}) AS _mean")
        return centred.groupBy(*by).agg(
            F.expr("sum(n) AS n"),
            F.expr("sum(null_count) AS null_count"),
            F.expr("max(_mean) AS mean"),
            F.expr("sqrt(try_divide(sum(spread + coalesce(n * (mean - _mean) * (mean - _mean), 0.0D)), sum(n) - 1.0D)) AS _std"),
            F.expr("min(`min`) AS `min`"),
            F.expr("max(`max`) AS `max`"),
        ).withColumn("std", F.expr("CASE WHEN n > 1 THEN _std END")).drop("_std")

    def describe(self, spark: SparkSession, start: date | None = None, end: date | None = None) -> DataFrame:
        """``stats.describe`` of the columns and of returns, over the sessions from ``start`` up to ``end`` (not included)."""
        by = [*self.keys, "column_name"]
        moments = self._merged_moments(spark, start, end)
        values = self._range(spark, "values", start, end).select(*self._keys, "column_name", "value", "copies")
        edges = self._between_sessions(self._range(spark, "days", start, end))
        quartiles = wrapped_quantiles(values.unionByName(edges), DESCRIBE_QUANTILES, keys=by, value="value", copies="copies")
        order = [*self.keys, "column_name", "n", "null_count", "mean", "std", "min", *DESCRIBE_QUANTILES, "max"]
        return unwrapped_keys(moments.join(quartiles, by, "left"), self.keys).select(*map(quoted, order))

    def _merged_days(self, spark: SparkSession, start: date | None, end: date | None) -> DataFrame:
        days = self._range(spark, "days", start, end)
        return days.groupBy(*self._keys).agg(
            F.sum("n_bars").alias("n_bars"),
            F.min("first_bar").alias("first_bar"),
            F.max("last_bar").alias("last_bar"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.coalesce(F.sum("total_volume"), F.lit(0)).alias("total_volume"),
            F.try_divide(F.sum("total_volume"), F.sum("n_volumes")).alias("mean_volume"),
            F.sum("gap_count").alias("gap_count"),
        )

    def bar_stats(self, spark: SparkSession, start: date | None = None, end: date | None = None) -> DataFrame:
        """``stats.bar_stats`` over the sessions of the range."""
        return unwrapped_keys(self._merged_days(spark, start, end).drop("gap_count"), self.keys)

    def completeness(self, spark: SparkSession, start: date | None = None, end: date | None = None) -> DataFrame:
        """``quality.completeness`` over the sessions of the range."""
        share = (F.col("n_bars") - F.col("gap_count")) / F.col("n_bars") * F.lit(100.0)
        return unwrapped_keys(self._merged_days(spark, start, end), self.keys).select(
            *self._keys, "n_bars", "gap_count", share.alias("percent_complete")
        )

    def risk(
        self, spark: SparkSession, start: date | None = None, end: date | None = None, *, bars_per_year: int = BARS_PER_YEAR
    ) -> DataFrame:
        """``stats.risk_metrics`` over the sessions of the range."""
        moved = self._merged_moments(spark, start, end, only=RETURNS).select(
            *self._keys,
            F.col("n").alias("n_returns"),
            F.col("std").alias("bar_volatility"),
            (F.col("std") * F.lit(sqrt(bars_per_year))).alias("annualized_volatility"),
        )
        lowest = self._merged_days(spark, start, end).select(
            *self._keys, (F.try_divide("low", "high") - F.lit(1.0)).alias("range_drawdown")
        )
        return unwrapped_keys(moved.join(lowest, list(self.keys)), self.keys)

    def dashboard(
        self, metrics: SessionSummaries, spark: SparkSession, start: date | None = None, end: date | None = None
    ) -> DataFrame:
        """``stats.quick_stats`` over the range; ``metrics`` are summaries with columns vwap and rsi.

        VWAP and RSI are means over the range of what the whole series gave.
        """
        if not {"vwap", "rsi"} <= set(metrics.columns):
            raise ValueError("summaries of vwap and rsi are needed")
        size = self._merged_days(spark, start, end).select(*self._keys, "n_bars", "low", "high", "total_volume")
        moved = self._merged_moments(spark, start, end, only=RETURNS).select(
            *self._keys, (F.col("std") * F.lit(100.0)).alias("volatility_pct")
        )
        means = metrics._merged_moments(spark, start, end).groupBy(*self._keys).agg(
            *[F.max(F.when(F.col("column_name") == c, F.col("mean"))).alias(f"mean_{c}") for c in ("vwap", "rsi")]
        )
        by = list(self.keys)
        return unwrapped_keys(size.join(moved, by, "left").join(means, by, "left"), self.keys)
