"""Indicators over a stream of closed bars, batch by batch.

Row-count windows are not allowed on a stream, so each batch is finished in
``foreachBatch``: its bars follow a small stored *tail*, the last few bars of
every symbol with its running totals.  Bars leave the roll-up in time order
(a batch holds the windows its watermark closed), so the tail is all the past
that a window can reach.  Results equal those over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from barloom.operators.indicators import (
    TYPICAL_PRICE,
    WindowSet,
    add_indicators,
    standard_set,
    vwap_of,
)
from barloom.operators.series import DEFAULT_BLOCK_DAYS
from barloom.schema import KEYS, OHLCV, TIMESTAMP

_TOTALS = ("turnover_total", "traded_total")


def add_metrics_after(
    bars: DataFrame,
    tail: DataFrame | None,
    timeframe: str,
    *,
    windows: WindowSet | None = None,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    block_days: int | None = DEFAULT_BLOCK_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """Metrics of new bars that continue a tail, and the tail after them."""
    own = bars.select(*keys, ts, *OHLCV).withColumn("is_new", F.lit(True))
    if tail is None:
        rows = own
        vwap = vwap_of(totals=_TOTALS)
    else:
        # The oldest row of a tail brings all totals up to itself.
        oldest = F.row_number().over(Window.partitionBy(*keys).orderBy(ts)) == 1
        before = tail.withColumn("_oldest", oldest).select(
            *keys,
            ts,
            *OHLCV,
            F.lit(False).alias("is_new"),
            *[F.when(F.col("_oldest"), F.col(t)).alias(f"seed_{t}") for t in _TOTALS],
        )
        rows = own.unionByName(before, allowMissingColumns=True)
        vwap = vwap_of(
            turnover=f"coalesce(seed_{_TOTALS[0]}, {TYPICAL_PRICE} * volume)",
            traded=f"coalesce(seed_{_TOTALS[1]}, volume)",
            totals=_TOTALS,
        )
    indicators = standard_set(timeframe, windows, vwap)
    done = add_indicators(rows, *indicators, keys=keys, ts=ts, block_days=block_days)
    names = [c for i in indicators for c in i.outputs if c not in _TOTALS]
    length = max(max(i.lookback for i in indicators), 1)
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(ts)))
    next_tail = (
        done.withColumn("_age", newest)
        .where(F.col("_age") <= length)
        .select(*keys, ts, *OHLCV, *_TOTALS)
    )
    return done.where("is_new").select(*keys, ts, *OHLCV, *names), next_tail


def metrics_handler(
    store: str, timeframe: str, *, keys: Sequence[str] = KEYS, **options
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that keeps ``metrics`` and ``tail`` tables in ``store``.

    A batch overwrites only its own directories, so a repeated batch, after a
    lost driver or executor, leaves the same rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tail = spark.read.parquet(f"{store}/tail/{batch_id - 1}") if batch_id else None
        # The stored bars are read twice: for the metrics and for the next tail.
        staged = f"{store}/bars/{batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        bars = spark.read.schema(batch.schema).parquet(staged)
        metrics, next_tail = add_metrics_after(bars, tail, timeframe, keys=keys, **options)
        metrics.write.mode("overwrite").parquet(f"{store}/metrics/{batch_id}")
        next_tail.write.mode("overwrite").parquet(f"{store}/tail/{batch_id}")

    return handle


def read_metrics(spark, store: str) -> DataFrame:
    """The metrics of all batches so far."""
    return spark.read.parquet(f"{store}/metrics/*")
