"""Bars stored the way windows want them, so that reading needs no shuffle.

A window over a series works on blocks of days (:mod:`barloom.operators.series`).  What it
shuffles for, the bars of a block, the rows before it and the totals so far, does not change
once bars are final.  Here all of that is written once, as a table bucketed by series and
block.  Indicators over the table are a scan and a sort in each bucket; a range of days reads
only its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.operators.indicators import Indicator, standard_set
from barloom.operators.series import BLOCK_COLUMN, BLOCK_DAYS, DEFAULT_BLOCK_DAYS, in_lockstep, over_context, with_context
from barloom.schema import KEYS, TIMESTAMP, quoted

_PROPERTY = "barloom."
_EPOCH = date(1970, 1, 1)


def store_series(
    bars: DataFrame,
    name: str,
    path: str,
    indicators: Sequence[Indicator],
    *,
    buckets: int,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
    block_days: int = DEFAULT_BLOCK_DAYS,
) -> None:
    """Write bars as the table ``name`` under ``path``, ready for these indicators or lesser ones.

    ``buckets`` is fixed with the table: choose it so that a bucket of the whole history fits
    a task.  Blocks of one series fall into different buckets, so a large series is spread.
    """
    if buckets < 1:
        raise ValueError(f"buckets must be at least 1, got {buckets}")
    lookback = max((i.lookback for i in indicators), default=0)
    carry = {c: how for i in indicators for c, how in i.carry.items()}
    rows = with_context(bars, keys=keys, ts=ts, lookback=lookback, carry=carry, block_days=block_days, tiebreak=tiebreak)
    by = [*keys, BLOCK_COLUMN]
    (
        # The same hash as that of the buckets: one file each.
        rows.repartition(buckets, *[F.col(quoted(c)) for c in by])
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .saveAsTable(name)
    )
    known = {
        "lookback": lookback,
        "carry": ",".join(sorted(carry)),
        "columns": ",".join(bars.columns),
        "keys": ",".join(keys),
        "ts": ts,
        "tiebreak": ",".join(tiebreak),
        "block_days": block_days,
    }
    listed = ", ".join(f"'{_PROPERTY}{k}' = '{v}'" for k, v in known.items())
    bars.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    found = {r.key.removeprefix(_PROPERTY): r.value for r in rows if r.key.startswith(_PROPERTY)}
    if not found:
        raise ValueError(f"{name} was not written by store_series")
    return found


def indicators_of(
    spark: SparkSession,
    name: str,
    indicators: Sequence[Indicator],
    *,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """The bars of a stored series with the columns of the indicators.

    ``start`` and ``end`` (not included) bound the days.  Results are those over the whole
    series, whatever the range.
    """
    known = _properties(spark, name)
    needed = max((i.lookback for i in indicators), default=0)
    if needed > int(known["lookback"]):
        raise ValueError(f"{name} holds {known['lookback']} rows before a block, not {needed}")
    missing = {c for i in indicators for c in i.carry} - set(known["carry"].split(","))
    if missing:
        raise ValueError(f"{name} carries no {sorted(missing)}")
    rows = spark.table(name)
    days = int(known["block_days"])
    if start is not None:
        rows = rows.where(F.col(BLOCK_COLUMN) >= (start - _EPOCH).days // days)
    if end is not None:
        rows = rows.where(F.col(BLOCK_COLUMN) <= ((end - _EPOCH).days - 1) // days)
    out = over_context(
        rows,
        lambda w: in_lockstep([i.stages(w) for i in indicators]),
        {c: sql for i in indicators for c, sql in i.outputs.items()},
        known["columns"].split(","),
        keys=known["keys"].split(","),
        ts=known["ts"],
        tiebreak=[c for c in known["tiebreak"].split(",") if c],
    )
    day = F.to_date(quoted(known["ts"]))
    if start is not None:
        out = out.where(day >= F.lit(start))
    return out if end is None else out.where(day < F.lit(end))


def store_standard(bars: DataFrame, name: str, path: str, timeframe: str, *, buckets: int, **options) -> None:
    """:func:`store_series` for the standard indicators of a timeframe."""
    blocks = {"block_days": BLOCK_DAYS.get(timeframe) or DEFAULT_BLOCK_DAYS}
    store_series(bars, name, path, standard_set(timeframe), buckets=buckets, **{**blocks, **options})


def standard_metrics_of(spark: SparkSession, name: str, timeframe: str, **range_of_days) -> DataFrame:
    """The standard indicators of bars stored by :func:`store_standard`."""
    return indicators_of(spark, name, standard_set(timeframe), **range_of_days)
