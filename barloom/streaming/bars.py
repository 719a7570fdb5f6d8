"""Bars from a stream of tick files, with bounded state.

Event time is the naive timestamp read as UTC, because watermarks need a
time-zone type; the result is naive again.  State holds one row per symbol and
open window and is dropped when the watermark passes.  Partial aggregation runs
before the state shuffle, so a hot symbol costs one row per window and task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.functions.timegrid import epoch_micros_sql, naive_utc, step_seconds
from barloom.operators.rollup import bucket_aggregates, drop_null_bars, order_key, roll_up
from barloom.schema import KEYS, OHLCV, TIMESTAMP, require_columns
from barloom.sources.ticks import in_range

_EVENT_TIME = "_event_time"


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session of the same application for streams with this many state partitions.

    The number stays with a stream's checkpoint for good, so it has to be chosen for the
    largest cluster the stream will run on.  The session keeps the progress of many
    batches, for :func:`late_rows` to count.
    """
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    child.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    return child


def read_file_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    *,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a directory as a stream; new files are new data."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def stream_bars(
    ticks: DataFrame,
    timeframe: str,
    *,
    lateness: str = "10 minutes",
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
    tick_key: Sequence[str] = (),
) -> DataFrame:
    """Tumbling bars of a tick stream; a bar comes out when its window is closed.

    ``tick_key`` names the columns that tell ticks apart: a tick that repeats one counts
    once.  State then also holds the keys of the last ``lateness``; what comes later than
    that is late, repeated or not (:mod:`barloom.streaming.corrections` has no such limit).
    """
    require_columns(ticks, [*keys, ts, *OHLCV, *tiebreak, *tick_key])
    timed = ticks.select(
        *keys,
        *OHLCV,
        *[F.col(c).alias(f"_key_{i}") for i, c in enumerate(tick_key)],
        F.expr(f"{order_key(ticks, ts, tiebreak)} AS _order"),
        F.expr(f"timestamp_micros({epoch_micros_sql(ts)}) AS {_EVENT_TIME}"),
    ).withWatermark(_EVENT_TIME, lateness)
    if tick_key:
        timed = timed.dropDuplicatesWithinWatermark([f"_key_{i}" for i in range(len(tick_key))])
    bars = timed.groupBy(
        *keys, F.window(_EVENT_TIME, f"{step_seconds(timeframe)} seconds").alias("_window")
    ).agg(*bucket_aggregates("_order"))
    start = naive_utc("_window.start")
    return drop_null_bars(bars.select(*keys, start.alias(ts), *OHLCV))


class LateRowsError(RuntimeError):
    """Rows came after the watermark had passed their window and were left out."""


class ProgressLostError(RuntimeError):
    """More batches ran than the session keeps the progress of, so late rows cannot be counted."""


def late_rows(query: StreamingQuery) -> int:
    """How many (partly aggregated) rows the watermark dropped in this run of a stream.

    Raises :class:`ProgressLostError` where the session may have forgotten batches of the run.
    """
    progress = query.recentProgress
    kept = getattr(query, "_kept", None)  # set by the functions below
    if kept is None:
        kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(progress) >= kept - 1:  # Spark forgets the oldest as soon as there are so many
        raise ProgressLostError(
            f"the session keeps the progress of {kept} batches; read the stream in a stream_session, "
            "or give it fewer files at a time"
        )
    return sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])


def watermark_of(query: StreamingQuery, checkpoint: str | None = None) -> datetime | None:
    """The time up to which windows are closed, naive in UTC; None before any data.

    A run that found no new file shows no watermark; ``checkpoint`` names the folder that
    remembers it.
    """
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    if marks:
        return datetime.fromisoformat(max(marks).replace("Z", "+00:00")).replace(tzinfo=None)
    if checkpoint is None:
        raise ValueError("the run read no data; name the checkpoint of the stream")
    return stored_watermark(SparkSession.active(), checkpoint)


def stored_watermark(spark: SparkSession, checkpoint: str) -> datetime | None:
    """The watermark of the last batch of a checkpoint, naive in UTC; None before any data."""
    logs = spark.read.option("wholetext", True).text(f"{checkpoint.rstrip('/')}/offsets")
    stamp = F.regexp_extract("value", '"batchWatermarkMs":([0-9]+)', 1)
    last = logs.select(F.max(stamp.try_cast("bigint"))).first()[0]
    return datetime(1970, 1, 1) + timedelta(milliseconds=last) if last else None


def _finish(query: StreamingQuery, session: SparkSession, allow_late: bool) -> StreamingQuery:
    query.awaitTermination()
    query._kept = int(session.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if allow_late:
        return query
    dropped = late_rows(query)
    if dropped:
        raise LateRowsError(
            f"{dropped} rows came later than the watermark allows and are in no bar; "
            "allow more lateness, or roll the files up in a batch"
        )
    return query


def write_available(
    bars: DataFrame, path: str, checkpoint: str, *, allow_late: bool = False
) -> StreamingQuery:
    """Process all files that are there, append closed bars to ``path``, and stop.

    A later call with the same checkpoint continues where this one ended.  Rows that
    came too late raise :class:`LateRowsError`, after all bars were written, unless
    ``allow_late``; :func:`late_rows` counts them.
    """
    query = (
        bars.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query, bars.sparkSession, allow_late)


def open_bars(
    ticks: DataFrame,
    timeframe: str,
    watermark: datetime | None,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The bars that a stream had not closed when its data ended, from the same ticks in a batch.

    They end after the ``watermark`` (:func:`watermark_of`), so only the ticks of the last
    windows are read.  After they are added to its bars the stream is complete and must
    not be continued.
    """
    if watermark is not None:
        step = timedelta(seconds=step_seconds(timeframe))
        ticks = in_range(ticks, ts, watermark - step, None)
    bars = roll_up(ticks, timeframe, keys=keys, ts=ts, tiebreak=tiebreak)
    if watermark is None:
        return bars
    return bars.where(F.col(ts) > F.lit(watermark - step).cast("timestamp_ntz"))


def write_batches(
    bars: DataFrame,
    handle,
    checkpoint: str,
    *,
    allow_late: bool = False,
) -> StreamingQuery:
    """Give each batch of newly closed bars to ``handle(frame, batch_id)`` and stop.

    Row-count windows are not allowed on a stream; a handler may compute them
    over a stored table, or per closed session.  Late rows are treated as in
    :func:`write_available`.
    """
    query = (
        bars.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .trigger(availableNow=True)
        .start()
    )
    return _finish(query, bars.sparkSession, allow_late)
