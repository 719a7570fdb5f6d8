"""Writing frames and report tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barloom.functions.timegrid import session_of
from barloom.schema import BAR_SCHEMA, SESSION, TIMEFRAME, TIMESTAMP

_FORMATS = ("csv", "json", "parquet")


def write_frames_csv(frames: Mapping[str, DataFrame], path: str) -> list[str]:
    """One headed CSV directory per timeframe; returns the directories."""
    targets = []
    for name, df in frames.items():
        target = f"{path.rstrip('/')}/{TIMEFRAME}={name}"
        df.write.mode("overwrite").option("header", True).csv(target)
        targets.append(target)
    return targets


def write_long_csv(stacked: DataFrame, path: str) -> None:
    """A long table as headed CSV, one directory per timeframe, in one job."""
    (
        stacked.write.mode("overwrite")
        .option("header", True)
        .partitionBy(TIMEFRAME)
        .csv(path)
    )


def write_bars(
    stacked: DataFrame,
    path: str,
    *,
    ts: str = TIMESTAMP,
    mode: str = "overwrite",
) -> None:
    """A long bar table as Parquet by timeframe and session, for later pruned reads.

    Rows are gathered by directory first, so that a task does not hold a file
    open for every session.  The gathering is a rebalance: adaptive execution splits
    a session that is large over as many files as its size asks for.
    """
    dated = stacked.withColumn(SESSION, session_of(ts))
    (
        dated.hint("rebalance", TIMEFRAME, SESSION)
        .write.mode(mode)
        .partitionBy(TIMEFRAME, SESSION)
        .parquet(path)
    )


def store_frames(frames: Mapping[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Write each frame as Parquet and return the stored ones.

    Cuts the lineage before several tables are made from a frame.
    """
    stored = {}
    for name, df in frames.items():
        target = f"{path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(target)
        stored[name] = df.sparkSession.read.parquet(target)
    return stored


def read_stored_bars(
    spark: SparkSession,
    path: str,
    timeframes: Sequence[str] | None = None,
    *,
    bars: Sequence[T.StructField] | None = None,
) -> DataFrame:
    """Bars written by :func:`write_bars`; naming timeframes prunes directories.

    ``bars`` are the stored columns, if other than those of the bar schema.
    """
    # Directory names such as 1d would be guessed to be numbers.
    named = [T.StructField(TIMEFRAME, T.StringType()), T.StructField(SESSION, T.DateType())]
    fields = list(bars if bars is not None else BAR_SCHEMA.fields)
    stored = spark.read.schema(T.StructType([*fields, *named])).parquet(path)
    return stored if timeframes is None else stored.where(F.col(TIMEFRAME).isin(*timeframes))


def write_reports(tables: Mapping[str, DataFrame], path: str, fmt: str = "json") -> list[str]:
    """Save report tables side by side; each is a directory named after its table."""
    if fmt not in _FORMATS:
        raise ValueError(f"fmt must be one of {_FORMATS}, got {fmt!r}")
    targets = []
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite")
        (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(target)
        targets.append(target)
    return targets


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint directory.

    The session names that directory; only a local session without one falls
    back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "barloom")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system its path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))
