"""Reading tables into the tick and bar shapes the operators expect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom.schema import BAR_SCHEMA, OHLCV, SYMBOL, TIMESTAMP, conform


def as_ticks(
    df: DataFrame,
    *,
    symbol: Column | str,
    timestamp: Column | str,
    price: Column | str,
    volume: Column | str | None = None,
    tiebreak: Mapping[str, Column | str] | Sequence[str] = (),
    start: str | datetime | None = None,
    end: str | datetime | None = None,
) -> DataFrame:
    """View a table of single prices as one-price bars, ready to roll up.

    Open, high, low and close are all the price; without a volume every tick
    counts one.  Tie-breaking columns are kept under the given names.  ``start``
    (inclusive) and ``end`` (exclusive) bound the raw timestamp column, so a
    scan skips files and row groups outside.
    """
    if start is not None or end is not None:
        if not isinstance(timestamp, str):
            raise ValueError("a range needs the name of a timestamp column")
        df = in_range(df, timestamp, start, end)

    def column(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    ties = tiebreak if isinstance(tiebreak, Mapping) else {c: c for c in tiebreak}
    cost = column(price).cast("double")
    return df.select(
        column(symbol).alias(SYMBOL),
        column(timestamp).cast("timestamp_ntz").alias(TIMESTAMP),
        *[cost.alias(c) for c in OHLCV[:4]],
        (F.lit(1) if volume is None else column(volume)).cast("bigint").alias("volume"),
        # An alias to the same name would keep Spark from reusing this scan's exchange.
        *[F.col(name) if isinstance(c, str) and c == name else column(c).alias(name) for name, c in ties.items()],
    )


def read_bars(
    spark: SparkSession,
    *paths: str,
    fmt: str = "parquet",
    partitions: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Bars from one or many paths, with the declared types.

    Several paths form a bag union, e.g. one directory per day.  CSV and JSON
    are read with the declared types, so nothing is inferred; ``partitions``
    declares columns held in directory names.  CSV columns are matched by the
    header of each path, and a line that does not fit its types fails the read.
    """
    held = {f.name: f.dataType for f in BAR_SCHEMA.fields} | dict(partitions or {})
    if fmt == "csv":
        parts = []
        for path in paths:
            header = spark.read.option("header", True).csv(path).columns
            missing = [f.name for f in BAR_SCHEMA.fields if f.name not in header]
            if missing:
                raise ValueError(f"{path} has no columns {missing}")
            schema = T.StructType([T.StructField(c, held.get(c, T.StringType())) for c in header])
            reader = spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST")
            parts.append(reader.csv(path).select(*held))
        return conform(reduce(DataFrame.unionByName, parts))
    reader = spark.read
    if fmt == "json":
        schema = T.StructType([T.StructField(n, t) for n, t in held.items()])
        reader = reader.schema(schema).option("mode", "FAILFAST")
    return conform(reader.format(fmt).load(list(paths)))


def in_range(
    df: DataFrame, ts: str, start: str | datetime | None, end: str | datetime | None
) -> DataFrame:
    """Rows from ``start`` on and before ``end``, compared in the type of the column."""
    kind = df.schema[ts].dataType
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(ts) < F.lit(end).cast(kind))
    return df
