"""Bars that late and repeated ticks correct.

A watermark closes a bar for good.  Here bars stay open to correction: ticks go to a log,
every batch finds the buckets its new ticks fall into, rolls only those up again from the
log, and rewrites only the sessions that hold them.  A tick that was there before, by its
key, changes nothing, however late it is repeated.

    ticks/batch=N/session=D     the new ticks of batch N
    bars/session=D              the bars as they stand, each with the batch that last changed it
    replaced/batch=N            bars as they were before batch N changed them
    rejected/batch=N            rows that cannot be placed: no time

A batch writes its own folders, or whole sessions, and only from what earlier batches and
itself have logged: repeated after a lost driver it leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.functions.timegrid import bucket_start, session_of
from barloom.operators.rollup import bucket_aggregates, drop_null_bars, order_key
from barloom.schema import KEYS, OHLCV, SESSION, TIMESTAMP, quoted, require_columns

REVISION = "revision"
_BUCKET = "_bucket"


class CorrectedBars:
    """Bars of one timeframe in a folder, kept right by batches of ticks in any order."""

    def __init__(
        self,
        path: str,
        timeframe: str,
        tick_key: Sequence[str],
        *,
        keys: Sequence[str] = KEYS,
        ts: str = TIMESTAMP,
        tiebreak: Sequence[str] = (),
    ):
        """``tick_key`` names the columns that tell ticks apart; of ticks that agree in them the first to come counts."""
        if not tick_key:
            raise ValueError("ticks need a key to be told apart")
        self.path = path.rstrip("/")
        self.timeframe = timeframe
        self.keys, self.ts, self.tiebreak = tuple(keys), ts, tuple(tiebreak)
        self.tick_key = tuple(tick_key)

    # --- the log -------------------------------------------------------------

    def _exists(self, spark: SparkSession, part: str, whole: bool = True) -> bool:
        """Whether a folder is there, and written to its end."""
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(files.exists(jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS") if whole else target))

    def _log(self, spark: SparkSession, schema: T.StructType, before: int) -> DataFrame:
        """Ticks of the batches before a number, with their session."""
        fields = [f for f in schema.fields if f.name != SESSION]
        named = [T.StructField("batch", T.LongType()), T.StructField(SESSION, T.DateType())]
        log = spark.read.schema(T.StructType([*fields, *named])).parquet(f"{self.path}/ticks")
        return log.where(F.col("batch") < before)

    def _unlike(self, ticks: DataFrame) -> DataFrame:
        """One tick of each key: the least of those that share one."""
        rest = [c for c in ticks.columns if c not in self.tick_key]
        if not rest:
            return ticks.distinct()
        one = ticks.groupBy(*[quoted(c) for c in self.tick_key]).agg(F.min(F.struct(*[quoted(c) for c in rest])).alias("_rest"))
        return one.select(*[quoted(c) for c in self.tick_key], *[F.col(f"_rest.{quoted(c)}").alias(c) for c in rest]).select(
            *[quoted(c) for c in ticks.columns]
        )

    def apply(self, ticks: DataFrame, batch: int) -> None:
        """Take up a batch of ticks.  Batches count from 0; the last one may be repeated."""
        require_columns(ticks, [*self.keys, self.ts, *OHLCV, *self.tiebreak, *self.tick_key])
        spark = ticks.sparkSession
        columns = [c for c in ticks.columns if c not in (SESSION, "batch")]
        ticks = ticks.select(*[quoted(c) for c in columns])
        placed = ticks.where(F.col(self.ts).isNotNull())
        ticks.where(F.col(self.ts).isNull()).write.mode("overwrite").parquet(f"{self.path}/rejected/batch={batch}")
        # As many sessions as there are days: what bounds every read below.
        days = [r[0] for r in placed.select(session_of(self.ts)).distinct().collect()]

        new = self._unlike(placed).withColumn(SESSION, session_of(self.ts))
        if batch and days:
            earlier = self._log(spark, ticks.schema, batch).where(F.col(SESSION).isin(days))
            new = new.join(earlier.select(*self.tick_key, SESSION), _same(new, earlier, [*self.tick_key, SESSION]), "left_anti")
        staged = f"{self.path}/ticks/batch={batch}"
        new.hint("rebalance", SESSION).write.mode("overwrite").partitionBy(SESSION).parquet(staged)
        if days:
            self._revise(spark, ticks.schema, batch, days)

    def _revise(self, spark: SparkSession, schema: T.StructType, batch: int, days: list) -> None:
        log = self._log(spark, schema, batch + 1).where(F.col(SESSION).isin(days))
        log = log.withColumn(_BUCKET, bucket_start(self.ts, self.timeframe))
        touched = log.where(F.col("batch") == batch).select(*self.keys, _BUCKET).distinct()
        again = log.join(touched, _same(log, touched, [*self.keys, _BUCKET]), "left_semi")
        order = order_key(log, self.ts, self.tiebreak)
        # Bars without a price stay in the store, or a session could not lose its last bar.
        bars = again.groupBy(*self.keys, _BUCKET).agg(*bucket_aggregates(order))
        bars = bars.select(*self.keys, F.col(_BUCKET).alias(self.ts), *OHLCV, F.lit(batch).cast("long").alias(REVISION))
        bars = bars.withColumn(SESSION, session_of(self.ts))
        if not self._exists(spark, "bars", whole=False):
            self._write(bars)
            return
        now = self._stored(spark, bars.schema).where(F.col(SESSION).isin(days))
        touched = touched.withColumnRenamed(_BUCKET, self.ts)
        match = _same(now, touched, [*self.keys, self.ts])
        if not self._exists(spark, f"replaced/batch={batch}"):
            old = now.join(touched, match, "left_semi").where(F.col(REVISION) < batch)
            old.drop(SESSION).write.mode("overwrite").parquet(f"{self.path}/replaced/batch={batch}")
        self._write(now.join(touched, match, "left_anti").unionByName(bars))

    def _write(self, bars: DataFrame) -> None:
        """Sessions of the bars, in place of those that are there; the others stay."""
        writer = bars.hint("rebalance", SESSION).write.mode("overwrite").partitionBy(SESSION)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/bars")

    def _stored(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        fields = [f for f in schema.fields if f.name != SESSION]
        stored = spark.read.schema(T.StructType([*fields, T.StructField(SESSION, T.DateType())])).parquet(f"{self.path}/bars")
        return stored.select(*schema.names)

    # --- what stands ---------------------------------------------------------

    def bars(self, spark: SparkSession) -> DataFrame:
        """All bars as they stand, with ``revision``."""
        return drop_null_bars(spark.read.parquet(f"{self.path}/bars").drop(SESSION))

    def replaced(self, spark: SparkSession) -> DataFrame:
        """Bars as they were, with the revision they had and the ``batch`` that replaced them."""
        return drop_null_bars(spark.read.parquet(f"{self.path}/replaced"))

    def as_of(self, spark: SparkSession, batch: int) -> DataFrame:
        """The bars as they stood after a batch."""
        parts = [self.bars(spark)]
        if self._exists(spark, "replaced", whole=False):
            parts.append(self.replaced(spark).where(F.col("batch") > batch).drop("batch"))
        both = reduce(DataFrame.unionByName, parts).where(F.col(REVISION) <= batch)
        names = [c for c in both.columns if c not in (*self.keys, self.ts)]
        newest = both.groupBy(*self.keys, self.ts).agg(*[F.max_by(c, REVISION).alias(c) for c in names])
        return newest.select(*both.columns)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Rows without a time, with their ``batch``."""
        return spark.read.parquet(f"{self.path}/rejected")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Rows agree in the columns, nulls with nulls."""
    return reduce(lambda a, b: a & b, [left[quoted(n)].eqNullSafe(right[quoted(n)]) for n in names])


def correct_available(ticks: DataFrame, store: CorrectedBars, checkpoint: str) -> StreamingQuery:
    """Take up all files that a stream of ticks finds, and stop.

    There is no watermark, so no row is too late, and no state: what a batch needs of the
    past is in the log.  A later call with the same checkpoint continues.
    """
    query = (
        ticks.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda frame, number: store.apply(frame, number))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
