"""Runs published as a whole: readers see all tables of a run, or those of the run before.

A run writes its tables into a folder of its own.  Only when all of them are there is its
manifest put in place, by one rename that fails if another run took the number first.  What
was counted while the tables were written (rows, missing times and prices, broken rules)
stands in the manifest, so that no table is read again for it.

    runs/<id>/<table>        the tables of a run, published or not
    manifests/<number>       what a published run consists of
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from barloom.functions.bar_columns import bar_rules
from barloom.schema import OHLCV, PRICES, TIMESTAMP, quoted

_FORMATS = ("parquet", "json", "csv")
_COUNTS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("check", T.StringType()), T.StructField("n", T.LongType())])


class RunConflictError(RuntimeError):
    """Another run was published while this one was written."""


def counted(df: DataFrame, ts: str = TIMESTAMP) -> dict[str, Column]:
    """What is counted of a table while it is written: rows, and of bars what is missing or wrong."""
    found = {"rows": F.count(F.lit(1))}
    if ts in df.columns:
        found["no_time"] = F.count_if(F.col(quoted(ts)).isNull())
    if set(OHLCV) <= set(df.columns):
        found["no_price"] = F.count_if(F.greatest(*[F.col(p).isNull().cast("int") for p in PRICES]) == 1)
        found |= {f"not_{name}": F.count_if(~rule) for name, rule in bar_rules().items()}
    return found


@dataclass(frozen=True)
class PublishedRuns:
    """The runs under a folder that all executors share."""

    path: str

    # --- files ---------------------------------------------------------------

    def _file(self, spark: SparkSession, part: str):
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{part}")
        return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the published runs, oldest first."""
        folder, files = self._file(spark, "manifests")
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _commit(self, spark: SparkSession, number: int, manifest: dict) -> None:
        """Put the manifest in place in one step, or fail."""
        staged = f"manifests/.{uuid.uuid4().hex}"
        rows = spark.createDataFrame([(json.dumps(manifest),)], "value string")
        rows.coalesce(1).write.text(f"{self.path.rstrip('/')}/{staged}")
        source, files = self._file(spark, staged)
        target, _ = self._file(spark, f"manifests/{number}")
        jvm = spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        plain = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(source), files.makeQualified(target), plain)
        except Exception as error:
            files.delete(source, True)
            raise RunConflictError(f"run {number} of {self.path} was published meanwhile") from error

    def _manifest(self, spark: SparkSession, version: int | None) -> dict:
        numbers = self.versions(spark)
        if version is None and numbers:
            version = numbers[-1]
        if version not in numbers:
            raise ValueError(f"{self.path} has no published run {'' if version is None else version}".rstrip())
        return json.loads(spark.read.text(f"{self.path.rstrip('/')}/manifests/{version}").first()[0])

    # --- writing -------------------------------------------------------------

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        *,
        formats: Mapping[str, str] | None = None,
        counts: Sequence[tuple[str, str, int]] = (),
        folder: str | None = None,
    ) -> int:
        """Write all tables and publish them as one run; returns its number.

        ``formats`` names tables that are not to be Parquet (``csv`` with a header, or
        ``json``).  If a table fails, nothing is published and what was written goes; a
        driver that is lost leaves a folder that :meth:`clear` removes.
        """
        if not tables:
            raise ValueError("a run needs tables")
        wanted = {name: (formats or {}).get(name, "parquet") for name in tables}
        unknown = sorted({*wanted.values()} - {*_FORMATS})
        if unknown:
            raise ValueError(f"formats are {_FORMATS}, got {unknown}")
        spark = next(iter(tables.values())).sparkSession
        number = max(self.versions(spark), default=-1) + 1
        folder = folder or f"runs/{uuid.uuid4().hex}"
        entries, found = {}, [list(c) for c in counts]
        try:
            for name, df in tables.items():
                seen = Observation()
                checks = [c.alias(n) for n, c in counted(df).items()]
                target = f"{self.path.rstrip('/')}/{folder}/{name}"
                writer = df.observe(seen, *checks).write.mode("overwrite").format(wanted[name])
                (writer.option("header", True) if wanted[name] == "csv" else writer).save(target)
                entries[name] = {"format": wanted[name], "path": f"{folder}/{name}", "schema": df.schema.json()}
                found += [[name, check, int(n)] for check, n in seen.get.items()]
            self._commit(spark, number, {"tables": entries, "counts": found, "folder": folder})
        except Exception:
            target, files = self._file(spark, folder)
            files.delete(target, True)
            raise
        return number

    def clear(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Remove folders of runs that are not among the last ``keep`` published, and their manifests.

        Not to be called while a run is written or an old one is read.
        """
        if keep < 1:
            raise ValueError("the last run stays")
        numbers = self.versions(spark)
        held = {self._manifest(spark, n)["folder"] for n in numbers[-keep:]}
        for n in numbers[:-keep]:
            target, files = self._file(spark, f"manifests/{n}")
            files.delete(target, True)
        folder, files = self._file(spark, "runs")
        gone = []
        for status in files.listStatus(folder) if files.exists(folder) else []:
            name = f"runs/{status.getPath().getName()}"
            if name not in held:
                files.delete(status.getPath(), True)
                gone.append(name)
        return gone

    # --- reading -------------------------------------------------------------

    def tables(self, spark: SparkSession, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of a run, the last one if no version is named, with the types they were written with."""
        out = {}
        for name, entry in self._manifest(spark, version)["tables"].items():
            schema = T.StructType.fromJson(json.loads(entry["schema"]))
            reader = spark.read.schema(schema)
            if entry["format"] == "csv":
                reader = reader.options(header=True, enforceSchema=False, mode="FAILFAST")
            out[name] = reader.format(entry["format"]).load(f"{self.path.rstrip('/')}/{entry['path']}")
        return out

    def counts(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """What was counted while the tables were written: ``table_name, check, n``."""
        return spark.createDataFrame([tuple(c) for c in self._manifest(spark, version)["counts"]], _COUNTS)
