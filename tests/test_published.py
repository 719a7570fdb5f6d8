"""Runs that are published whole or not at all."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barloom.plans import run
from barloom.sources.published import PublishedRuns, RunConflictError
from conftest import minute_rows


@pytest.fixture
def runs(tmp_path):
    return PublishedRuns(str(tmp_path / "published"))


def values(df):
    return sorted(map(tuple, df.collect()))


def test_all_tables_or_those_before(spark, runs, tmp_path):
    one, two = spark.range(3).toDF("a"), spark.range(5).selectExpr("id AS b", "CAST(id AS STRING) AS c")
    assert runs.versions(spark) == []
    with pytest.raises(ValueError):
        runs.tables(spark)
    assert runs.publish({"one": one, "two": two}, formats={"two": "csv"}) == 0
    broken = spark.range(5).select(F.expr("IF(id = 4, raise_error('lost'), id) AS a").cast("long").alias("a"))
    with pytest.raises(Exception, match="lost"):
        runs.publish({"two": two.limit(1), "one": broken})
    found = runs.tables(spark)
    assert values(found["one"]) == [(0,), (1,), (2,)] and found["two"].dtypes == two.dtypes
    assert values(found["two"]) == [(i, str(i)) for i in range(5)]
    assert len(list((tmp_path / "published" / "runs").iterdir())) == 1  # the broken one took its tables back
    assert runs.publish({"one": one.limit(1)}) == 1
    assert values(runs.tables(spark)["one"]) == [(0,)] and len(values(runs.tables(spark, 0)["one"])) == 3


def test_a_driver_lost_between_tables(spark, runs, tmp_path, monkeypatch):
    runs.publish({"one": spark.range(2)})

    class Lost(BaseException):
        pass

    def lost(*_):
        raise Lost

    monkeypatch.setattr(PublishedRuns, "_commit", lost)
    with pytest.raises(Lost):
        runs.publish({"one": spark.range(9)})
    monkeypatch.undo()
    assert runs.tables(spark)["one"].count() == 2 and runs.versions(spark) == [0]
    assert len(runs.clear(spark)) == 1
    assert runs.tables(spark)["one"].count() == 2


def test_two_writers(spark, runs, monkeypatch):
    runs.publish({"one": spark.range(1)})
    monkeypatch.setattr(PublishedRuns, "versions", lambda self, spark: [])  # looked before the other had published
    with pytest.raises(RunConflictError):
        runs.publish({"one": spark.range(2)})
    monkeypatch.undo()
    assert runs.tables(spark)["one"].count() == 1


def test_clear_keeps_the_last(spark, runs):
    for i in range(3):
        runs.publish({"one": spark.range(i + 1)})
    assert len(runs.clear(spark, keep=2)) == 1 and runs.versions(spark) == [1, 2]
    assert runs.tables(spark, 1)["one"].count() == 2
    with pytest.raises(ValueError):
        runs.clear(spark, keep=0)


def test_counts_come_with_the_write(spark, runs, make_bars):
    rows = minute_rows(minutes=40)
    rows += [(*rows[0][:2], 5.0, 1.0, 2.0, 5.0, 1), (*rows[0][:2], None, 1.0, 1.0, 1.0, 1), ("A", None, 1.0, 1.0, 1.0, 1.0, 1)]
    random.Random(2).shuffle(rows)
    runs.publish({"bars": make_bars(rows)})
    found = {r.check: r.n for r in runs.counts(spark).where("table_name = 'bars'").collect()}
    assert found["rows"] == 43 and found["no_time"] == 1 and found["no_price"] == 1
    assert found["not_high_ge_open"] == 1 and found["not_open_positive"] == 0


def test_a_whole_run(spark, runs, make_bars):
    rows = [r for s in "AB" for r in minute_rows(s, minutes=70)]
    source = make_bars([*rows, ("A", None, 1.0, 1.0, 1.0, 1.0, 1)])
    assert run.publish_bars(source, runs, csv=True, block_days=7) == 0
    plain = run.run_bars(make_bars(rows), block_days=7)
    tables = runs.tables(spark)
    groups = {"frame": plain.frames, "check": plain.checks, "report": plain.reports, "chart": plain.charts}
    assert tables.keys() == {f"{kind}_{name}" for kind, group in groups.items() for name in group}
    for name in ("frame_5m", "report_overview", "check_bars", "chart_candles_30m"):
        kind, table = name.split("_", 1)
        want = groups[kind][table]
        assert tables[name].columns == want.columns
        for a, b in zip(sorted(map(tuple, tables[name].collect())), sorted(map(tuple, want.collect())), strict=True):
            assert [repr(x) if not isinstance(x, float) else round(x, 6) for x in a] == [repr(x) if not isinstance(x, float) else round(x, 6) for x in b]
    found = {(r.table_name, r.check): r.n for r in runs.counts(spark).collect()}
    assert found["source", "rows"] == 141 and found["source", "no_time"] == 1 and found["frame_1m", "rows"] == 140
