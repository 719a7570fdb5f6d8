"""Nothing is lost or changed without notice: late rows, headers, ranges, other names."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import START, minute_rows
from pyspark.sql import functions as F

from barloom.functions.timegrid import bucket_start, bucket_start_of_bar
from barloom.operators import changes, indicators, rollup, stats
from barloom.plans import run
from barloom.schema import BAR_SCHEMA
from barloom.sources import sinks
from barloom.sources.ticks import as_ticks, read_bars
from barloom.streaming import bars as streaming


@pytest.mark.parametrize("timeframe", ["1w", "2w", "4w", "3d", "7d", "1d", "90m"])
def test_both_bucket_forms_agree(spark, timeframe):
    days = spark.range(0, 20000, 13).select(
        F.expr("TIMESTAMP_NTZ'1969-12-25 00:00:00' + make_dt_interval(CAST(id AS INT), 5)").alias("ts")
    )
    both = days.select(bucket_start("ts", timeframe).alias("a"), "ts").withColumn(
        "b", bucket_start_of_bar("ts", timeframe)
    )
    assert both.where("a != b OR a > ts").count() == 0
    if timeframe.endswith("w"):
        assert both.where("dayofweek(a) != 2").count() == 0


def test_weeks_in_a_cascade(make_bars):
    rows = [("A", START + dt.timedelta(days=d), 1.0 + d, 2.0 + d, 0.5 + d, 1.5 + d, 10) for d in range(80)]
    frames = rollup.roll_up_frames(make_bars(rows), ["1d", "1w", "2w", "4w"])
    for tf in ("1w", "2w", "4w"):
        alone = rollup.roll_up(make_bars(rows), tf)
        assert sorted(map(tuple, frames[tf].collect())) == sorted(map(tuple, alone.collect()))


def write_csv(tmp_path, text):
    (tmp_path / "bars.csv").write_text(text)
    return str(tmp_path / "bars.csv")


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = write_csv(
        tmp_path,
        "volume,close,symbol,extra,timestamp,low,high,open\n7,1.5,A,x,2024-01-02T09:30:00,1.0,2.0,1.25\n",
    )
    (row,) = read_bars(spark, path, fmt="csv").collect()
    assert tuple(row) == ("A", dt.datetime(2024, 1, 2, 9, 30), 1.25, 2.0, 1.0, 1.5, 7)


def test_csv_faults_raise(spark, tmp_path):
    header = ",".join(f.name for f in BAR_SCHEMA.fields)
    broken = write_csv(tmp_path, f"{header}\nA,2024-01-02T09:30:00,x,2.0,1.0,1.5,7\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read_bars(spark, broken, fmt="csv").collect()
    with pytest.raises(ValueError, match="volume"):
        read_bars(spark, write_csv(tmp_path, "symbol,timestamp,open,high,low,close\n"), fmt="csv")


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'A' AS s, TIMESTAMP_NTZ'2024-01-02 00:00:00' + make_dt_interval(CAST(id AS INT)) AS t, 1.0D AS p FROM range(10)").write.parquet(path)
    ticks = as_ticks(spark.read.parquet(path), symbol="s", timestamp="t", price="p", start="2024-01-04", end="2024-01-06")
    bars = rollup.roll_up(ticks, "1d")
    assert bars.count() == 2
    plan = bars._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t,2024-01-04" in plan and "LessThan(t,2024-01-06" in plan


def test_run_with_other_column_names(spark, make_bars, tmp_path):
    bars = make_bars(minute_rows("A", minutes=120)).withColumnsRenamed({"symbol": "name", "timestamp": "at"})
    for store in (None, str(tmp_path / "run")):
        result = run.run_bars(bars, keys=["name"], ts="at", store=store)
        for tables in (result.frames, result.checks, result.reports, result.charts):
            for name, df in tables.items():
                assert "timestamp" not in df.columns and df.count() >= 0, name
        verdicts = result.checks["rollup_5m"].collect()
        assert [r.valid for r in verdicts] == [True]
        assert result.checks["repeated"].count() == 0
    many = run.run_symbols(bars, keys=["name"], ts="at", store=str(tmp_path / "many"))
    assert many["5m"].count() == 24


def ticks_files(spark, folder, days):
    """One file a day, in the order given."""
    for i, day in enumerate(days):
        rows = [("A", dt.datetime(2024, 1, day, 9, m), float(m), float(m), float(m), float(m), 1) for m in range(0, 60, 5)]
        spark.createDataFrame(rows, BAR_SCHEMA).coalesce(1).write.parquet(f"{folder}/day{i}")


def stream(spark, folder, lateness):
    files = streaming.read_file_stream(
        streaming.stream_session(spark, 2), f"{folder}/day*", BAR_SCHEMA, pattern="*.parquet", files_per_batch=1
    )
    return streaming.stream_bars(files, "5m", lateness=lateness)


def test_late_rows_raise(spark, tmp_path):
    import time

    # The watermark that drops rows is the one of the batch before the last.
    ticks_files(spark, tmp_path, [3, 4])
    time.sleep(1.1)  # files are taken by their time
    (later := tmp_path / "x").mkdir()
    ticks_files(spark, later, [2])
    (later / "day0").rename(tmp_path / "day2")
    with pytest.raises(streaming.LateRowsError):
        streaming.write_available(stream(spark, tmp_path, "10 minutes"), str(tmp_path / "out"), str(tmp_path / "state"))
    query = streaming.write_available(
        stream(spark, tmp_path, "10 minutes"), str(tmp_path / "out2"), str(tmp_path / "state2"), allow_late=True
    )
    assert streaming.late_rows(query) > 0
    # with lateness enough and the open windows added, the bars equal those of a batch
    query = streaming.write_available(stream(spark, tmp_path, "3 days"), str(tmp_path / "out3"), str(tmp_path / "state3"))
    source = spark.read.schema(BAR_SCHEMA).parquet(*(str(tmp_path / f"day{i}") for i in range(3)))
    last = streaming.open_bars(source, "5m", streaming.watermark_of(query))
    closed = spark.read.schema(BAR_SCHEMA).parquet(str(tmp_path / "out3"))
    want = sorted(map(tuple, rollup.roll_up(source, "5m").collect()))
    assert sorted(map(tuple, closed.unionByName(last).collect())) == want and len(want) == 36


def test_null_symbols_and_nan(spark):
    rows = [(None, float(i)) for i in range(5)] + [("A", float("nan")), ("A", 2.0), ("A", None)]
    df = spark.createDataFrame(rows, "symbol string, close double").withColumn("timestamp", F.lit(START))
    got = {r.symbol: r for r in stats.describe(df, ["close"]).collect()}
    assert (got[None].n, got[None].median, got[None].max) == (5, 2.0, 4.0)
    assert (got["A"].n, got["A"].null_count, got["A"].mean, got["A"].max) == (1, 2, 2.0, 2.0)
    counts = {s: n for s, n in stats.histogram(df, "close").groupBy("symbol").agg(F.sum("n_values")).collect()}
    assert counts == {None: 5, "A": 1}
    marks = {r.symbol: (r.n_values, r["mean"], r.median) for r in stats.distribution_summary(df, "close").collect()}
    assert marks == {None: (5, 2.0, 2.0), "A": (1, 2.0, 2.0)}
    points = stats.normal_points(df, "close").groupBy("symbol").count().collect()
    assert {r[0]: r[1] for r in points} == {None: 5, "A": 1}


def test_a_large_session_is_not_bound_to_a_number_of_files(spark, make_bars, tmp_path):
    bars = make_bars(minute_rows("A", minutes=390)).withColumn("timeframe", F.lit("1m"))
    sinks.write_bars(bars, str(tmp_path / "b"))
    assert sinks.read_stored_bars(spark, str(tmp_path / "b"), ["1m"]).count() == 390


def test_repeated_bars_have_an_order(spark, make_bars):
    rows = minute_rows("A", minutes=60) + minute_rows("A", minutes=60, seed=7)
    bars = make_bars(rows)
    # two rows a minute, told apart by their prices
    options = {"tiebreak": ["open", "close"], "block_days": 7}

    def result(df):
        df = indicators.standard_metrics(df, "1m", **options)
        df = changes.with_returns(df, **options)
        return sorted(map(str, changes.with_running_sum(df, **options).collect()))

    first = result(bars)
    assert all(result(bars.repartition(n, "close")) == first for n in (1, 5, 9))
    whole = indicators.moving_average(bars, 3, tiebreak=["open", "close"], block_days=None)
    parts = indicators.moving_average(bars.repartition(3), 3, **options)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_volatility_uses_the_last_known_close(spark, make_bars):
    closes = [1.0, 2.0, None, 3.0, None, None, 6.0, 3.0]
    rows = [("A", START + dt.timedelta(days=10 * i), 1.0, 1.0, 1.0, c, 1) for i, c in enumerate(closes)]
    for block_days in (7, None):
        got = changes.rolling_volatility(make_bars(rows), 3, block_days=block_days).orderBy("timestamp").collect()
        want = [None, 1.0, 0.0, 0.5, 0.0, 0.0, 1.0, -0.5]
        assert [r.returns for r in got] == want
        assert [r.volatility is None for r in got] == [True] * 3 + [False] * 5
        again = changes.with_returns(make_bars(rows), block_days=block_days).orderBy("timestamp").collect()
        assert [r.returns for r in again] == want
