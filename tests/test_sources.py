from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import START, collect, minute_rows
from pyspark.sql import types as T

from barloom.operators import indicators, rollup
from barloom.plans import run
from barloom.sources import sinks
from barloom.sources.ticks import as_ticks, read_bars
from barloom.streaming import bars as streaming
from barloom.streaming.metrics import metrics_handler, read_metrics


@pytest.fixture
def two_days(make_bars):
    rows = []
    for symbol in "AB":
        for d in range(2):
            rows += minute_rows(symbol, seed=d, start=START + timedelta(days=d))
    return make_bars(rows)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_bars_survive_a_round_trip(spark, two_days, tmp_path, fmt):
    paths = []
    for symbol in "AB":
        target = str(tmp_path / symbol)
        sinks.write_reports({"bars": two_days.where(two_days.symbol == symbol)}, target, fmt)
        paths.append(f"{target}/bars")
    assert collect(read_bars(spark, *paths, fmt=fmt)) == collect(two_days)


def test_csv_per_timeframe(spark, two_days, tmp_path):
    frames = rollup.roll_up_frames(two_days)
    targets = sinks.write_frames_csv(frames, str(tmp_path))
    assert [t.rsplit("=")[1] for t in targets] == ["5m", "30m", "1d"]
    back = read_bars(spark, targets[2], fmt="csv")
    assert collect(back) == collect(frames["1d"])
    sinks.write_long_csv(rollup.roll_up_many(two_days), str(tmp_path / "long"))
    long = read_bars(
        spark, str(tmp_path / "long"), fmt="csv", partitions={"timeframe": T.StringType()}
    )
    assert long.count() == 2 * 2 * (78 + 13 + 1)


def test_unknown_report_format(two_days, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_reports({"x": two_days}, str(tmp_path), "xml")


def test_shared_folder_is_the_clusters(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert sinks.shared_folder(spark, "x").startswith(root)


def test_ticks_without_volume_count_one(spark):
    raw = spark.createDataFrame([("A", START, 2.0), ("A", START, 3.0)], "s string, t timestamp_ntz, p double")
    df = as_ticks(raw, symbol="s", timestamp="t", price="p")
    assert collect(rollup.roll_up(df, "1d"))[0]["volume"] == 2


def test_stored_run_equals_lazy_run(two_days, tmp_path):
    lazy = run.run_bars(two_days)
    stored = run.run_bars(two_days, store=str(tmp_path / "run"))
    assert lazy.frames.keys() == stored.frames.keys() == {"1m", "5m", "30m", "1d"}
    for name in ("5m", "1d"):
        assert collect(stored.frames[name].select(lazy.frames[name].columns)) == collect(lazy.frames[name])
    for group in ("checks", "reports", "charts"):
        tables, others = getattr(lazy, group), getattr(stored, group)
        assert tables.keys() == others.keys()
        for name, table in tables.items():
            assert others[name].count() == table.count(), name
    assert all(r["valid"] for r in stored.checks["metrics_5m"].collect())


def test_run_of_many_symbols_has_all_frames(two_days):
    frames = run.run_symbols(two_days)
    assert {tf: df.count() for tf, df in frames.items()} == {"1m": 1560, "5m": 312, "30m": 52, "1d": 4}
    assert "rsi" in frames["5m"].columns and "rsi" not in frames["1m"].columns


def test_session_batches_start_afresh(two_days):
    out = run.batch_metrics(two_days)
    firsts = out.where("hour(timestamp) = 9 and minute(timestamp) = 30")
    assert {r["rsi"] for r in firsts.collect()} == {100.0}
    for r in firsts.collect():
        assert r["vwap"] == pytest.approx((r["high"] + r["low"] + r["close"]) / 3)


class TestStream:
    def stream(self, spark, folder, schema):
        source = streaming.read_file_stream(spark, folder, schema)
        return streaming.stream_bars(source, "5m", lateness="5 minutes")

    def test_closed_windows_equal_batch(self, spark, two_days, tmp_path):
        source = str(tmp_path / "in")
        two_days.write.parquet(source)
        out, state = str(tmp_path / "out"), str(tmp_path / "state")
        streaming.write_available(self.stream(spark, source, two_days.schema), out, state)
        batch = [
            r for r in collect(rollup.roll_up(two_days, "5m"))
            if r["timestamp"] + timedelta(minutes=10) <= START + timedelta(days=1, minutes=389)
        ]
        assert collect(spark.read.parquet(out)) == batch

    def test_a_later_call_continues(self, spark, two_days, tmp_path):
        source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        cut = START + timedelta(minutes=202)
        for part in (two_days.where(two_days.timestamp < cut), two_days.where(two_days.timestamp >= cut)):
            part.write.mode("append").parquet(source)
            streaming.write_available(self.stream(spark, source, two_days.schema), out, state)
        batch = [
            r for r in collect(rollup.roll_up(two_days, "5m"))
            if r["timestamp"] + timedelta(minutes=10) <= START + timedelta(days=1, minutes=389)
        ]
        assert collect(spark.read.parquet(out)) == batch

    def test_metrics_continue_over_batches(self, spark, two_days, tmp_path):
        source, store, state = (str(tmp_path / n) for n in ("in", "store", "state"))
        edges = [START + timedelta(minutes=m) for m in (0, 33, 61, 150, 1500, 10_000)]
        for low, high in zip(edges, edges[1:]):
            part = two_days.where((two_days.timestamp >= low) & (two_days.timestamp < high))
            part.coalesce(1).write.mode("append").parquet(source)
            streaming.write_batches(
                self.stream(spark, source, two_days.schema), metrics_handler(store, "5m"), state
            )
        got = collect(read_metrics(spark, store))
        want = collect(indicators.standard_metrics(rollup.roll_up(two_days, "5m"), "5m"))
        last = START + timedelta(days=1, minutes=389)
        want = [r for r in want if r["timestamp"] + timedelta(minutes=10) <= last]
        assert len(got) == len(want)
        for a, b in zip(got, want):
            for name in ("symbol", "timestamp"):
                assert a.pop(name) == b.pop(name)
            assert a == pytest.approx(b)

    def test_batches_reach_a_handler(self, spark, two_days, tmp_path):
        source = str(tmp_path / "in")
        two_days.write.parquet(source)
        counts = []
        streaming.write_batches(
            self.stream(spark, source, two_days.schema),
            lambda df, _: counts.append(df.count()),
            str(tmp_path / "state"),
        )
        assert sum(counts) == 2 * (156 - 2)
