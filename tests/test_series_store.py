"""Stored series give the metrics of the bars, without an exchange."""

from __future__ import annotations

import uuid
from datetime import date

import pytest

from barloom.operators import indicators
from barloom.operators.indicators import moving_average_of, rsi_of, standard_set, vwap_of
from barloom.sources import series_store
from conftest import collect, sparse_rows


@pytest.fixture
def stored(make_bars, tmp_path):
    bars = make_bars(sparse_rows("A") + sparse_rows("B", seed=2) + [(None, *r[1:]) for r in sparse_rows("C", seed=3)])
    name = f"series_{uuid.uuid4().hex}"
    series_store.store_standard(bars, name, str(tmp_path / "series"), "1m", buckets=5, block_days=4)
    return bars, name


def order(rows):
    return sorted(rows, key=lambda r: (r["symbol"] or "", r["timestamp"]))


def same(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(order(found), order(wanted), strict=True):
        assert a.keys() == b.keys() and a["symbol"] == b["symbol"] and a["timestamp"] == b["timestamp"]
        numbers = [c for c in a if c not in ("symbol", "timestamp")]
        assert [a[c] for c in numbers] == pytest.approx([b[c] for c in numbers], rel=1e-9)


def test_equals_the_bars(spark, stored):
    bars, name = stored
    found = series_store.standard_metrics_of(spark, name, "1m")
    same(collect(found), collect(indicators.standard_metrics(bars, "1m", block_days=None)))


def test_no_exchange(spark, stored):
    found = series_store.standard_metrics_of(spark, stored[1], "1m")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan


def test_days_read_their_blocks_only(spark, stored):
    bars, name = stored
    days = {"start": date(2024, 1, 9), "end": date(2024, 1, 23)}
    found = series_store.standard_metrics_of(spark, name, "1m", **days)
    whole = collect(indicators.standard_metrics(bars, "1m", block_days=None))
    same(collect(found), [r for r in whole if days["start"] <= r["timestamp"].date() < days["end"]])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_block" in plan and "LessThanOrEqual(_block" in plan


def test_lesser_sets_work_and_others_are_refused(spark, stored):
    bars, name = stored
    few = [moving_average_of(7), vwap_of()]
    same(collect(series_store.indicators_of(spark, name, few)), collect(indicators.add_indicators(bars, *few, block_days=None)))
    with pytest.raises(ValueError, match="before a block"):
        series_store.indicators_of(spark, name, [rsi_of(31)])
    with pytest.raises(ValueError, match="written by"):
        spark.range(3).write.mode("overwrite").saveAsTable("no_series")
        series_store.indicators_of(spark, "no_series", standard_set("1m"))


def test_nothing_carried(spark, make_bars, tmp_path):
    name = f"series_{uuid.uuid4().hex}"
    bars = make_bars(sparse_rows("A"))
    series_store.store_series(bars, name, str(tmp_path / "s"), [moving_average_of(3)], buckets=2)
    same(collect(series_store.indicators_of(spark, name, [moving_average_of(3)])), collect(indicators.moving_average(bars, 3)))
    with pytest.raises(ValueError, match="carries no"):
        series_store.indicators_of(spark, name, [vwap_of()])
