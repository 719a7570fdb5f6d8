"""Moving quantiles against sorted windows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from barloom.operators import indicators
from barloom.operators.order_stats import WaveletMatrix, moving_quantile, moving_quantiles
from conftest import collect, sparse_rows


def plain(values, window, q):
    """Nulls skipped, NaN last, linear between two values."""
    out = []
    for i in range(len(values)):
        held = sorted((v for v in values[max(0, i + 1 - window) : i + 1] if v is not None), key=lambda v: (math.isnan(v), v))
        if not held:
            out.append(None)
            continue
        place = q * (len(held) - 1)
        a, b = held[math.floor(place)], held[min(math.floor(place) + 1, len(held) - 1)]
        out.append(a if place % 1 == 0 else a + (b - a) * (place % 1))
    return out


def same(found, wanted):
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted, strict=True):
        assert (a is None) == (b is None)
        if a is not None:
            assert a == pytest.approx(b, rel=1e-12, nan_ok=True)


def test_kth_of_any_stretch():
    rng = np.random.default_rng(3)
    ranks = rng.integers(0, 40, 500)
    start = rng.integers(0, 499, 2000)
    end = start + 1 + rng.integers(0, 500, 2000) % (500 - start)
    k = rng.integers(0, 500, 2000) % (end - start)
    want = [sorted(ranks[a:b])[i] for a, b, i in zip(start, end, k, strict=True)]
    assert WaveletMatrix(ranks).smallest(start, end, k).tolist() == want
    assert WaveletMatrix(np.zeros(5, np.int64)).smallest(np.array([1]), np.array([4]), np.array([2])).tolist() == [0]


@pytest.mark.parametrize("q", [0, 0.25, 0.5, 0.9, 1])
@pytest.mark.parametrize("window", [1, 2, 7, 1000])
def test_arrays(window, q):
    rng = random.Random(window)
    values = [rng.choice([None, rng.gauss(0, 1), 1.0, math.nan if q == 1 else 2.0]) for _ in range(300)]
    given = np.array([v is not None for v in values])
    plainly = np.array([0.0 if v is None else v for v in values])
    found = moving_quantiles(plainly, given, np.arange(300), window, q)
    want = plain(values, window, q)
    same([f for f, w in zip(found.tolist(), want, strict=True) if w is not None], [w for w in want if w is not None])


@pytest.mark.parametrize("group_rows", [1, 16, 1 << 15])
@pytest.mark.parametrize("block_days", [None, 3])
def test_series_in_groups(make_bars, group_rows, block_days):
    rows = sparse_rows("A", seed=1) + sparse_rows("B", seed=2)
    found = collect(moving_quantile(make_bars(rows), 9, group_rows=group_rows, block_days=block_days))
    assert len(found) == len(rows)
    for symbol in "AB":
        mine = [r for r in found if r["symbol"] == symbol]
        same([r["quantile_9"] for r in mine], plain([r["close"] for r in mine], 9, 0.5))


def test_long_median_equals_the_sorted_one(make_bars, monkeypatch):
    df = make_bars(sparse_rows("A", days=60))
    short = collect(indicators.moving_median(df, 40))
    monkeypatch.setattr(indicators, "LONG_WINDOW", 10)
    assert collect(indicators.moving_median(df, 40)) == short


def test_nulls_ties_other_columns_and_replaced_ones(spark):
    rows = [("A", i // 2, i, None if i % 3 else float(i % 7), "x", i) for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, n int, tie int, close double, `a.b` string, quantile_5 int")
    df = df.selectExpr("symbol", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, n) AS timestamp", "tie", "close", "`a.b`", "quantile_5")
    found = sorted(moving_quantile(df, 5, tiebreak=["tie"], group_rows=8, block_days=2).collect(), key=lambda r: r.tie)
    same([r.quantile_5 for r in found], plain([r[3] for r in rows], 5, 0.5))
    assert [r["a.b"] for r in found] == ["x"] * 60


def test_null_keys_and_empty(spark, make_bars):
    rows = [(None, *r[1:]) for r in sparse_rows("A", days=9)]
    found = sorted(moving_quantile(make_bars(rows), 4, group_rows=4).collect(), key=lambda r: r.timestamp)
    same([r.quantile_4 for r in found], plain([r.close for r in found], 4, 0.5))
    assert moving_quantile(make_bars([]), 4).collect() == []


def test_parameters(make_bars):
    for bad in ({"window": 0}, {"window": 3, "q": 1.5}):
        with pytest.raises(ValueError):
            moving_quantile(make_bars([]), **bad)


def test_a_row_goes_to_two_groups_at_most(make_bars):
    df = moving_quantile(make_bars(sparse_rows("A")), 50, group_rows=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "CartesianProduct" not in plan
