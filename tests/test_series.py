"""Blocks of a series must give what one window per series gives."""

from __future__ import annotations

import math

import pytest
from conftest import collect, minute_rows, sparse_rows

from barloom.operators import changes, indicators

OPERATORS = {
    "average": lambda df, **s: indicators.moving_average(df, 30, **s),
    "median": lambda df, **s: indicators.moving_median(df, 7, **s),
    "vwap": lambda df, **s: indicators.vwap(df, **s),
    "bands": lambda df, **s: indicators.bollinger_bands(df, 20, **s),
    "rsi": lambda df, **s: indicators.rsi(df, 14, **s),
    "volatility": lambda df, **s: changes.rolling_volatility(df, 20, **s),
    "standard": lambda df, **s: indicators.standard_metrics(df, "1m", **s),
    "compact": lambda df, **s: indicators.compact_metrics(df, 6, **s),
    "returns": lambda df, **s: changes.with_returns(df, **s),
    "change": lambda df, **s: changes.with_change(df, **s),
    "previous": lambda df, **s: changes.with_previous(df, "volume", "before", **s),
    "open": lambda df, **s: changes.with_open_from_previous_close(df, 3.0, **s),
    "index": lambda df, **s: changes.with_price_index(
        changes.with_returns(df, **s), initial_price=10.0, **s
    ),
    "running": lambda df, **s: changes.with_running_sum(df, "volume", **s),
}


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def assert_same_rows(left, right):
    left, right = collect(left), collect(right)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert a.keys() == b.keys()
        assert all(same(a[k], b[k]) for k in a), (a, b)


@pytest.fixture
def series(make_bars):
    # One busy symbol beside three small ones.
    rows = sparse_rows("hot", days=60, seed=9) + minute_rows("day", minutes=90)
    for s in ("x", "y"):
        rows += sparse_rows(s)
    return make_bars(rows).repartition(5, "close").cache()


@pytest.mark.parametrize("name", OPERATORS)
def test_blocks_equal_whole_series(series, name):
    whole = OPERATORS[name](series, block_days=None)
    for days in (1, 3, 28):
        assert_same_rows(OPERATORS[name](series, block_days=days), whole)


def test_nulls_reach_back_over_blocks(make_bars):
    rows = [list(r) for r in sparse_rows("n", days=50, seed=4)]
    for i, r in enumerate(rows):
        if i % 7 not in (0, 1):
            r[5] = None
    df = make_bars([tuple(r) for r in rows])
    for name in ("returns", "average", "vwap", "change"):
        assert_same_rows(OPERATORS[name](df, block_days=1), OPERATORS[name](df, block_days=None))


def test_input_order_does_not_matter(series):
    for name in ("standard", "index"):
        assert_same_rows(
            OPERATORS[name](series.orderBy("volume"), block_days=3),
            OPERATORS[name](series.repartition(7), block_days=3),
        )


def test_dates_before_the_epoch(make_bars):
    from datetime import datetime, timedelta

    rows = [
        ("A", datetime(1969, 12, 28) + timedelta(hours=9 * i), 1.0, 2.0, 1.0, 1.0 + i % 3, i)
        for i in range(20)
    ]
    df = make_bars(rows)
    assert_same_rows(
        indicators.standard_metrics(df, "1m", block_days=2),
        indicators.standard_metrics(df, "1m", block_days=None),
    )
