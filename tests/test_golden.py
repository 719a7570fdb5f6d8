"""Hand-worked rows: closes 10, 12, 11, 13 with volumes 1, 1, 2, 0."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import START, collect

from barloom.operators import changes, indicators

CLOSES, VOLUMES = [10.0, 12.0, 11.0, 13.0], [1, 1, 2, 0]


@pytest.fixture
def four(make_bars):
    return make_bars(
        [
            ("A", START + timedelta(minutes=i), c, c + 1, c - 1, c, v)
            for i, (c, v) in enumerate(zip(CLOSES, VOLUMES))
        ]
    )


def column(df, name):
    return [r[name] for r in collect(df)]


@pytest.mark.parametrize("block_days", [None, 1])
class TestGolden:
    def test_average(self, four, block_days):
        out = indicators.moving_average(four, 3, block_days=block_days)
        assert column(out, "ma_3") == pytest.approx([10, 11, 11, 12])

    def test_median(self, four, block_days):
        out = indicators.moving_median(four, 3, block_days=block_days)
        assert column(out, "median_3") == pytest.approx([10, 11, 11, 12])

    def test_bands(self, four, block_days):
        out = indicators.bollinger_bands(four, 3, 2.0, block_days=block_days)
        assert column(out, "bb_middle") == pytest.approx([10, 11, 11, 12])
        assert column(out, "bb_upper") == pytest.approx([10, 13.828427, 13, 14], abs=1e-6)
        assert column(out, "bb_lower") == pytest.approx([10, 8.171573, 9, 10], abs=1e-6)

    def test_vwap(self, four, block_days):
        out = indicators.vwap(four, block_days=block_days)
        assert column(out, "vwap") == pytest.approx([10, 11, 11, 11])

    def test_rsi(self, four, block_days):
        out = indicators.rsi(four, 3, block_days=block_days)
        assert column(out, "rsi") == pytest.approx([100, 100, 66.666667, 80], abs=1e-6)

    def test_returns(self, four, block_days):
        out = changes.with_returns(four, block_days=block_days)
        assert column(out, "returns")[0] is None
        assert column(out, "returns")[1:] == pytest.approx([0.2, -0.083333, 0.181818], abs=1e-6)

    def test_change_and_previous(self, four, block_days):
        assert column(changes.with_change(four, block_days=block_days), "price_change") == [
            None, 2, -1, 2,
        ]
        out = changes.with_previous(four, "close", "before", block_days=block_days)
        assert column(out, "before") == [None, 10, 12, 11]

    def test_open_and_index(self, four, block_days):
        out = changes.with_open_from_previous_close(four, 9.5, block_days=block_days)
        assert column(out, "open") == [9.5, 10, 12, 11]
        moved = changes.with_returns(four, block_days=block_days)
        index = changes.with_price_index(moved, initial_price=100, block_days=block_days)
        assert column(index, "price_index") == pytest.approx([100, 120, 110, 130])

    def test_running_sum(self, four, block_days):
        out = changes.with_running_sum(four, "volume", block_days=block_days)
        assert column(out, "running_volume") == [1, 2, 4, 4]

    def test_columns_are_kept_and_helpers_are_not(self, four, block_days):
        out = indicators.standard_metrics(four, "5m", block_days=block_days)
        added = ["ma_6", "median_6", "vwap", "bb_middle", "bb_upper", "bb_lower", "rsi"]
        assert out.columns == [*four.columns, *added]
        before = [tuple(r.asDict()[c] for c in four.columns) for r in four.collect()]
        after = [tuple(r[c] for c in four.columns) for r in collect(out)]
        assert after == before


    def test_compact_columns(self, four, block_days):
        out = indicators.compact_metrics(four, 3, block_days=block_days)
        assert out.columns == [
            *four.columns, "ma", "median", "vwap", "bb_upper", "bb_lower", "rsi",
        ]


class TestEdges:
    def test_no_volume_yet(self, make_bars):
        rows = [("A", START + timedelta(minutes=i), 5.0, 6.0, 4.0, 5.0, v) for i, v in enumerate([0, 3])]
        assert column(indicators.vwap(make_bars(rows)), "vwap") == [None, 5.0]

    def test_missing_volume_is_skipped_by_the_totals(self, make_bars):
        rows = [
            ("A", START + timedelta(minutes=i), p, p, p, p, v)
            for i, (p, v) in enumerate([(10.0, 1), (99.0, None), (20.0, 1)])
        ]
        assert column(indicators.vwap(make_bars(rows)), "vwap") == [10.0, None, 15.0]

    def test_constant_close(self, make_bars):
        rows = [("A", START + timedelta(minutes=i), 5.0, 5.0, 5.0, 5.0, 1) for i in range(5)]
        out = collect(
            indicators.add_indicators(
                make_bars(rows), indicators.rsi_of(3), indicators.bollinger_of(3)
            )
        )
        assert {r["rsi"] for r in out} == {100.0}
        assert all(r["bb_lower"] == r["bb_middle"] == r["bb_upper"] == 5.0 for r in out)

    def test_uptrend_has_full_strength(self, make_bars):
        rows = [
            ("A", START + timedelta(minutes=5 * i), 100.0 + i, 101.0 + i, 99.0 + i, 100.5 + i, 1000)
            for i in range(78)
        ]
        assert column(indicators.rsi(make_bars(rows), 14), "rsi")[-1] == 100.0

    def test_empty_table(self, make_bars):
        empty = make_bars([])
        assert indicators.standard_metrics(empty, "1m").count() == 0
        assert changes.with_returns(empty).count() == 0

    @pytest.mark.parametrize("bad", [0, -1, 2.5, True])
    def test_window_is_checked_when_planned(self, four, bad):
        with pytest.raises(ValueError):
            indicators.moving_average(four, bad)

    def test_other_parameters_are_checked(self, four):
        with pytest.raises(ValueError):
            indicators.bollinger_bands(four, 3, -1.0)
        with pytest.raises(ValueError):
            changes.with_open_from_previous_close(four, 0)
        with pytest.raises(ValueError):
            indicators.vwap(four, anchor="month")
        with pytest.raises(ValueError):
            indicators.moving_average(four, 3, "no_such_column")
