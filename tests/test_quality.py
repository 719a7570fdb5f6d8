from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import START, collect, minute_rows
from pyspark.sql import functions as F

from barloom.operators import changes, indicators, quality, rollup, shaping
from barloom.schema import indicator_columns, numeric_columns
from barloom.sources import calendar


@pytest.fixture
def day(make_bars):
    return make_bars(minute_rows())


def only(df):
    (row,) = df.collect()
    return row.asDict()


def test_good_bars(day):
    row = only(quality.validate_bars(day))
    assert row["valid"] and row["n_bars"] == 390
    assert row["high_violations"] == row["low_violations"] == row["price_violations"] == 0


def test_bad_bars(day):
    row = only(quality.validate_bars(day.withColumn("low", F.col("high") + 1)))
    assert not row["valid"] and not row["low_ok"] and row["low_violations"] == 390
    row = only(quality.validate_bars(day.withColumn("open", F.lit(0.0))))
    assert not row["price_ok"] and row["price_violations"] == 390


def test_unknown_values_break_no_rule(day):
    row = only(quality.validate_bars(day.withColumn("close", F.lit(None).cast("double"))))
    assert row["valid"]


@pytest.mark.parametrize("timeframe,bars", [("5m", 78), ("30m", 13), ("1d", 1)])
def test_rollup_is_valid(day, timeframe, bars):
    row = only(quality.validate_rollup(day, rollup.roll_up(day, timeframe), bars))
    assert row["valid"] and row["volume_difference"] == 0


def test_rollup_that_lost_bars(day):
    part = rollup.roll_up(day, "5m").where(F.col("timestamp") > START)
    row = only(quality.validate_rollup(day, part, 78))
    assert not row["valid"] and not row["bar_count_ok"] and not row["volume_ok"]


def test_rollup_that_is_empty(day):
    row = only(quality.validate_rollup(day, rollup.roll_up(day, "5m").where("false"), 78))
    assert row["n_bars"] == 0 and row["high_ge_open"] and not row["valid"]


@pytest.mark.parametrize("timeframe", ["1m", "5m", "30m"])
def test_metrics_are_valid(day, timeframe):
    bars = rollup.roll_up(day, timeframe)
    assert only(quality.validate_metrics(indicators.standard_metrics(bars, timeframe)))["valid"]
    assert only(quality.validate_metrics(indicators.compact_metrics(bars, 6)))["valid"]


@pytest.mark.parametrize(
    "column,value,verdict",
    [("rsi", 101.0, "rsi_ok"), ("vwap", 1.0, "vwap_ok"), ("bb_lower", 1e6, "bands_ok"),
     ("ma_30", None, "nulls_ok")],
)
def test_metrics_that_are_not(day, column, value, verdict):
    metrics = indicators.standard_metrics(day, "1m")
    broken = metrics.withColumn(column, F.lit(value).cast("double"))
    row = only(quality.validate_metrics(broken))
    assert not row[verdict] and not row["valid"]


def test_ranges_agree(day):
    frames = {"1m": day, **rollup.roll_up_frames(day)}
    assert only(quality.range_consistency(frames))["consistent"]
    frames["5m"] = frames["5m"].withColumn("high", F.col("high") + 1)
    assert not only(quality.range_consistency(frames))["consistent"]
    long = rollup.roll_up_many(day, ["1m", "5m", "1d"])
    assert only(quality.range_consistency_long(long)) | {"n_timeframes": 4} == only(
        quality.range_consistency({"1m": day, **rollup.roll_up_frames(day)})
    )


@pytest.mark.parametrize("timeframe,bars,step", [("5m", 78, 300), ("30m", 13, 1800)])
def test_spacing_and_counts(day, timeframe, bars, step):
    rolled = rollup.roll_up(day, timeframe)
    row = only(quality.bar_spacing(rolled, timeframe))
    assert row["evenly_spaced"] and row["min_step_seconds"] == row["max_step_seconds"] == step
    row = only(quality.session_counts(rolled, bars, timeframe))
    assert row["count_ok"] and row["first_bar"] == START and row["misaligned"] == 0
    assert only(quality.session_counts(rolled, bars, "7m"))["misaligned"] > 0


def test_gaps(make_bars):
    rows = minute_rows(minutes=10)
    df = make_bars([r for i, r in enumerate(rows) if i not in (3, 4, 7)])
    row = only(quality.completeness(df, "1m"))
    assert row["gap_count"] == 2 and row["percent_complete"] == pytest.approx(500 / 7)
    assert not only(quality.bar_spacing(df, "1m"))["evenly_spaced"]


def test_a_night_is_no_gap(make_bars):
    df = make_bars(minute_rows() + minute_rows(start=START + timedelta(days=1)))
    assert only(quality.completeness(df))["gap_count"] == 0
    assert changes.with_gap_seconds(df).where("gap_seconds is null").count() == 2


def test_spine(spark):
    spine = calendar.session_spine(calendar.sessions(spark, date(2024, 1, 5), 3))
    assert spine.count() == 3 * 390
    first, last = spine.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert (first.hour, first.minute, last.hour, last.minute) == (9, 30, 15, 59)
    assert calendar.sessions(spark, date(2024, 1, 5), 3, weekdays_only=True).count() == 1


def test_missing_minutes(make_bars):
    rows = minute_rows()
    df = make_bars(rows[:100] + rows[103:])
    missing = collect(calendar.missing_minutes(df))
    assert [r["timestamp"] for r in missing] == [rows[i][1] for i in (100, 101, 102)]


def test_union_and_duplicates(day):
    again = shaping.union_days(day, shaping.shift_days(day, 1))
    assert again.count() == 780 and shaping.duplicate_bars(again).count() == 0
    assert shaping.duplicate_bars(shaping.union_days(day, day)).count() == 390


def test_repair(make_bars):
    df = make_bars([("A", START, 10.0, 9.0, 11.0, 12.0, 1)])
    row = only(shaping.repair_bars(df))
    assert (row["high"], row["low"]) == (12.0, 10.0)


def test_alignment(day):
    five, thirty = rollup.roll_up(day, "5m"), rollup.roll_up(day, "30m")
    out = shaping.align_timeframes(five, thirty, "30m")
    assert out.count() == 78
    assert out.where("high > coarse_high or low < coarse_low").count() == 0


def test_candles(make_bars):
    df = make_bars(
        [("A", START, 1.0, 4.0, 0.5, 3.0, 1), ("A", START + timedelta(minutes=1), 3.0, 4.0, 1.0, 2.0, 1)]
    )
    up, down = collect(shaping.candles(df, "1m"))
    assert (up["color"], up["body_height"], up["body_base"]) == ("green", 2.0, 1.0)
    assert (down["color"], down["body_height"], down["body_base"]) == ("red", 1.0, 2.0)
    assert up["half_width_seconds"] == 24.0


def test_scaled_rows(make_bars):
    rows = minute_rows(minutes=30)
    out = collect(shaping.scaled_first_rows(make_bars(rows), 20))
    assert len(out) == 20
    assert {r["price_level"] for r in out} <= set(range(21))
    assert max(r["price_level"] for r in out) == 20 and min(r["price_level"] for r in out) == 0
    assert max(r["volume_bar_length"] for r in out) == 16
    assert out[0]["label"] == "09:30"
    flat = make_bars([("A", START + timedelta(minutes=i), 1.0, 1.0, 1.0, 1.0, 5) for i in range(3)])
    assert {r["price_level"] for r in collect(shaping.scaled_first_rows(flat))} == {0}


def test_head_and_shape(day):
    assert [r["timestamp"] for r in shaping.head_rows(day, 2).collect()] == [
        START, START + timedelta(minutes=1),
    ]
    shape = only(shaping.frame_shape(day))
    assert (shape["n_rows"], shape["n_columns"]) == (390, 7)


def test_columns_by_type_and_role(day):
    metrics = indicators.standard_metrics(day, "1m")
    assert numeric_columns(day) == ["open", "high", "low", "close", "volume"]
    assert indicator_columns(metrics) == [
        "ma_30", "median_30", "vwap", "bb_middle", "bb_upper", "bb_lower", "rsi",
    ]
    assert shaping.indicator_lines(metrics).columns[2:] == [
        "close", "ma_30", "median_30", "vwap", "bb_middle", "bb_upper", "rsi",
    ]
