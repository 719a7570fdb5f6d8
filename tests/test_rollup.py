from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import START, collect, minute_rows
from pyspark.sql import functions as F

from barloom.operators import rollup
from barloom.schema import OHLCV, SchemaError, conform
from barloom.sources.ticks import as_ticks


@pytest.fixture
def day(make_bars):
    return make_bars(minute_rows())


def recomputed(rows, seconds):
    """Bars by plain Python, from rows in time order."""
    buckets: dict = {}
    for symbol, ts, o, h, l, c, v in rows:
        epoch = datetime(1970, 1, 1)
        start = epoch + timedelta(seconds=(ts - epoch) // timedelta(seconds=1) // seconds * seconds)
        b = buckets.setdefault((symbol, start), [o, h, l, c, 0])
        b[1], b[2], b[3], b[4] = max(b[1], h), min(b[2], l), c, b[4] + v
    return [
        dict(zip(("symbol", "timestamp", *OHLCV), (*key, *values)))
        for key, values in sorted(buckets.items())
    ]


@pytest.mark.parametrize("timeframe,seconds,bars", [("5m", 300, 78), ("30m", 1800, 13), ("1d", 86400, 1)])
def test_one_day(day, timeframe, seconds, bars):
    out = collect(rollup.roll_up(day, timeframe))
    assert len(out) == bars
    assert out == recomputed(minute_rows(), seconds)


def test_partial_day(make_bars):
    out = collect(rollup.roll_up(make_bars(minute_rows(minutes=100)), "5m"))
    assert len(out) == 20
    assert all(r[c] is not None for r in out for c in OHLCV)


def test_all_timeframes_at_once(make_bars):
    df = make_bars(minute_rows("A") + minute_rows("B", start=START + timedelta(days=1)))
    frames = ["2m", "5m", "30m", "1h", "1d", "1w"]
    long = rollup.roll_up_many(df, frames)
    for tf in frames:
        one = collect(rollup.roll_up(df, tf))
        assert collect(long.where(F.col("timeframe") == tf).drop("timeframe")) == one
        assert collect(rollup.split_frames(long, frames)[tf]) == one
        assert collect(rollup.roll_up_frames(df, frames)[tf]) == one


def test_weeks_start_on_monday(day):
    assert collect(rollup.roll_up(day, "1w"))[0]["timestamp"] == datetime(2024, 1, 1)


def test_shuffled_input_gives_the_same_bars(day):
    assert collect(rollup.roll_up(day.orderBy(F.rand(3)), "5m")) == collect(
        rollup.roll_up(day.repartition(9), "5m")
    )


def test_cascade_equals_direct(day):
    five = rollup.roll_up(day, "5m")
    assert collect(rollup.roll_up(five, "30m")) == collect(rollup.roll_up(day, "30m"))


def test_sparse_buckets_are_not_filled(make_bars):
    rows = minute_rows(minutes=60)
    df = make_bars(rows[:3] + rows[40:42])
    assert len(collect(rollup.roll_up(df, "5m"))) == 2


def ticks(spark, rows):
    raw = spark.createDataFrame(
        rows, "sym string, at timestamp_ntz, id bigint, price double, size bigint"
    )
    return as_ticks(raw, symbol="sym", timestamp="at", price="price", volume="size", tiebreak=["id"])


@pytest.mark.parametrize("ids", [(1, 2, 3, 4), (-(2**63), -5, 7, 2**63 - 1), (None, 0, 1, 2)])
def test_ties_go_by_the_tiebreaker(spark, ids):
    first, second, third, fourth = ids
    later = START + timedelta(microseconds=1)
    df = ticks(
        spark,
        [
            ("A", START, second, 2.0, 1), ("A", later, third, 3.0, 1),
            ("A", later, fourth, 4.0, 1), ("A", START, first, 1.0, 1),
        ],
    )
    for out in (
        collect(rollup.roll_up(df, "5m", tiebreak=["id"])),
        collect(rollup.roll_up_many(df, ["5m"], tiebreak=["id"])),
        collect(rollup.roll_up(df.withColumn("also", F.lit(0)), "5m", tiebreak=["id", "also"])),
    ):
        assert (out[0]["open"], out[0]["close"], out[0]["volume"]) == (1.0, 4.0, 4)


def test_null_first_price_drops_the_bar(make_bars):
    rows = minute_rows(minutes=10)
    broken = [(s, t, None if i == 0 else o, h, l, c, v) for i, (s, t, o, h, l, c, v) in enumerate(rows)]
    assert len(collect(rollup.roll_up(make_bars(broken), "5m"))) == 1


def test_null_volumes_add_up_to_zero(make_bars):
    rows = [(s, t, o, h, l, c, None) for s, t, o, h, l, c, _ in minute_rows(minutes=5)]
    assert collect(rollup.roll_up(make_bars(rows), "5m"))[0]["volume"] == 0


def test_empty_input(make_bars):
    assert rollup.roll_up(make_bars([]), "5m").count() == 0
    assert rollup.roll_up_many(make_bars([])).count() == 0


def test_session_zone_does_not_matter(spark, make_bars):
    # 02:30 does not exist in New York on this day.
    rows = minute_rows(start=datetime(2024, 3, 10, 0, 30), minutes=300)
    df = make_bars(rows).withColumn("id", F.monotonically_increasing_id())
    plain = collect(rollup.roll_up(df, "30m"))
    many = collect(rollup.roll_up_many(df, ["30m", "1d"], tiebreak=["id"]), "timeframe", "timestamp")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert collect(rollup.roll_up(df, "30m")) == plain
        again = rollup.roll_up_many(df, ["30m", "1d"], tiebreak=["id"])
        assert collect(again, "timeframe", "timestamp") == many
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_several_keys(make_bars):
    df = make_bars(minute_rows()).withColumn("venue", F.lit("X"))
    out = rollup.roll_up(df, "1d", keys=["symbol", "venue"])
    assert out.columns == ["symbol", "venue", "timestamp", *OHLCV]


def test_schema_is_checked_when_planned(day):
    with pytest.raises(SchemaError):
        rollup.roll_up(day.drop("volume"), "5m")
    with pytest.raises(ValueError):
        rollup.roll_up(day, "5 minutes")
    with pytest.raises(ValueError):
        rollup.roll_up(day, "0m")


def test_conform_casts_only_what_differs(spark, day):
    assert conform(day) is day
    odd = day.select(
        "symbol", F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.lit(1).alias("open"), F.lit(2).alias("high"), F.lit(1).alias("low"),
        "close", F.col("volume").cast("int").alias("volume"),
    )
    assert dict(conform(odd).dtypes) == dict(day.dtypes)
    assert conform(odd).first()["timestamp"] == START
