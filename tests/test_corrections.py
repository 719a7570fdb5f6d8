"""Late, repeated and out-of-order ticks against one batch roll-up of all of them."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import rollup
from barloom.schema import BAR_SCHEMA
from barloom.sources.ticks import as_ticks
from barloom.streaming import bars as streaming
from barloom.streaming.corrections import CorrectedBars, correct_available
from conftest import START, minute_rows

SCHEMA = "id long, symbol string, ts timestamp_ntz, price double, size long"
VIEW = {"symbol": "symbol", "timestamp": "ts", "price": "price", "volume": "size", "tiebreak": ["id"]}


def tick_rows(n=400, seed=0):
    rng = random.Random(seed)
    times = [START + timedelta(minutes=rng.randint(0, 3 * 1440)) for _ in range(n)]
    return [(i, rng.choice(["A", "B", None]), t, rng.uniform(1, 9), rng.choice([None, 1, 5])) for i, t in enumerate(times)]


def ticks_of(spark, rows):
    return as_ticks(spark.createDataFrame(rows, SCHEMA), **VIEW)


def want(spark, rows, timeframe="30m"):
    return sorted(map(tuple, rollup.roll_up(ticks_of(spark, rows), timeframe, tiebreak=["id"]).collect()), key=repr)


def have(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


@pytest.fixture
def store(tmp_path):
    return CorrectedBars(str(tmp_path / "store"), "30m", ["id"], tiebreak=["id"])


def test_any_order_repeats_and_a_batch_again(spark, store):
    rows = tick_rows()
    random.Random(5).shuffle(rows)
    parts = [rows[:150], rows[150:300] + rows[:40], rows[300:] + rows[120:200] + rows[300:320]]
    seen = {}
    for i, part in enumerate(parts):
        store.apply(ticks_of(spark, part), i)
        before = {r[:2]: r for r in seen.get(i - 1, [])}
        seen[i] = want(spark, list({r[0]: r for p in parts[: i + 1] for r in p}.values()))
        assert have(store.bars(spark)) == seen[i]
        changed = {r[:2] for r in seen[i] if before.get(r[:2]) != r}
        of_batch = {tuple(r)[:2] for r in store.bars(spark).where(F.col("revision") == i).collect()}
        assert changed <= of_batch
    files = sorted(map(tuple, store.replaced(spark).collect()), key=repr)
    store.apply(ticks_of(spark, parts[2]), 2)  # the driver was lost after the batch was written
    assert have(store.bars(spark)) == seen[2]
    assert sorted(map(tuple, store.replaced(spark).collect()), key=repr) == files
    for i in seen:
        assert have(store.as_of(spark, i)) == seen[i]


def test_repeated_ticks_touch_nothing(spark, store):
    rows = tick_rows(60)
    store.apply(ticks_of(spark, rows), 0)
    first = sorted(map(tuple, store.bars(spark).collect()), key=repr)
    store.apply(ticks_of(spark, rows + rows), 1)
    assert sorted(map(tuple, store.bars(spark).collect()), key=repr) == first
    # of ticks that share a key the first to come counts
    store.apply(ticks_of(spark, [(*r[:3], 1000.0, 7) for r in rows]), 2)
    assert sorted(map(tuple, store.bars(spark).collect()), key=repr) == first


def test_no_time_and_a_bar_that_goes(spark, store):
    rows = [(5, "A", START, 2.0, 1), (6, "A", None, 3.0, 1), (7, None, None, 3.0, 1)]
    store.apply(ticks_of(spark, rows), 0)
    assert [r.close for r in store.bars(spark).collect()] == [2.0]
    assert sorted(r.id for r in store.rejected(spark).collect()) == [6, 7]
    # an earlier tick without a price leaves the bar without an open
    store.apply(ticks_of(spark, [(4, "A", START, None, 1)]), 1)
    assert store.bars(spark).collect() == [] and len(store.replaced(spark).collect()) == 1
    store.apply(ticks_of(spark, []), 2)
    assert store.bars(spark).collect() == []


def test_stream_continues_over_files_out_of_order(spark, tmp_path, store):
    rows = tick_rows(120, 3)
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, part in enumerate([rows[80:], rows[:50], rows[50:80] + rows[:10]]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        files = streaming.read_file_stream(spark, str(tmp_path / "in/*"), schema)
        correct_available(as_ticks(files, **VIEW), store, str(tmp_path / "state"))
    assert have(store.bars(spark)) == want(spark, rows)


def test_parameters(spark, store):
    with pytest.raises(ValueError):
        CorrectedBars("/x", "5m", [])
    with pytest.raises(ValueError):
        store.apply(ticks_of(spark, []).drop("id"), 0)


def day_stream(spark, folder, **options):
    files = streaming.read_file_stream(
        options.pop("session", None) or streaming.stream_session(spark, 2), f"{folder}/day*", BAR_SCHEMA, files_per_batch=1
    )
    return streaming.stream_bars(files, "5m", **options)


def test_repeated_ticks_of_a_stream(spark, tmp_path, make_bars):
    rows = minute_rows(minutes=90)
    for i in range(2):
        make_bars(rows).coalesce(1).write.parquet(str(tmp_path / f"day{i}"))
    query = streaming.write_available(
        day_stream(spark, tmp_path, lateness="2 hours", tick_key=["symbol", "timestamp"]), str(tmp_path / "out"), str(tmp_path / "state")
    )
    closed = spark.read.schema(BAR_SCHEMA).parquet(str(tmp_path / "out"))
    last = streaming.open_bars(make_bars(rows), "5m", streaming.watermark_of(query))
    assert have(closed.unionByName(last)) == sorted(map(tuple, rollup.roll_up(make_bars(rows), "5m").collect()), key=repr)


def test_a_run_without_files_keeps_the_watermark(spark, tmp_path, make_bars):
    rows = minute_rows(minutes=180)
    make_bars(rows).coalesce(1).write.parquet(str(tmp_path / "day0"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = streaming.write_available(day_stream(spark, tmp_path), out, state)
    again = streaming.write_available(day_stream(spark, tmp_path), out, state)
    assert streaming.watermark_of(again, state) == streaming.watermark_of(first, state)
    with pytest.raises(ValueError):
        streaming.watermark_of(again)
    closed = spark.read.schema(BAR_SCHEMA).parquet(out)
    last = streaming.open_bars(make_bars(rows), "5m", streaming.watermark_of(again, state))
    assert have(closed.unionByName(last)) == sorted(map(tuple, rollup.roll_up(make_bars(rows), "5m").collect()), key=repr)


def test_forgotten_progress_is_not_taken_for_no_late_rows(spark, tmp_path, make_bars):
    for i in range(3):
        make_bars(minute_rows(minutes=20, start=START + timedelta(days=i))).coalesce(1).write.parquet(str(tmp_path / f"day{i}"))
    child = streaming.stream_session(spark, 2)
    child.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    with pytest.raises(streaming.ProgressLostError):
        streaming.write_available(day_stream(spark, tmp_path, session=child), str(tmp_path / "out"), str(tmp_path / "state"))
