"""The physical plans the operators are meant to get."""

from __future__ import annotations

import pytest

from barloom.operators import changes, indicators, rollup, shaping, stats
from barloom.plans import catalog
from barloom.sources import sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_roll_up_shuffles_once_and_hashes(spark):
    text = plan(catalog.QUERIES["ohlc_5m"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text and "partial_min_by" in text


@pytest.mark.parametrize("name", ["ohlc_multi", "ohlc_multi_custom", "bar_stats", "ratio"])
def test_all_timeframes_share_one_scan(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "SortAggregate" not in final


def test_time_filter_reaches_the_scan(spark):
    raw = catalog.table(spark, SF, "events").where("ts >= timestamp_ntz'2024-01-05'")
    text = plan(rollup.roll_up(catalog.ticks_of(raw), "5m", tiebreak=["event_id"]))
    assert "GreaterThanOrEqual(ts" in text
    assert "user_id" not in text.split("ReadSchema")[1].split("\n")[0]


def test_one_sort_for_all_indicators(spark):
    bars = catalog.bars(spark, SF, "5m")
    text = plan(indicators.standard_metrics(bars, "5m", block_days=None))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("+- Sort ") == 1


def test_blocks_spread_a_symbol(spark):
    text = plan(indicators.standard_metrics(catalog.bars(spark, SF, "5m"), "5m", block_days=7))
    main = text.split("Union")[0]
    assert "hashpartitioning(symbol" in main and "_block" in main
    # The last rows of a block are chosen before they are shuffled.
    assert "WindowGroupLimit" in text and "Partial" in text


def test_bars_are_rolled_up_once_per_query(spark):
    df = indicators.compact_metrics(catalog.bars(spark, SF, "30m"), 10, block_days=7)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_a_histogram_shuffles_the_bars_once(spark):
    moves = changes.with_returns(catalog.bars(spark, SF, "30m"), block_days=7)
    df = stats.histogram(moves)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert final.count("Union") == 1


def test_head_rows_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(shaping.first_rows(catalog.bars(spark, SF, "5m"), 20))


def test_stored_bars_are_pruned(spark, tmp_path):
    sinks.write_bars(catalog.QUERIES["ohlc_multi"](spark, SF), str(tmp_path / "bars"))
    stored = sinks.read_stored_bars(spark, str(tmp_path / "bars"), ["1d"])
    text = plan(stored.where("session_date = date'2024-01-03'").select("close"))
    assert "session_date" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<close:double>" in text
    assert {r["timeframe"] for r in stored.select("timeframe").distinct().collect()} == {"1d"}


FORBIDDEN = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct",
    "BroadcastNestedLoopJoin", "SinglePartition",
)


@pytest.mark.parametrize(
    "name",
    [n for n in catalog.QUERIES if n not in ("csv_export", "report_export", "streaming_bars", "streaming_metrics", "stored_run")],
)
def test_no_python_no_cross_join_no_single_task(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    allowed = {"frame_summary": "SinglePartition", "head_rows": "SinglePartition"}
    # Of bounded groups, or one small matrix a task.
    allowed |= dict.fromkeys(("moving_median_long", "moving_quantile_long", "correlation_one_pass"), "FlatMapGroups")
    for word in FORBIDDEN:
        if allowed.get(name) != word:
            assert word not in text, word


def test_operators_run_no_job(spark):
    bars = catalog.bars(spark, SF, "30m")  # reads a Parquet footer
    spark.sparkContext.setJobGroup("planning", "no job may run")
    try:
        moves = changes.with_returns(bars, block_days=7)
        for df in (
            indicators.standard_metrics(bars, "30m", block_days=7),
            rollup.roll_up_many(bars, ["1h", "1d"]),
            stats.describe(moves, ["returns"]),
            stats.histogram(moves),
            stats.normal_points(moves),
            stats.correlation_matrix(bars),
        ):
            assert logical(df)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
