"""Reports from stored summaries against the same reports from the bars of the range."""

from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators, quality, stats
from barloom.operators.changes import with_returns
from barloom.schema import SYMBOL
from barloom.sources.summaries import SessionSummaries
from conftest import minute_rows, sparse_rows

COLUMNS = ("close", "volume")
RANGES = [(None, None), (date(2024, 1, 3), date(2024, 1, 20)), (date(2024, 1, 15), None), (None, date(2024, 1, 9)), (date(2030, 1, 1), None)]


def rows_of():
    """Idle days, busy days, one price all day, closes that are not known, a null symbol."""
    rows = [*sparse_rows("A"), *sparse_rows("B", seed=4), *minute_rows("C")]
    rows += [(None, *r[1:]) for r in sparse_rows("N", seed=2)]
    rows += [("flat", datetime(2024, 1, d, 9, m), 5.0, 5.0, 5.0, 5.0, 0) for d in (2, 3, 5) for m in range(3)]
    odd = [(2, 0, None), (2, 1, None), (3, 0, None), (3, 1, 7.0), (3, 2, None), (4, 0, None), (4, 1, 9.0), (4, 2, 0.0), (5, 0, 2.0), (5, 1, math.nan), (6, 0, 3.0)]
    rows += [("odd", datetime(2024, 1, d, 10, m), 1.0, 10.0, 1.0, c, None if m == 1 else 4) for d, m, c in odd]
    rows += [("once", datetime(2024, 1, 8, 10, 0), 1.0, 2.0, 0.5, 1.5, 3)]
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from barloom.schema import BAR_SCHEMA

    bars = spark.createDataFrame(rows_of(), BAR_SCHEMA).cache()
    summaries = SessionSummaries(str(tmp_path_factory.mktemp("s")), "1m", COLUMNS)
    summaries.store(bars)
    return bars, summaries


def within(bars, start, end):
    day = F.to_date("timestamp")
    if start is not None:
        bars = bars.where(day >= F.lit(start))
    return bars if end is None else bars.where(day < F.lit(end))


def same(found, want, by):
    assert sorted(found.columns) == sorted(want.columns)
    a, b = ({tuple(r[k] for k in by): r.asDict() for r in df.collect()} for df in (found, want))
    assert a.keys() == b.keys()
    for key, row in b.items():
        for column, value in row.items():
            got = a[key][column]
            if isinstance(value, float) and got is not None:
                assert got == pytest.approx(value, rel=1e-9, abs=1e-12), (key, column)
            else:
                assert got == value, (key, column, got, value)


def clean(bars):
    """NaN is missing in summaries; elsewhere it is a value of a series."""
    return bars.withColumn("close", F.expr("nullif(close, double('NaN'))"))


@pytest.mark.parametrize("start, end", RANGES)
def test_reports_of_a_range(spark, stored, start, end):
    bars, summaries = stored
    part = clean(within(bars, start, end))
    moves = with_returns(part)
    same(summaries.describe(spark, start, end), stats.describe(moves, [*COLUMNS, "returns"]), [SYMBOL, "column_name"])
    same(summaries.risk(spark, start, end), stats.risk_metrics(part), [SYMBOL])
    same(summaries.bar_stats(spark, start, end), stats.bar_stats(part), [SYMBOL])
    same(summaries.completeness(spark, start, end), quality.completeness(part), [SYMBOL])


def test_sessions_are_replaced_and_added(spark, make_bars, tmp_path):
    rows = minute_rows("A", minutes=4000)
    summaries = SessionSummaries(str(tmp_path), "1m", COLUMNS)
    days = sorted({r[1].date() for r in rows})
    wrong = [(*r[:5], r[5] + 1, r[6]) for r in rows if r[1].date() == days[1]]
    summaries.store(make_bars([r for r in rows if r[1].date() in days[:1]] + wrong))
    for day in days[1:]:  # the second one again
        summaries.store(make_bars([r for r in rows if r[1].date() == day]))
    summaries.store(make_bars([r for r in rows if r[1].date() == days[1]]))
    bars = make_bars(rows)
    same(summaries.describe(spark), stats.describe(with_returns(bars), [*COLUMNS, "returns"]), [SYMBOL, "column_name"])


def test_a_range_reads_its_sessions_and_no_bars(spark, stored):
    _, summaries = stored
    text = summaries.risk(spark, date(2024, 1, 3), date(2024, 1, 5))._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(session_date") == text.count("FileScan") > 0
    assert "/values" not in text


def test_dashboard(spark, make_bars, tmp_path):
    bars = make_bars([*minute_rows("A", minutes=2000), *minute_rows("B", minutes=900, seed=3)])
    metrics = indicators.standard_metrics(bars, "5m")
    minute, rest = (SessionSummaries(str(tmp_path / n), "1m", c) for n, c in (("m", ("close",)), ("x", ("vwap", "rsi"))))
    minute.store(bars)
    rest.store(metrics)
    start = date(2024, 1, 3)
    same(minute.dashboard(rest, spark, start), stats.quick_stats(within(bars, start, None), within(metrics, start, None)), [SYMBOL])
    with pytest.raises(ValueError):
        minute.dashboard(minute, spark)


def test_empty_and_clashing(spark, make_bars, tmp_path):
    summaries = SessionSummaries(str(tmp_path / "e"), "1m", COLUMNS)
    with pytest.raises(ValueError):
        summaries.store(make_bars([]).withColumn("returns", F.lit(1.0)))
    summaries.store(make_bars([("A", None, 1.0, 1.0, 1.0, 1.0, 1), ("A", datetime(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1)]))
    (row,) = summaries.bar_stats(spark).collect()
    assert (row.symbol, row.n_bars) == ("A", 1)
