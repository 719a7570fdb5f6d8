from __future__ import annotations

import random
from math import sqrt
from statistics import NormalDist

import numpy as np
import pytest
from conftest import collect, minute_rows, sparse_rows
from pyspark.sql import functions as F

from barloom.functions.bar_columns import (
    path_from_returns,
    path_high,
    path_low,
    with_normal_quantile,
)
from barloom.operators import changes, indicators, ranks, rollup, shaping, stats


@pytest.fixture
def values(spark):
    """Three series: heavy-tailed, one value in most rows, and tiny or huge numbers."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        rows.append(("tails", i, rng.gauss(0, 1) ** 3))
        rows.append(("atom", i, 0.0 if i % 3 else rng.uniform(-1, 1)))
        rows.append(("wide", i, rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)))
    rows += [("one", 0, 2.5), ("none", 0, None)]
    return spark.createDataFrame(rows, "symbol string, i bigint, x double").cache()


def by_symbol(df):
    held: dict = {}
    for r in df.collect():
        if r["x"] is not None:
            held.setdefault(r["symbol"], []).append(r["x"])
    return held


def test_quantiles_are_exact(values):
    probabilities = {"a": 0.0, "b": 0.013, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    out = ranks.exact_quantiles(values, probabilities, keys=["symbol"], value="x")
    got = {r["symbol"]: r for r in out.collect()}
    held = by_symbol(values)
    assert got.keys() == held.keys()
    for symbol, xs in held.items():
        for name, p in probabilities.items():
            assert got[symbol][name] == pytest.approx(np.quantile(xs, p), rel=1e-12), (symbol, p)


def test_order_bin_never_decreases(values):
    rows = values.where("x is not null").withColumn("bin", ranks.order_bin("x"))
    bins = [r["bin"] for r in rows.orderBy("x").collect()]
    assert bins == sorted(bins)


def test_ranked_points_hold_every_row(values, monkeypatch):
    monkeypatch.setattr(ranks, "_RUN", 64)
    out = ranks.ranked_points(values, keys=["symbol"], value="x")
    for symbol, xs in by_symbol(values).items():
        rows = out.where(F.col("symbol") == symbol).orderBy("rank").collect()
        assert [r["rank"] for r in rows] == list(range(1, len(xs) + 1))
        assert [r["value"] for r in rows] == sorted(xs)
        assert {r["n"] for r in rows} == {len(xs)}


def test_normal_quantile(spark):
    ps = [1e-300, 1e-20, 1e-6, 0.01, 0.074, 0.075, 0.3, 0.5, 0.6, 0.925, 0.926, 0.99, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = {r["p"]: r["z"] for r in with_normal_quantile(df, "p", "z").collect()}
    for p in ps:
        assert got[p] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-13, abs=1e-15)


def test_normal_points_and_fit(spark):
    rng = random.Random(3)
    xs = [rng.gauss(5, 2) for _ in range(400)]
    df = spark.createDataFrame([("A", i, x) for i, x in enumerate(xs)], "symbol string, timestamp bigint, returns double")
    points = stats.normal_points(df)
    rows = points.orderBy("rank").collect()
    n = len(xs)
    shares = [1 - 0.5 ** (1 / n), *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], 0.5 ** (1 / n)]
    z = [NormalDist().inv_cdf(p) for p in shares]
    assert [r["theoretical"] for r in rows] == pytest.approx(z)
    assert [r["ordered"] for r in rows] == sorted(xs)
    fit = stats.normal_fit(points).first()
    slope, intercept = np.polyfit(z, sorted(xs), 1)
    assert (fit["slope"], fit["intercept"]) == pytest.approx((slope, intercept))
    assert fit["r"] == pytest.approx(np.corrcoef(z, sorted(xs))[0, 1])


def test_describe(make_bars):
    rows = sparse_rows("A") + minute_rows("B", minutes=51)
    out = {(r["symbol"], r["column_name"]): r for r in stats.describe(make_bars(rows), ["close", "volume"]).collect()}
    for symbol in "AB":
        for column, at in (("close", 5), ("volume", 6)):
            xs = np.array([r[at] for r in rows if r[0] == symbol], dtype=float)
            got = out[symbol, column]
            assert (got["n"], got["null_count"]) == (len(xs), 0)
            want = [xs.mean(), xs.std(ddof=1), xs.min(), *np.quantile(xs, [0.25, 0.5, 0.75]), xs.max()]
            assert [got[c] for c in ("mean", "std", "min", "q25", "median", "q75", "max")] == pytest.approx(want)


def test_describe_counts_nulls(make_bars):
    moves = changes.with_returns(make_bars(minute_rows(minutes=9)))
    row = stats.describe(moves, ["returns"]).first()
    assert (row["n"], row["null_count"]) == (8, 1)


def test_histogram_matches_numpy(make_bars):
    moves = changes.with_returns(make_bars(minute_rows("A") + sparse_rows("B")))
    out = stats.histogram(moves)
    for symbol in "AB":
        xs = [r["returns"] for r in moves.where(F.col("symbol") == symbol).collect() if r["returns"] is not None]
        counts, edges = np.histogram(xs, bins=30)
        rows = out.where(F.col("symbol") == symbol).orderBy("bin").collect()
        assert [r["n_values"] for r in rows] == counts.tolist()
        assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("A", i, 0.0) for i in range(4)], "symbol string, timestamp bigint, returns double")
    rows = stats.histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram([0.0] * 4, bins=30)
    assert [r["n_values"] for r in rows] == counts.tolist()
    assert rows[0]["bin_start"] == edges[0]


def test_correlation(make_bars):
    bars = rollup.roll_up(make_bars(minute_rows()), "5m")
    metrics = indicators.standard_metrics(bars, "5m").withColumn("same", F.lit(1.0))
    holes = metrics.withColumn("rsi", F.when(F.col("rsi") < 90, F.col("rsi")))
    out = {(r["col_a"], r["col_b"]): r["r"] for r in stats.correlation_matrix(holes).collect()}
    frame = holes.toPandas().drop(columns=["symbol", "timestamp"])
    want = frame.corr()
    assert len(out) == len(frame.columns) ** 2
    for a in frame.columns:
        for b in frame.columns:
            if "same" in (a, b):
                assert out[a, b] is None
            else:
                assert out[a, b] == pytest.approx(want.loc[a, b])


def test_risk(make_bars):
    rows = minute_rows()
    closes = np.array([r[5] for r in rows])
    moves = closes[1:] / closes[:-1] - 1
    got = stats.risk_metrics(make_bars(rows)).first()
    assert got["bar_volatility"] == pytest.approx(moves.std(ddof=1))
    assert got["annualized_volatility"] == pytest.approx(moves.std(ddof=1) * sqrt(252 * 390))
    assert got["range_drawdown"] == pytest.approx(min(r[4] for r in rows) / max(r[3] for r in rows) - 1)


def test_rolling_volatility(make_bars):
    rows = minute_rows(minutes=60)
    closes = np.array([r[5] for r in rows])
    moves = closes[1:] / closes[:-1] - 1
    got = [r["volatility"] for r in collect(changes.rolling_volatility(make_bars(rows), 20))]
    assert got[:20] == [None] * 20
    want = [moves[i - 20 : i].std(ddof=1) for i in range(20, 60)]
    assert got[20:] == pytest.approx(want)


def test_smoothness(make_bars):
    row = changes.smoothness(make_bars(minute_rows()), 30).first()
    assert row["is_smoother"] and 0 < row["smoothness_ratio"] < 1


def test_summaries(make_bars):
    minute = make_bars(minute_rows())
    metrics = indicators.standard_metrics(rollup.roll_up(minute, "5m"), "5m")
    row = stats.indicator_summary(metrics).first()
    assert row["n_bars"] == 78 and 0 <= row["mean_rsi"] <= 100
    flagged = shaping.rsi_flags(metrics)
    assert flagged.where("overbought").count() == row["overbought"]
    assert row["overbought_pct"] == pytest.approx(row["overbought"] / 78 * 100)
    quick = stats.quick_stats(minute, metrics).first()
    assert quick["n_bars"] == 390 and quick["volatility_pct"] > 0
    ratio = stats.bar_ratio(rollup.roll_up_many(minute, ["1m", "5m", "30m", "1d"]), ["1m", "5m", "30m", "1d"])
    assert tuple(ratio.first()) == ("A", 390, 78, 13, 1)


def test_bar_from_a_path(spark):
    df = spark.createDataFrame([(100.0, [0.01, -0.02, 0.005, 0.0], 99.0), (50.0, [], 51.0)], "o double, r array<double>, c double")
    rows = df.select(
        path_from_returns("o", "r").alias("path"), "o", "c"
    ).select("path", path_high("o", "path", "c").alias("h"), path_low("o", "path", "c").alias("l")).collect()
    path = np.cumprod([1.01, 0.98, 1.005, 1.0]) * 100
    assert rows[0]["path"] == pytest.approx(path.tolist())
    assert rows[0]["h"] == pytest.approx(101.0) and rows[0]["l"] == pytest.approx(path[1])
    assert rows[1]["path"] == [] and (rows[1]["h"], rows[1]["l"]) == (51.0, 50.0)
