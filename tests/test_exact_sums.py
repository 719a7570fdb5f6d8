"""Exact sums against the standard library's, in any order and dealing of rows."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators
from barloom.operators.exact_sums import exact_sums, exact_vwap, with_exact_vwap
from conftest import minute_rows, sparse_rows

SCHEMA = "symbol string, x double"


def bits(x):
    return None if x is None else struct.pack(">d", x)


def summed(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return {r.symbol: r.total for r in exact_sums(df, {"total": "x"}).collect()}


def series():
    rng = random.Random(5)
    anywhere = [math.ldexp(rng.uniform(-1, 1), rng.randint(-1070, 1000)) for _ in range(400)]
    cancelling = [v for x in anywhere for v in (x, -x)] + [1e-300, 3.0]
    rng.shuffle(cancelling)
    edges = [s * math.ldexp(m, e) for e in range(-1074, 1016, 8) for m in (1.0, 1.9999999999999998) for s in (1, -1)]
    return {
        "prices": [rng.uniform(1, 100) for _ in range(500)],
        "anywhere": anywhere,
        "cancelling": cancelling,
        "edges": [*edges, 5e-324, 5e-324, math.ldexp(1.0, 500)],
        "powers": [2.0**e for e in range(-1074, 1000)],
        "below powers": [math.nextafter(2.0**e, 0.0) for e in range(-1000, 1000, 16)],
        "tie": [1.0, 2.0**-53],
        "above a tie": [1.0, 2.0**-53, 2.0**-105],
        "zeros": [0.0, -0.0],
        "one": [0.1],
        None: [0.1] * 10,
    }


def test_nearest_to_the_true_sum(spark):
    found = summed(spark, [(k, x) for k, xs in series().items() for x in xs])
    for key, xs in series().items():
        assert bits(found[key]) == bits(math.fsum(xs)), key


def test_odd_values(spark):
    big = 1.7976931348623157e308
    cases = {
        "nan": ([1.0, math.nan], math.nan),
        "up": ([1.0, math.inf], math.inf),
        "down": ([1.0, -math.inf], -math.inf),
        "both": ([math.inf, -math.inf], math.nan),
        "none": ([None, None], None),
        "some": ([None, 2.0], 2.0),
        "beyond": ([big, big], math.inf),
        "back": ([big, big, -big], big),
    }
    found = summed(spark, [(k, x) for k, (xs, _) in cases.items() for x in xs])
    assert found.keys() == cases.keys()
    for key, (_, want) in cases.items():
        assert found[key] is want is None or found[key] == want or (math.isnan(want) and math.isnan(found[key])), key


def test_empty_table_and_clashing_names(spark):
    assert exact_sums(spark.createDataFrame([], SCHEMA), {"total": "x"}).collect() == []
    df = spark.createDataFrame([("a", 1.5, 2.5)], "`a.b` string, _x0 double, _band0 double")
    assert exact_sums(df, {"_k0": "_x0", "n": "_band0 * 2"}, keys=["a.b"]).collect() == [("a", 1.5, 5.0)]


def test_a_hot_series_sends_one_row_a_band(spark):
    plan = exact_sums(spark.range(10).selectExpr("'a' AS symbol", "id * 0.5D AS x"), {"total": "x"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum") > text.index("Exchange")  # lower in the plan: before it
    assert "Sort" not in text


@pytest.mark.parametrize("seed", range(20))
def test_any_dealing_gives_the_same_bits(spark, make_bars, seed):
    rows = [*sparse_rows("A"), *sparse_rows("B", seed=3), *minute_rows("C")]
    want = running(make_bars(rows).coalesce(1))
    random.Random(seed).shuffle(rows)
    dealt = make_bars(rows).repartition(seed % 7 + 2, F.rand(seed))
    assert running(dealt) == want


def running(df):
    each = with_exact_vwap(df, block_days=3).collect()
    whole = exact_vwap(df).collect()
    return (
        {(r.symbol, r.timestamp): bits(r.vwap) for r in each},
        {r.symbol: (bits(r.turnover), bits(r.traded), bits(r.vwap)) for r in whole},
    )


def test_running_equals_the_plain_one(make_bars):
    df = make_bars([*sparse_rows("A"), *minute_rows("C"), *[(None, *r[1:]) for r in sparse_rows("N")]])
    exact = with_exact_vwap(df, block_days=3)
    plain = indicators.vwap(df, block_days=3)
    assert exact.columns == plain.columns
    at = {(r.symbol, r.timestamp): r.vwap for r in plain.collect()}
    found = {(r.symbol, r.timestamp): r.vwap for r in exact.collect()}
    assert found.keys() == at.keys()
    for key, want in at.items():
        assert found[key] == (want if want is None else pytest.approx(want, rel=1e-12))


def test_total_is_the_last_of_the_running_ones(make_bars):
    rows = minute_rows("C")
    (whole,) = exact_vwap(make_bars(rows)).collect()
    want = math.fsum((r[3] + r[4] + r[5]) / 3 * r[6] for r in rows)
    assert whole.turnover == want
    assert whole.traded == sum(r[6] for r in rows)
    assert whole.vwap == want / whole.traded
