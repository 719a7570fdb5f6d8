"""Matrices of moments against plain pairs, merged in any split."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from barloom.operators.comoments import Moments, correlations


def plain(rows, i, j):
    """Pearson's r over the rows where both are known."""
    both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
    if len(both) < 2:
        return None
    mx, my = (math.fsum(c) / len(both) for c in zip(*both, strict=True))
    if any(math.isnan(v) for b in both for v in b):
        return math.nan
    sx, sy = math.fsum((a - mx) ** 2 for a, _ in both), math.fsum((b - my) ** 2 for _, b in both)
    if len({a for a, _ in both}) == 1 or len({b for _, b in both}) == 1:
        return None
    return math.fsum((a - mx) * (b - my) for a, b in both) / math.sqrt(sx * sy)


def data(n, seed=0, far=0.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a = rng.gauss(0, 1) + far
        out.append([a if rng.random() > 0.2 else None, a + rng.gauss(0, 1) if rng.random() > 0.3 else None, rng.gauss(0, 1e-3), 0.1 + 0.2, None])
    return out


def of(rows):
    known = np.array([[v is not None for v in r] for r in rows])
    return Moments.of(np.array([[0.0 if v is None else v for v in r] for r in rows]), known)


def check(found, rows, rel=1e-9):
    for i in range(5):
        for j in range(5):
            want, r = plain(rows, i, j), found[i, j]
            assert (r == -np.inf) if want is None else r == pytest.approx(want, rel=rel, nan_ok=True)


@pytest.mark.parametrize("far", [0.0, 1e6, 1e9])
def test_any_split(far):
    rows = data(400, far=far)
    rng = random.Random(1)
    parts, at = [], 0
    while at < len(rows):
        to = at + rng.choice([1, 2, 30, 100])
        parts.append(of(rows[at:to]))
        at = to
    whole = parts[0]
    for m in parts[1:]:
        whole = whole.merged(m)
    check(whole.correlation(), rows, rel=1e-6 if far > 1e8 else 1e-9)
    check(of(rows).correlation(), rows, rel=1e-6 if far > 1e8 else 1e-9)


def test_nan_counts_where_the_other_is_known():
    rows = data(50)
    rows[3][2], rows[3][0] = math.nan, None
    check(of(rows).correlation(), rows)


def test_tables(spark):
    rows = {("A", 1): data(60, 1), ("A", None): data(3, 2), (None, 2): data(40, 3), ("B", 1): [[1.0, 2.0, 3.0, 4.0, None]]}
    flat = [(*k, *r, "x") for k, rs in rows.items() for r in rs]
    schema = "symbol string, `k.2` int, " + ", ".join(f"c{i} double" for i in range(5)) + ", other string"
    df = spark.createDataFrame(flat, schema).repartition(7)
    names = [f"c{i}" for i in range(5)]
    found = {(r.symbol, r["k.2"], r.col_a, r.col_b): r.r for r in correlations(df, names, keys=["symbol", "k.2"]).collect()}
    assert len(found) == 4 * 25
    for (s, k), rs in rows.items():
        for i in range(5):
            for j in range(5):
                want, r = plain(rs, i, j), found[s, k, f"c{i}", f"c{j}"]
                assert r is None if want is None else r == pytest.approx(want, rel=1e-9)
    assert correlations(df.limit(0), names, keys=["symbol", "k.2"]).collect() == []


def test_one_narrow_scan(spark, tmp_path):
    spark.range(50).selectExpr("'A' AS symbol", "id AS a", "id * id AS b", "id AS unused").write.parquet(str(tmp_path / "t"))
    plan = correlations(spark.read.parquet(str(tmp_path / "t")), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unused" not in plan and "Generate" not in plan
