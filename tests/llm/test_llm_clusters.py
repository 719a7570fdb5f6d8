"""Centroid clustering against plain loops, on odd input."""

from __future__ import annotations

import hashlib
import random

import pytest

from barloom.llm import clusters


def brute(rows, dim=64, k=16, rounds=3):
    kept = [(i, [int(64 * x // 1) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and abs(x) < 1e9 for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        where = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (w, _) in zip(kept, where, strict=True) if w == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    where = assign()
    inertia = [sum(d for w, d in where if w == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, w, d, inertia[w], sum(inertia), sha[w]) for (i, _), (w, d) in zip(kept, where, strict=True)), key=repr)


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, clusters.cluster(df, **settings).collect()), key=repr)


def vectors(n, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.choice([rng.gauss(0, 1), rng.randint(-2, 2) / 64]) for _ in range(64)]) for i in range(n)]


def test_like_plain_loops(spark):
    rows = vectors(150)
    rows += [(i, rows[3][1]) for i in range(150, 190)]  # copies
    rows += [(7, rows[9][1]), (7, rows[7][1]), (None, rows[5][1]), (None, rows[1][1])]  # ids that repeat or lack
    odd = [None, [], [0.0] * 63, [0.0] * 65, [float("nan"), *[0.0] * 63], [float("inf"), *[0.0] * 63], [None, *[0.0] * 63]]
    assert run(spark, rows + [(900 + i, v) for i, v in enumerate(odd)]) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5, 16])
def test_few_vectors(spark, n):
    assert run(spark, vectors(n)) == brute(vectors(n))


def test_all_equal(spark):
    rows = [(i, [0.3] * 64) for i in range(40)]
    found = run(spark, rows)
    assert found == brute(rows) and {r[1] for r in found} == {0}


def test_other_columns_and_parameters(spark):
    rows = [(i, v[:3]) for i, v in vectors(60)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster int, `a.b` int")
    found = sorted(map(tuple, clusters.cluster(df, dim=3, k=4, rounds=2).collect()), key=repr)
    assert found == brute(rows, 3, 4, 2)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="no distance in a long"):
        run(spark, [(1, [1e30] * 64)])
