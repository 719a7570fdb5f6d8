from __future__ import annotations

import math

import numpy as np
import pytest

from barloom.llm import ann, topk, vectors

ODD = [
    (None, [1.0] * 8),
    (10_000, None),
    (10_020, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]),
    (10_040, [math.nan] * 8),
    (10_100, [math.inf] + [0.0] * 7),
]


def table(spark, x, ids=None, extra=()):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), [float(c) for c in v], 1) for i, v in zip(ids, x)] + [(i, v, 1) for i, v in extra]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(4)


def brute(x, ids, every, k, measure):
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = measure(x, x[q])
        order = np.lexsort((ids, -s))
        out[int(ids[q])] = [(int(ids[i]), s[i]) for i in order if i != q][:k]
    return out


def ranked(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("per_block", [vectors.BLOCK, 70])
def test_exact_topk(spark, monkeypatch, per_block):
    monkeypatch.setattr(vectors.blocks, "__defaults__", (np.asarray, per_block))
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 8)).astype(np.float32)
    x[100:200] = x[100]  # ties
    x[300:310] *= 40
    df = table(spark, x, extra=ODD + [(0, [float(c) for c in x[0]])])
    z = np.floor(256 * x.astype(float))
    got = ranked(topk.search(df).collect())
    assert got == brute(z, np.arange(600), 50, 5, lambda a, b: (a @ b).astype(np.int64))


def test_topk_few_rows(spark):
    x = np.array([[1.0, 0.0], [0.5, 0.5], [-1.0, 0.0]])
    assert ranked(topk.search(table(spark, x)).collect()) == {0: [(1, 32768), (2, -65536)]}
    assert topk.search(table(spark, x[:1])).count() == 0
    assert topk.search(table(spark, x).limit(0)).count() == 0
    # a shorter vector is filled up, of one id's vectors the smallest counts
    df = spark.createDataFrame([(0, [1.0]), (1, [0.5, 9.0]), (1, [0.25, 0.0])], "vec_id long, embedding array<double>")
    assert ranked(topk.search(df).collect()) == {0: [(1, 64 * 256)]}


@pytest.mark.parametrize("per_block", [vectors.BLOCK, 500])
def test_recall(spark, monkeypatch, per_block):
    monkeypatch.setattr(vectors.blocks, "__defaults__", (np.asarray, per_block))
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 32)) + 1.5 * rng.standard_normal((30, 32))[rng.integers(0, 30, 3000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[500:700] = x[500]
    x = x.astype(np.float32).astype(float)
    got = ranked(ann.search(table(spark, x, extra=[(i, v and v * 4) for i, v in ODD] + [(4000, [0.0] * 32)])).collect())
    want = brute(x, np.arange(3000), 20, 20, lambda a, b: (a * b).sum(axis=1))
    assert got.keys() == want.keys() and {len(v) for v in got.values()} == {20}
    shared = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(shared) >= 0.9
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert all(s == pytest.approx(float(x[i] @ x[q]), abs=1e-12) for i, s in hits)
    assert got[500][:19] == want[500][:19]  # equal vectors: ties by id


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 2**16, (400, 8), dtype=np.uint16)
    far = ann._distances(codes[:20], codes)
    m = codes.shape[1]
    for radius in (0, 5, 20, 50, 61):
        least, rest = divmod(radius, m)
        found = np.zeros((20, 400), bool)
        for j in range(m):
            found |= np.bitwise_count(codes[:20, j, None] ^ codes[None, :, j]) <= least - (j > rest)
        assert not ((far <= radius) & ~found).any()


def test_ann_few_rows(spark):
    x = np.array([[1.0, 0.0], [0.5, 0.5], [-1.0, 0.0]])
    assert [i for i, _ in ranked(ann.search(table(spark, x)).collect())[0]] == [1, 2]
    assert ann.search(table(spark, x[:1])).count() == 0
    assert ann.search(table(spark, x).limit(0)).count() == 0
