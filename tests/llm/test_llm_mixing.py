from __future__ import annotations

import collections
import random
import re

import pytest

from barloom.llm import mixing


def wanted_targets(sizes, weights=3, most=3):
    """Excess shared anew by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % weights + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        full = {s for s in open_ if share[s] >= most * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def corpus(rng):
    rows = []
    for s, n in (("a", 900), ("b", 40), ("c", 3), (None, 60), ("d", 200), ("", 25), ("é", 80)):
        for _ in range(n):
            words = int(rng.paretovariate(1.1)) % 3000
            rows.append((len(rows) if rng.random() < 0.95 else None, "w " * words, s, 7))
    rows += [(1, None, "a", 1), (1, "", "b", 1), (5, "x y z", "b", 1), (5, "x y z", "b", 1), (6, "w " * 9000, "d", 1)]
    return rows


@pytest.mark.parametrize("fold", [4, 512])
def test_targets_and_bounds(spark, monkeypatch, fold):
    monkeypatch.setattr(mixing, "FOLD", fold)
    rows = corpus(random.Random(2))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, text, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken, parts = wanted_targets(sizes), collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size + r.part <= 3 * r.size
        ratio = r.target / r.source_size if r.source_size else 0
        assert r.size == 0 or int(ratio) <= r.copies <= int(ratio) + 1
        taken[r.source] += r.taken
        parts[r.source] += r.part > 0
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], abs=1.5) and parts[s] <= 1
    again = mixing.mix(df.repartition(3)).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))


def test_draws_have_no_drift(spark):
    rows = [(i, "w " * (i % 7 + 1), "ab"[i % 2]) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total, runs = collections.Counter(), 6
    for seed in range(runs):
        for r in mixing.mix(df, seed=seed, whole=True).collect():
            total[r.source] += r.copies
    # a and b weigh 1 and 2 of all words, so ratios are 2/3 and 4/3 of about equal sizes
    share = {s: total[s] / (120 * runs) for s in "ab"}
    assert share["a"] == pytest.approx(2 / 3, abs=0.06) and share["b"] == pytest.approx(4 / 3, abs=0.06)


def test_repeat_and_empty(spark):
    rows = [(i, "w " * (i % 5), "ab"[i % 2], 3) for i in range(40)] + [(1, "same", "a", 4)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = mixing.repeat(df)
    assert out.columns == df.columns
    counts = collections.Counter(map(tuple, out.collect()))
    assert set(counts) <= set(rows) and max(counts.values()) <= 9
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.repeat(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(empty).collect()] == [(0, 0.0)] * 2
