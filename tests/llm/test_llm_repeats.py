from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from barloom.llm import repeats, texts


def brute(rows, length):
    """Per row what windows that begin more than once cover."""
    seen = collections.Counter()
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = collections.Counter()
    for (i, _), b in zip(rows, data, strict=True):
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if mask[k] and (k == 0 or not mask[k - 1]))
        kept = bytes(c for c, m in zip(b, mask, strict=True) if not m)
        out[i, len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest(), kept] += 1
    return out


def corpus(length, seed=3):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(length + 60))
    rows = []
    for i in range(60):
        x = "".join(rng.choice("abcdefghijk é") for _ in range(rng.randint(0, 500)))
        if rng.random() < 0.5:
            k = rng.randint(0, 60)
            x += passage[k : k + rng.randint(length - 5, length + 60)] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 100)))
        rows.append((i if rng.random() < 0.9 else None, x))
    rows += [(7, rows[3][1]), (7, rows[3][1]), (8, "a" * 900), (9, "ab" * 300), (10, None), (11, "")]
    rows += [(12, "z" * (length - 1)), (13, "z" * (length - 1)), (14, ("q" * 50 + "w") * 30), (15, "0123456789" * 3000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("length", "many", "held"), [(200, 4096, 1 << 20), (200, 3, 1 << 20), (40, 4096, 500), (40, 3, 500), (7, 4096, 1 << 20)])
def test_against_all_windows(spark, monkeypatch, length, many, held):
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "HELD", held)
    rows = corpus(length)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(4)
    got = repeats.remove(df, length=length, keep_text=True).collect()
    got = collections.Counter((*r[:5], bytes(r[5])) for r in got)
    assert got == brute(rows, length)


def test_windows_of_a_hot_anchor_meet_in_few_rows(spark, monkeypatch):
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choice("abcdefghijk ") for _ in range(n))
    passage = draw(700)
    rows = [(i, draw(rng.randint(150, 250)) + passage + draw(rng.randint(150, 250))) for i in range(400)]
    sent, tasks = [], 4
    surroundings = repeats._surroundings
    monkeypatch.setattr(repeats, "MANY", 50)
    monkeypatch.setattr(repeats, "_surroundings", lambda *a: sent.append(surroundings(*a)) or sent[0])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)
    got = collections.Counter(tuple(r) for r in repeats.remove(df).collect())
    assert got == collections.Counter({k[:5]: v for k, v in brute(rows, 200).items()})
    found = [r for r in sent[0].collect() if r.ask > 0]
    groups = collections.Counter(r.g for r in found if r.ask < 3)
    for r in found:
        if r.ask == 3:
            groups.update((int(x["g"]), int(x["w"]), int(x["far"])) for x in np.frombuffer(bytes(r.bytes), repeats._WINDOW))
    assert groups and max(groups.values()) <= 50
    assert max(v for k, v in groups.items() if isinstance(k, tuple)) <= tasks


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(texts, "CHUNK", 300)
    rows = corpus(200, seed=4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = collections.Counter(tuple(r) for r in repeats.remove(df).collect())
    assert got == collections.Counter({k[:5]: v for k, v in brute(rows, 200).items()})


def test_empty_and_bad_length(spark):
    df = spark.createDataFrame([(1, "x" * 199)], "doc_id long, text string")
    assert [tuple(r)[:4] for r in repeats.remove(df).collect()] == [(1, 199, 0, 0)]
    assert repeats.remove(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.remove(df, length=0)


def test_anchors_divide_the_windows():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    begin, end = np.array([0, 150, 1000, 4000]), np.array([150, 1000, 4000, 5000])
    a, low, high, text, g, f = repeats.anchors(raw, begin, end)
    covered = np.concatenate([np.arange(x, y + 1) for x, y in zip(low, high, strict=True)])
    want = [p for b, e in zip(begin, end, strict=True) for p in range(b, e - 199)]
    assert sorted(covered) == want
    assert ((a >= high) & (a + repeats.GRAM <= low + 200)).all()
