"""Importance resampling against plain loops, on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest

from barloom.llm import resample


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in low:
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            out, word = [*out, word] if word else out, ""
        else:
            word += c
    return [*out, word] if word else out


def grams(text, least, most, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(least, most + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, least=1, most=1, buckets=10_000, min_words=20, percent=10):
    hits = [grams(t, least, most, buckets) for _, t in docs]
    aims = [g for t in target for g in grams(t, least, most, buckets)]
    s, t = [0] * buckets, [0] * buckets
    for g in (g for h in hits for g in h):
        s[g] += 1
    for g in aims:
        t[g] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (len(aims) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for (i, text), h in zip(docs, hits, strict=True):
        weight = sum(gain[g] for g in h) // len(h) if h else 0
        u = i is not None and (int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append([i, len(h), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log(u))), None])
    able = [r for r, (_, text) in zip(out, docs, strict=True) if r[0] is not None and len(words(text)) >= min_words]
    able.sort(key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = rank + 1
    return sorted(map(tuple, out), key=repr)


def texts(n, seed=0):
    rng = random.Random(seed)
    some = ["Alpha", "beta", "x1", "Ünter", "ñ", "東京", "don't", "A-B", "\t", "é", "42", "__"]
    return [" ".join(rng.choice(some) for _ in range(rng.choice([0, 3, 19, 20, 21, 60]))) for _ in range(n)]


def run(spark, docs, target, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted(map(tuple, resample.resample(d, t, **settings).collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"least": 1, "most": 2}, {"least": 2, "most": 3, "buckets": 70_000}, {"percent": 100}, {"percent": 0}, {"min_words": 0}])
def test_like_plain_loops(spark, settings):
    docs = list(enumerate(texts(300))) + [(1000, None), (1001, ""), (1002, " .,;"), (None, "alpha " * 30), (5, "beta " * 40), (5, "beta " * 40)]
    target = [*texts(20, 1), None, ""]
    assert run(spark, docs, target, **settings) == brute(docs, target, **settings)


def test_empty_tables(spark):
    docs = list(enumerate(texts(50)))
    assert run(spark, [], texts(5)) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_long_text_and_other_columns(spark):
    text = " ".join(texts(4000))
    df = spark.createDataFrame([(1, text, 3, 4), (2, "a " * 25, 5, 6)], "doc_id long, text string, score long, `a.b` int")
    t = spark.createDataFrame([("alpha",)], "text string")
    assert sorted(map(tuple, resample.resample(df, t, percent=50).collect())) == brute([(1, text), (2, "a " * 25)], ["alpha"], percent=50)
