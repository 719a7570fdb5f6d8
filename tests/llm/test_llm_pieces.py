from __future__ import annotations

import collections
import os

import numpy as np
import pytest

from barloom.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no model file here")

TEXTS = ["Hello  world", "", "  ▁x ▁ 日本語 😀\n\ttab", "a" * 5000, "   ", "é" * 3, "\x00nul", "foo bar foo bar", None, "\U000f0041 \U0010ffff"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def trie(vocabulary):
    return pieces.build_trie(vocabulary)


def test_sampled_ids_follow_the_distribution(vocabulary, trie):
    def ways(word):
        if not word:
            return [((), 0.0)]
        out = []
        for n in range(1, len(word) + 1):
            number = vocabulary.normal.get(word[:n])
            if number is not None:
                out += [((number, *rest), vocabulary.log_weight[number] + w) for rest, w in ways(word[n:])]
        return out

    count = 20_000
    for word in (" world", "ence"):
        ids, sizes = pieces.encode_rows([word] * count, np.arange(count) * 7919, trie, vocabulary.log_weight)
        at = np.r_[0, np.cumsum(sizes)]
        seen = collections.Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))
        all_ways = ways(word.replace(" ", "▁"))
        total = sum(np.exp(w) for _, w in all_ways)
        assert set(seen) <= {s for s, _ in all_ways}
        for s, w in all_ways:
            share = np.exp(w) / total
            assert abs(seen[s] / count - share) < 5 * np.sqrt(share / count) + 1e-3


def test_equal_words_draw_for_themselves(vocabulary, trie):
    ids, sizes = pieces.encode_rows([" world" * 3000], np.array([1]), trie, vocabulary.log_weight)
    raw, _ = pieces.decode_ids(ids, sizes, vocabulary.pieces)
    assert raw.tobytes().decode() == " world" * 3000
    alone, _ = pieces.encode_rows([" world"], np.array([1]), trie, vocabulary.log_weight, draw=False)
    assert len(ids) > 3000 * len(alone)


def test_long_runs_of_spaces(vocabulary, trie):
    rows = [" " * 40_000 + "word", "a" + " " * 33_000 + "日b", " " * 1500 + "word"]
    assert all(len(p) <= 2 * pieces.LONGEST for t in rows for p in trie.split.findall(t))
    ids, sizes = pieces.encode_rows(rows, np.arange(3), trie, vocabulary.log_weight)
    raw, at = pieces.decode_ids(ids, sizes, vocabulary.pieces)
    assert [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)] == rows


def test_round_trip(spark, vocabulary):
    rows = [(i if i % 4 else None, t, "clash") for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    encoded = pieces.encode(df, vocabulary=vocabulary)
    back = pieces.decode(encoded, vocabulary=vocabulary).collect()
    assert collections.Counter(map(tuple, back)) == collections.Counter((i, t or "") for i, t, _ in rows)
    found = encoded.collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in found)
    again = pieces.encode(df.repartition(5), vocabulary=vocabulary).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert pieces.encode(df.limit(0), vocabulary=vocabulary).count() == 0


def test_seed_and_key_change_the_draws(spark, vocabulary):
    text = "the segmentation of unknown words differs " * 20
    df = spark.createDataFrame([(1, text), (2, text), (1, text)], "doc_id long, text string")
    one = [r.ids for r in pieces.encode(df, vocabulary=vocabulary).orderBy("doc_id").collect()]
    two = [r.ids for r in pieces.encode(df, vocabulary=vocabulary, seed=1).orderBy("doc_id").collect()]
    assert one[0] == one[1] != one[2] and one[0] != two[0]


def test_blocks_of_parts_give_equal_ids(vocabulary, trie, monkeypatch):
    rows, keys = ["some words and more " * 50, "x y"], np.array([5, 6])
    whole = pieces.encode_rows(rows, keys, trie, vocabulary.log_weight)
    monkeypatch.setattr(pieces, "PARTS", 7)
    monkeypatch.setattr(pieces, "LONGEST", 16)  # long texts go in blocks
    parts = pieces.encode_rows(rows, keys, trie, vocabulary.log_weight)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_borders(vocabulary):
    assert all("▁" not in p.lstrip("▁") for p in vocabulary.normal)
