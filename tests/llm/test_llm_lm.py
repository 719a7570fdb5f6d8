"""Context-tree weighting against its definition, written as a recursion over a dictionary."""

from __future__ import annotations

import collections
import math
import os
import random
import zlib

import numpy as np
import pytest

from barloom.llm import lm
from barloom.llm.common import table

DEPTH, HELD = 5, (2, 7)


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


class Tree:
    """counts[context, decision]: the context as bytes, the latest last."""

    def __init__(self, texts):
        self.counts = collections.defaultdict(lambda: [0, 0])
        for data in texts:
            for context, decision, bit in self.decisions(data):
                for d in range(DEPTH + 1):
                    self.counts[context[DEPTH - d :], decision][bit] += 1
        self.children = collections.defaultdict(list)
        for context, decision in self.counts:
            if context:
                self.children[context[1:], decision].append(context)
        self.logs = {}
        for context, decision in sorted(self.counts, key=lambda k: -len(k[0])):
            self.logs[context, decision] = self.weighted(context, decision)

    @staticmethod
    def decisions(data):
        data = b"\xff" * DEPTH + data + b"\xff"
        for i in range(DEPTH, len(data)):
            decision = 1
            for k in range(7, -1, -1):
                bit = data[i] >> k & 1
                yield data[i - DEPTH : i], decision, bit
                decision = 2 * decision + bit

    def kt(self, context, decision):
        a, b = self.counts[context, decision]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, context, decision):
        stop = self.kt(context, decision)
        if len(context) == DEPTH:
            return stop
        go = sum(self.logs[c, decision] for c in self.children[context, decision])
        high = max(stop, go)
        return high + math.log((math.exp(stop - high) + math.exp(go - high)) / 2)

    def p_one(self, context, decision, d=0):
        """The mixture below the context of d bytes, or None where it was not seen."""
        here = context[DEPTH - d :]
        if (here, decision) not in self.counts:
            return None
        a, b = self.counts[here, decision]
        share = (b + 0.5) / (a + b + 1)
        deeper = self.p_one(context, decision, d + 1) if d < DEPTH else None
        if deeper is None:
            return share
        stop = math.exp(self.kt(here, decision) - self.logs[here, decision]) / 2
        return stop * share + (1 - stop) * deeper

    def score(self, data):
        out = 0.0
        for context, decision, bit in self.decisions(data):
            p = self.p_one(context, decision)
            p = 0.5 if p is None else p
            out += math.log10(p if bit else 1 - p)
        return out


def brute(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % HELD[1] == HELD[0] for i, _ in rows]
    tree = Tree([low(t) for (_, t), h in zip(rows, held, strict=True) if not h])
    words = [low(t).split() + [None] for _, t in rows]
    c = collections.Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for (i, t), h, ws in zip(rows, held, words, strict=True):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        out.append((i, h, len(ws), sum(c[w] > 0 for w in ws), n, base, tree.score(low(t))))
    return out


def run(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.score(df, **settings).collect()
    return [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found]


def same(found, wanted):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=order), sorted(wanted, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def some_texts(n, seed=0):
    rng = random.Random(seed)
    words = ["the", "cat", "Cat", "sat", "ñandú", "東京", "x", "\t", "\n\n", "mat.", "on", "a b"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_like_the_definition(spark):
    rows = list(enumerate(some_texts(60))) + [(500, None), (501, ""), (None, "the cat"), (None, None)]
    rows += [(7, "the cat sat"), (7, "the cat sat")] + [(600 + i, "copy of the cat") for i in range(20)]
    same(run(spark, rows), brute(rows))


def test_many_chunks_and_salts(spark, monkeypatch):
    rows = list(enumerate(some_texts(80, 2)))
    whole = sorted(run(spark, rows))
    monkeypatch.setattr(lm, "LISTS", 1)  # the driver's choice of salts
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    split = lm.score(df, buckets=3).collect()
    assert len(split) == len(whole)
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in split], whole)


def test_pieces_of_a_chunk():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 5, 40_000, 0, 1, 300, 0, 2], np.int64)
    raw = rng.integers(97, 101, sizes.sum()).astype(np.uint8)
    learnt = np.array([1, 0, 1, 1, 0, 1, 0, 1], bool)
    want = lm.gram_counts(raw, sizes, learnt)
    logs = rng.random(len(want[0]))
    runs = lm.Runs(raw, sizes)
    assert (runs.keys == want[0]).all()
    scores = runs.scores(logs)
    old = lm.PIECE, lm.PIECE_TEXTS
    try:
        lm.PIECE, lm.PIECE_TEXTS = 1000, 3
        for a, b in zip(lm.gram_counts(raw, sizes, learnt), want, strict=True):
            assert (a == b).all()
        assert lm.Runs(raw, sizes).scores(logs) == pytest.approx(scores)
    finally:
        lm.PIECE, lm.PIECE_TEXTS = old
    data = raw[5 : 40_005].tobytes()
    plain = collections.Counter((b"\xff" * 5 + data + b"\xff")[i : i + 6] for i in range(40_001))
    assert sum(plain.values()) + 300 + 2 + 4 == want[1].sum()  # bytes of learnt texts and their ends


def test_probabilities_add_up_to_one():
    texts = [t.encode() for t in some_texts(40)]
    raw, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
    keys, counts = lm.gram_counts(raw, sizes, np.ones(len(texts), bool))
    contexts = np.unique(np.concatenate([keys >> 8, [0, 0x2061627A7A, 0xFFFFFFFFFF]]))
    wanted = (contexts[:, None] << 8 | np.arange(256)).ravel()
    at = np.searchsorted(wanted, keys)
    known = np.zeros(len(wanted), np.int64)
    known[at] = counts
    sums = lm.one_byte_sums(keys, counts)
    top = lm.Top(list(zip(*(sums[k].tolist() for k in ("context", "decision", "zeros", "ones", "logs")), strict=True)))
    logs = lm.gram_logs(wanted, known, top).reshape(-1, 256)
    assert (10**logs).sum(axis=1) == pytest.approx(np.ones(len(contexts)))


def test_kt():
    for most, near in ((1000, 1e-9), (10**9, 1e-4)):
        a, b = np.meshgrid(np.r_[0:70, most], np.r_[0:70, most])
        want = [math.lgamma(x + 0.5) + math.lgamma(y + 0.5) - math.log(math.pi) - math.lgamma(x + y + 1) for x, y in zip(a.ravel().tolist(), b.ravel().tolist(), strict=True)]
        assert lm.log_kt(a, b).ravel() == pytest.approx(np.array(want), rel=1e-9, abs=near)


def test_words_by_hash():
    data = [low(t) for t in [*some_texts(300, 3), "", " ", "a", " a", "a ", "\x0ba\x0c", "x" * 5000, "ab ba aab aba baa"]]
    raw, sizes = np.frombuffer(b"".join(data), np.uint8), np.array([len(d) for d in data], np.int64)
    want = [(i, w) for i, d in enumerate(data) for w in d.split()]
    keys, owner = lm.word_hashes(raw, sizes)
    assert owner.tolist() == [i for i, _ in want]
    names = dict(zip(keys.tolist(), [w for _, w in want], strict=True))
    assert [names[k] for k in keys.tolist()] == [w for _, w in want] and len(names) == len({w for _, w in want})


def test_nothing_learnt_and_empty(spark):
    assert run(spark, []) == []
    only_held = [(i, t) for i, t in enumerate(some_texts(30)) if zlib.crc32(str(i).encode()) % 7 == 2]
    same(run(spark, only_held), brute(only_held))


def test_long_text_and_other_columns(spark):
    text = " ".join(some_texts(2000, 5))
    df = spark.createDataFrame([(1, text, 3, 4), (2, "the cat", 5, 6)], "doc_id long, text string, score long, `a.b` int")
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(df).collect()]
    same(found, brute([(1, text), (2, "the cat")]))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_predicts_texts_it_has_not_learnt_from(spark):
    rows = lm.score(table(spark, "/root/testdata/sf0.1", "documents")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
