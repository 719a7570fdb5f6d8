from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from barloom.llm import toxicity

BAD = ["grumblex", "snorkvile", "blatherik", "zounderous"]


def misspelt(rng, word):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i] + word[i:], word + "s", word[:i] + "q" + word[i + 1 :]])


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "re", "ti", "mo", "lu", "se", "na"]) for _ in range(rng.randint(1, 4))) for _ in range(500)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD).upper() + rng.choice(["", ".", ","])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_held_out_accuracy(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == (got[i].score >= 0.3)
    right = [got[i].predicted == toxic for i, _, toxic in rows if got[i].held_out]
    assert len(right) > 150 and np.mean(right) > 0.98


def test_unseen_misspellings(rows):
    model = toxicity.train([(t, y) for _, t, y in rows])
    rng = random.Random(4)

    def logit(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return toxicity.doc_logits(data, np.array([0, len(data)]), model)[0]

    spelt = [logit("ba re " + misspelt(rng, rng.choice(BAD)) + " ti " + misspelt(rng, rng.choice(BAD))) for _ in range(50)]
    plain = [logit(t) for _, t, y in rows[:50] if not y]
    assert np.median(spelt) > max(plain)


@pytest.mark.parametrize("n", [60, 999, 1001])
def test_words_of_one_text_are_not_trained_on_at_any_size(n):
    rows = corpus(n, seed=n)
    single = [(t + f" lonely{i}xyz qqwzx{i}kk" * 2, y) for i, t, y in rows]
    plain = toxicity.train([(t, y) for _, t, y in rows])
    assert np.array_equal(toxicity.train(single).gains, plain.gains)
    assert plain.gains.any()


def test_nothing_but_words_of_one_text():
    model = toxicity.train([("alpha beta", 1), ("gamma delta", 0), (None, 0), ("", 0)])
    assert not model.gains.any() and model.intercept == pytest.approx(np.log(1 / 3))


def test_score_does_not_depend_on_neighbours(rows):
    model = toxicity.train([(t, y) for _, t, y in rows[:200]])
    texts = [t for _, t, _ in rows[:20]] + ["", "?!", "é" * 3, "x" * 3_000_000 + " grumblex snorkvile"]
    raw = [t.encode() for t in texts]
    at = np.r_[0, np.cumsum([len(r) for r in raw])]
    together = toxicity.doc_logits(np.frombuffer(b"".join(raw), np.uint8), at, model)
    alone = [toxicity.doc_logits(np.frombuffer(r, np.uint8), np.array([0, len(r)]), model)[0] for r in raw]
    assert together == pytest.approx(alone) and together[-1] > together[-2]


def test_odd_input(spark, rows):
    docs = spark.createDataFrame(
        [(None, None, 1), (1, "", 2), (1, "...", 3), (2, "ba re grumblex snorkvile", 4), (2, "ba re grumblex snorkvile", 4)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (1, 0)], "doc_id long, toxic int")
    assert toxicity.judge(docs, labels).count() == 5  # labels of one kind only
    assert toxicity.judge(docs.limit(0), labels.limit(0)).count() == 0
    model = toxicity.train([(t, y) for _, t, y in rows])
    got = toxicity.score(docs, model, into="other")
    assert got.columns == [*docs.columns, "other"]
    scores = [r.other for r in got.orderBy("score").collect()]
    assert scores[0] == scores[1] == scores[2] < 0.3 < 0.9 < scores[3] == scores[4]
