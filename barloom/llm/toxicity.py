"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import texts

# Labelled rows that training takes at most, and characters of each of them at most.
SAMPLE, SAMPLE_CHARS = 8_000, 50_000
# Buckets of hashed n-grams, their lengths in bytes, and the size of an embedding.
BUCKETS, GRAMS, SIZE = 1 << 18, (3, 4, 5, 6), 8
THRESHOLD = 0.3
# Texts of the common share that a word's own share of toxic texts is mixed with.
SHRINK = 20

# Bytes to bytes: A-Z to lower case, other ASCII that is neither letter nor digit to a boundary.
BOUNDARY = 32
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = BOUNDARY
for _a, _b, _to in ((48, 58, 48), (97, 123, 97), (65, 91, 97)):
    _FOLD[_a:_b] = np.arange(_to, _to + _b - _a)


class Model(NamedTuple):
    gains: np.ndarray  # per bucket: what its embedding adds to the difference of the two logits
    center: np.ndarray
    slopes: np.ndarray
    intercept: float


def grams(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-gram: buckets by position, and whether an n-gram begins there.

    `raw` are folded bytes that begin and end with a boundary. An n-gram lies in a word
    and the boundary byte before and after it.
    """
    n = len(raw)
    inside = raw != BOUNDARY
    code = raw.astype(np.uint32)
    h = code.copy()
    good = np.ones(n, bool)
    good[-1] = False
    for length in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint32(16777619) ^ code[length - 1 :] if length <= n else h[:0]
        if length > 2:
            good = good[:-1] & inside[length - 2 : n - 1]
        else:
            good = good[:-1]
        if length in GRAMS:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519 + 2 * length)
            yield (mixed >> np.uint32(14)).astype(np.int32), good


def word_starts(raw: np.ndarray) -> np.ndarray:
    inside = raw != BOUNDARY
    return np.flatnonzero(inside[1:] & ~inside[:-1]) + 1


def word_logits(raw: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and logit of each word: the mean gain of its n-grams."""
    starts = word_starts(raw)
    if not len(starts):
        return starts, np.zeros(0)
    total, count = np.zeros(len(raw)), np.zeros(len(raw))
    for buckets, good in grams(raw):
        total[: len(good)] += np.where(good, gains[buckets], 0)
        count[: len(good)] += good
    at = starts - 1
    return starts, np.add.reduceat(total, at) / np.add.reduceat(count, at)


def _ranges(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of the bytes, cut between words; a word longer than a part is cut itself."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + texts.CHUNK)
        if end < len(raw):
            gap = np.flatnonzero(raw[max(at, end - 65536) : end] == BOUNDARY)
            end = max(at, end - 65536) + int(gap[-1]) + 1 if len(gap) else end
        yield at, end
        at = end


def doc_features(raw: np.ndarray, offsets: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Per text the logits of its two most toxic words; of one word twice that, of none NaN."""
    n = len(offsets) - 1
    top = np.full((n, 2), -np.inf)
    # Texts are divided by a boundary byte.
    spread = np.full(len(raw) + n + 1, BOUNDARY, np.uint8)
    spread[np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _FOLD[raw]
    first = offsets[:-1] + np.arange(1, n + 1)
    for at, end in _ranges(spread):
        part = np.concatenate([[np.uint8(BOUNDARY)], spread[at:end], [np.uint8(BOUNDARY)]])
        starts, logits = word_logits(part, gains)
        if not len(starts):
            continue
        doc = np.searchsorted(first, starts - 1 + at, side="right") - 1
        head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        best = np.maximum.reduceat(logits, head)
        size = np.diff(np.r_[head, len(doc)])
        is_best = np.flatnonzero(logits == np.repeat(best, size))
        once = is_best[np.r_[True, doc[is_best][1:] != doc[is_best][:-1]]]
        logits[once] = -np.inf
        second = np.maximum.reduceat(logits, head)
        both = np.sort(np.c_[top[doc[head]], best, second], axis=1)
        top[doc[head]] = both[:, :-3:-1]
    top[:, 1] = np.where(np.isfinite(top[:, 1]), top[:, 1], top[:, 0])
    return np.where(np.isfinite(top), top, np.nan)


def doc_logits(raw: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Per text its logit; a text without words has the plain intercept."""
    return np.nan_to_num(doc_features(raw, offsets, model.gains) - model.center) @ model.slopes + model.intercept


def train(rows: list[tuple[str, int]], steps: int = 60, rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> Model:
    """Embeddings and softmax together, by gradient steps on words, then slope and intercept on texts.

    A word is a bag of n-grams, its embedding their mean. Words take the share of toxic
    texts among those that hold them, drawn to the common share where these are few, and
    weigh as the root of their number. Words of a single text are not trained on, however
    many texts there are; without others every text gets the same score. The logit of a text is a logistic fit to those of
    its two most toxic words, on the same rows.
    """

    def words_in(text: str | None) -> set[bytes]:
        return set(_FOLD[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split())

    labels = np.array([label for _, label in rows], float)
    # Words are counted by their hashes; only those that are kept are held as bytes.
    hashes = [np.fromiter(map(hash, words_in(text)), np.int64) for text, _ in rows]
    share = min(max(labels.mean() if len(labels) else 0.0, 0.01), 0.99)
    plain = Model(np.zeros(BUCKETS, np.float32), np.zeros(2), np.zeros(2), float(np.log(share / (1 - share))))
    if not sum(map(len, hashes)) or labels.min(initial=1) == labels.max(initial=0):
        return plain

    size = [len(h) for h in hashes]
    number, owner = np.unique(np.concatenate(hashes), return_inverse=True)
    del hashes
    n = np.bincount(owner).astype(float)
    toxic = np.bincount(owner, weights=np.repeat(labels, size))
    # A word of one text says no more than the label of that text.
    common = n >= 2
    if not common.any():
        return plain
    prior = labels.mean()
    n, toxic = n[common], toxic[common]
    share = (toxic + SHRINK * prior) / (n + SHRINK)
    place = {h: i for i, h in enumerate(number[common].tolist())}
    del number, owner
    names = [b""] * len(place)
    for text, _ in rows:
        for word in words_in(text):
            if (i := place.get(hash(word))) is not None:
                names[i] = word
    del place
    order = sorted(range(len(names)), key=names.__getitem__)  # hashes differ between processes
    names, n, share = [names[i] for i in order], n[order], share[order]

    raw = np.frombuffer(b" " + b" ".join(names) + b" ", np.uint8)
    starts = word_starts(raw)
    word_at = (np.cumsum(np.bincount(starts - 1, minlength=len(raw))) - 1).astype(np.int32)
    buckets, words = [], []
    for b, good in grams(raw):
        buckets.append(b[good])
        words.append(word_at[: len(good)][good])
    buckets, words = np.concatenate(buckets), np.concatenate(words)
    count = np.bincount(words, minlength=len(names)).astype(float)

    rng = np.random.default_rng(seed)
    used = np.flatnonzero(np.bincount(buckets, minlength=BUCKETS))
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    slot = place[buckets]
    del buckets, raw, word_at
    emb = rng.standard_normal((len(used), SIZE)) / SIZE
    soft = rng.standard_normal(SIZE) / SIZE  # difference of the two rows of the softmax
    bias = np.log(prior / (1 - prior))
    weight = np.sqrt(n)
    weight /= weight.sum()
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emb, soft)]
    for step in range(1, steps + 1):
        logit = np.bincount(words, weights=(emb @ soft)[slot], minlength=len(names)) / count + bias
        error = weight * (1 / (1 + np.exp(-logit)) - share) * len(names)
        per_gram = np.bincount(slot, weights=(error / count)[words], minlength=len(used))
        grads = (per_gram[:, None] * soft + decay * emb, emb.T @ per_gram / len(names))
        for p, g, (m, v) in zip((emb, soft), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    gains = np.zeros(BUCKETS, np.float32)
    gains[used] = emb @ soft
    seen = []
    for text, _ in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        seen.append(doc_features(data, np.array([0, len(data)]), gains)[0])
    return Model(gains, *_logistic(np.array(seen), labels))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Center, slopes and intercept by Newton steps with a small penalty; no slope is negative."""
    center = np.nanmean(x, axis=0)
    spread = np.nanstd(x, axis=0) + 1e-9
    z = np.nan_to_num((x - center) / spread)
    free = np.ones(z.shape[1], bool)
    while True:
        zz = np.c_[z[:, free], np.ones(len(z))]
        w = np.zeros(zz.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(zz @ w, -30, 30)))
            w -= np.linalg.solve((zz * (p * (1 - p))[:, None]).T @ zz + 0.1 * np.eye(len(w)), zz.T @ (p - y) + 0.1 * w)
        if (w[:-1] >= 0).all():
            break
        free[np.flatnonzero(free)[w[:-1] < 0]] = False
    slopes = np.zeros(z.shape[1])
    slopes[free] = w[:-1]
    return center, slopes / spread, float(w[-1])


def held_out(id_col: str):
    """Rows that training leaves out: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most `sample` labelled rows that are not held out, chosen by a hash of the id.

    Rows without an id, a label of 0 or 1, or a text of at most SAMPLE_CHARS characters
    are not trained on. Where ids repeat, at most `2 * sample` rows are, in the order of id
    and text. Without labels of both kinds every text gets the same score.
    """
    wanted = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    wanted = wanted.groupBy(id_col).agg(F.max(label_col).alias("label")).withColumnRenamed(id_col, "id")
    wanted = wanted.orderBy(F.xxhash64("id"), "id").limit(sample)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    rows = found.join(F.broadcast(wanted), "id").orderBy("id", "text").limit(2 * sample).collect()
    return train([(r["text"], int(r["label"])) for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """All rows and columns, and the score of the whole text, from 0 to 1, as the last column.

    A null or empty text, or one without a letter or digit, gets the score of no words.
    A word of over a megabyte is scored in parts. A column of the name `into` is replaced.
    The model is one number for each of BUCKETS buckets, so its size is fixed.
    """
    docs = docs.drop(into)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts.flat(batch.column(place))
            logits = [np.zeros(0)]
            for i, j in texts.groups(offsets):
                part = raw[offsets[i] : offsets[j]]
                logits.append(doc_logits(part, offsets[i : j + 1] - offsets[i], held.value))
            values = 1 / (1 + np.exp(-np.clip(np.concatenate(logits), -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, into])

    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])
    return docs.mapInArrow(work, schema)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted (1 from THRESHOLD on) of every row."""
    model = fit(docs, labels, id_col, text_col)
    scored = score(docs.select(id_col, text_col), model, text_col)
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose score is below THRESHOLD."""
    scored = score(docs, fit(docs, labels, id_col, text_col), text_col, "_toxicity_")
    return scored.where(F.col("_toxicity_") < THRESHOLD).drop("_toxicity_")
