"""Code length of texts: context-tree weighting over bytes, learnt from the whole corpus.

A text is its UTF-8 bytes, A-Z in lower case, and an end. A byte is eight binary decisions; a
decision is seen in the contexts of the 0 to DEPTH bytes before it. Every context keeps how
often each way was taken (Krichevsky-Trofimov), and the estimates of all depths are mixed with
the weights of context-tree weighting: a half for stopping at a context, a half for going on.

How the corpus meets the model:
* Texts are packed in chunks. A chunk lists its distinct grams (a context and the byte after it)
  and its distinct words (64-bit hashes), with their number in the texts that are learnt from.
* Lists go to buckets, grams by the two latest bytes of the context, words by their hash, so
  all deeper contexts of a context share a bucket. A bucket adds up the lists of all chunks.
* Buckets hand the totals of the contexts of one byte upwards: 65,280 rows at most, whatever the
  corpus. The two uppermost depths follow from them and go to all buckets.
* Buckets then answer every list with the log-probability of each gram, or the number of each
  word, and chunks add up the answers by text. No list crosses the driver, and a key that is in
  every text is one entry a chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import texts
from barloom.llm.common import shared_folder

# Bytes of context; a gram of DEPTH + 1 bytes is a number of 48 bits.
DEPTH = 5
# The byte before and after every text; UTF-8 has no such byte.
END = 255
# Bytes of text in a chunk, positions that are sorted at once, and texts among them (15 bits).
CHUNK, PIECE, PIECE_TEXTS = 1 << 24, 1 << 20, 1 << 15
# Buckets, and chunks whose lists one task takes for a bucket.
BUCKETS, LISTS = 512, 1024
HELD = 2, 7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOG10 = np.log(10)


def log_halves(n: np.ndarray) -> np.ndarray:
    """log of Gamma(n + 1/2) / Gamma(1/2), n whole: exact sums up to 64, Stirling's series beyond."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(64) + 0.5))])
    z = np.maximum(n, 64) + 0.5
    big = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return np.where(n <= 64, small[np.minimum(n, 64)], big - 0.5 * np.log(np.pi))


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log-probability that the KT estimator gives any sequence of a zeros and b ones."""
    return log_halves(a) + log_halves(b) - log_factorial(a + b)


def log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 65)))])
    z = np.maximum(n, 64) + 1.0
    big = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return np.where(n <= 64, small[np.minimum(n, 64)], big)


# Grams of a text


def framed(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts with DEPTH ends before and one after each; where a gram ends; the text of each place."""
    n = len(sizes)
    out = np.full(len(raw) + (DEPTH + 1) * n, END, np.uint8)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    out[np.arange(len(raw)) + DEPTH * (owner + 1) + owner] = _LOWER[raw]
    whole = np.repeat(np.arange(n, dtype=np.int32), sizes + DEPTH + 1)
    ends = np.ones(len(out), bool)
    first = np.concatenate([[0], np.cumsum(sizes + DEPTH + 1)[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
    ends[(first[:, None] + np.arange(DEPTH)).ravel()] = False
    return out, ends, whole


def pieces(raw: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Grams of all texts, as (latest byte of the context first, last the byte that follows), and their texts.

    Some PIECE grams at a time, of at most PIECE_TEXTS texts: grams, texts less the first one, first text.
    """
    for i, j in texts.groups(np.concatenate([[0], np.cumsum(sizes)]), PIECE):
        for at in range(i, j, PIECE_TEXTS):
            to = min(j, at + PIECE_TEXTS)
            start, end = int(sizes[:at].sum()), int(sizes[:to].sum())
            data, ends, owner = framed(raw[start:end], sizes[at:to])
            for left in range(DEPTH, len(data), PIECE):  # a long text comes in parts
                right = min(len(data), left + PIECE)
                gram = np.zeros(right - left, np.uint64)
                for back in range(1, DEPTH + 1):
                    gram = (gram << np.uint64(8)) | data[left - back : right - back]
                gram = (gram << np.uint64(8)) | data[left:right]
                good = ends[left:right]
                yield gram[good], owner[left:right][good], at


def total(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def gram_counts(raw: np.ndarray, sizes: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts, in order, and how often each is in a text that is learnt from."""
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for gram, owner, at in pieces(raw, sizes):
        marked = np.sort((gram << np.uint64(1)) | learnt[at + owner].astype(np.uint64))
        gram = marked >> np.uint64(1)
        head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
        held.append((gram[head].astype(np.int64), np.add.reduceat((marked & np.uint64(1)).astype(np.int64), head) if len(head) else np.zeros(0, np.int64)))
        if sum(len(k) for k, _ in held[1:]) > max(PIECE, len(held[0][0])):
            held = [total(*map(np.concatenate, zip(*held, strict=True)))]
    return total(*map(np.concatenate, zip(*held, strict=True)))


class Runs:
    """Grams of the texts, sorted once: distinct ones, and by piece which texts hold them how often."""

    def __init__(self, raw: np.ndarray, sizes: np.ndarray):
        self.n, self.parts = len(sizes), []
        for gram, owner, at in pieces(raw, sizes):
            marked = np.sort((gram << np.uint64(15)) | owner.astype(np.uint64))
            gram, owner = marked >> np.uint64(15), (marked & np.uint64((1 << 15) - 1)).astype(np.uint16)
            head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
            self.parts.append((gram[head].astype(np.int64), np.diff(head, append=len(gram)).astype(np.int32), owner, at))
        self.keys = np.unique(np.concatenate([np.zeros(0, np.int64), *(p[0] for p in self.parts)]))

    def scores(self, logs: np.ndarray) -> np.ndarray:
        """Sum of the logs, which follow the distinct grams, over the grams of each text."""
        out = np.zeros(self.n)
        for keys, times, owner, at in self.parts:
            value = np.repeat(logs[np.searchsorted(self.keys, keys)], times)
            part = np.bincount(owner, weights=value, minlength=1)
            out[at : at + len(part)] += part
        return out


# Words of a text

# A byte's number, and the base of the sums that name words: fixed, odd, otherwise of no meaning.
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, as int64, and the text it is in.

    The hash of a word is a polynomial in the base of the numbers of its bytes, from sums
    along the text that wrap around, mixed with its length.
    """
    keys, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in texts.groups(np.concatenate([[0], np.cumsum(sizes)]), PIECE):
        start = int(sizes[:i].sum())
        part = raw[start : start + int(sizes[i:j].sum())]
        # A gap after each text, so that no word runs on.
        inside = np.zeros(len(part) + (j - i) + 1, bool)
        owner = np.repeat(np.arange(j - i, dtype=np.int64), sizes[i:j])
        at = np.arange(len(part)) + owner + 1
        inside[at] = ~_GAP[part]
        value = np.zeros(len(inside), np.uint64)
        value[at] = _BYTES[part]
        value *= _powers(_BASE, len(value))
        value = np.cumsum(value)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edge[::2], edge[1::2]  # the place before the word, and its last one
        whole = np.repeat(np.arange(i, j, dtype=np.int64), sizes[i:j] + 1)
        h = (value[last] - value[first]) * _powers(_BACK, len(value))[first]
        h ^= (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        keys.append((h ^ (h >> np.uint64(29))).view(np.int64))
        owners.append(whole[first])
    return np.concatenate(keys), np.concatenate(owners)


# The tree


def _nodes(keys: np.ndarray, counts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Decision `level` of the last byte of each key: distinct (context, bits before), zeros, ones, node of each key."""
    node = (keys >> 8 << level) | ((keys & 255) >> (8 - level))
    found, which = np.unique(node, return_inverse=True)
    one = (keys >> (7 - level)) & 1
    b = np.bincount(which, weights=counts * one, minlength=len(found)).astype(np.int64)
    a = np.bincount(which, weights=counts * (1 - one), minlength=len(found)).astype(np.int64)
    return found, a, b, which


def _shorter(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams without the oldest byte of a context of `depth` bytes, their counts, and the new place of each gram."""
    found, which = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
    return found, np.bincount(which, weights=counts, minlength=len(found)).astype(np.int64), which


def bottom_up(keys: np.ndarray, counts: np.ndarray, level: int, depth: int, top: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Weighted probabilities of a decision in the contexts of `depth` to `top` bytes.

    Returns for each depth from the deepest on (probability of a one, weight of stopping, whether
    seen, node of each gram, gram of each gram one depth further), then for the nodes of the next
    depth above, named by context and bits, the sum of the logs of their children.
    """
    steps, below = [], None
    for d in range(depth, top - 1, -1):
        node, a, b, which = _nodes(keys, counts, level)
        stop = log_kt(a, b)
        if below is None:
            weighted, weight = stop, np.ones(len(node))
        else:
            names, logs = below
            inner = np.bincount(np.searchsorted(node, names), weights=logs, minlength=len(node))
            weighted = np.logaddexp(stop, inner) + np.log(0.5)
            weight = np.exp(np.log(0.5) + stop - weighted)
        p_one = (b + 0.5) / (a + b + 1)
        bits = (1 << level) - 1
        up, back = np.unique((node >> level >> 8 << level) | (node & bits), return_inverse=True)
        below = up, np.bincount(back, weights=weighted, minlength=len(up))
        if d > 0:
            shorter, sums, place = _shorter(keys, counts, d)
        else:
            shorter, sums, place = keys, counts, None
        steps.append((p_one, weight, a + b > 0, which, place))
        keys, counts = shorter, sums
    return steps, *below


class Top:
    """Contexts of no byte and of one: by context and decision the probability of a one and the weight of stopping."""

    def __init__(self, rows: list[tuple[int, int, int, int, float]]):
        """Rows: context of one byte, decision (1 to 255), zeros, ones, sum of the logs below."""
        a, b, logs = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64), np.zeros((256, 256))
        for c, node, zeros, ones, below in rows:
            a[c, node], b[c, node], logs[c, node] = zeros, ones, below
        stop = log_kt(a, b)
        weighted = np.logaddexp(stop, logs) + np.log(0.5)
        self.weight = [None, np.exp(np.log(0.5) + stop - weighted)]
        self.p_one, self.seen = [None, (b + 0.5) / (a + b + 1)], [None, a + b > 0]
        a, b, logs = a.sum(axis=0), b.sum(axis=0), weighted.sum(axis=0)
        stop = log_kt(a, b)
        self.weight[0] = np.exp(np.log(0.5) + stop - np.logaddexp(stop, logs) - np.log(0.5))
        self.p_one[0], self.seen[0] = (b + 0.5) / (a + b + 1), a + b > 0


def gram_logs(keys: np.ndarray, counts: np.ndarray, top: Top) -> np.ndarray:
    """log10 of the probability of the last byte of each gram after its context.

    The mixture runs from no context to the deepest that training saw; what weight is left
    there goes to that context's estimate.
    """
    out = np.zeros(len(keys))
    latest, byte = keys >> (8 * DEPTH), keys & 255
    for level in range(8):
        one = (byte >> (7 - level)) & 1
        decision = (1 << level) | (byte >> (8 - level))
        p, rest, last = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5)
        layers = [(top.p_one[0][decision], top.weight[0][decision], top.seen[0][decision])]
        layers.append((top.p_one[1][latest, decision], top.weight[1][latest, decision], top.seen[1][latest, decision]))
        steps = bottom_up(keys, counts, level, DEPTH, 2)[0]
        place, deep = np.arange(len(keys)), []
        for p_one, weight, seen, which, further in steps:
            node = which[place]
            deep.append((p_one[node], weight[node], seen[node]))
            place = further[place] if further is not None else place
        for p_one, weight, seen in layers + deep[::-1]:
            share = np.where(one == 1, p_one, 1 - p_one)
            last = np.where(seen, share, last)
            used = np.where(seen, rest * weight, 0)
            p += used * share
            rest -= used
        out += np.log(p + rest * last)
    return out / _LOG10


def one_byte_sums(keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Per context of one byte and decision: zeros, ones, and the sum of the logs of the contexts of two bytes."""
    parts = []
    for level in range(8):
        _, names, logs = bottom_up(keys, counts, level, DEPTH, 2)
        short = ((keys >> (8 * DEPTH)) << 8) | (keys & 255)
        short, which = np.unique(short, return_inverse=True)
        node, a, b, _ = _nodes(short, np.bincount(which, weights=counts, minlength=len(short)).astype(np.int64), level)
        parts.append((node >> level, (1 << level) | (node & ((1 << level) - 1)), a, b, logs[np.searchsorted(names, node)]))
    return dict(zip(("context", "decision", "zeros", "ones", "logs"), map(np.concatenate, zip(*parts, strict=True)), strict=True))


# Lists of keys in order, as bytes: their differences


def _pack(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=0).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


def chunks(df: DataFrame, id_col: str, text_col: str, held: tuple[int, int]) -> DataFrame:
    """Texts in chunks of about CHUNK bytes, as they lie: chunk, ids, valid, learnt, sizes, data (A-Z in lower case).

    The data are compressed, so that a batch of chunks stays small in the JVM and in Python.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        held_out(id_col, held).alias("held"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts, size = [], 0

        def packed() -> pa.RecordBatch:
            ids = pa.concat_arrays([p[0] for p in parts])
            learnt, sizes, raw = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([number], pa.int64()),
                    "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()],
                    "valid": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
                    "learnt": [learnt.tobytes()],
                    "sizes": [sizes.tobytes()],
                    "data": [pa.compress(raw.tobytes(), codec="zstd", asbytes=True)],
                }
            )

        for batch in batches:
            raw, offsets = texts.flat(batch["text"])
            learnt = ~batch["held"].to_numpy(zero_copy_only=False)
            for i, j in texts.groups(offsets, CHUNK):
                part = _LOWER[raw[offsets[i] : offsets[j]]]
                if parts and size + len(part) > CHUNK:
                    yield packed()
                    parts, size, number = [], 0, number + 1
                parts.append((batch["id"].slice(i, j - i), learnt[i:j], np.diff(offsets[i : j + 1]), part))
                size += len(part) + 16 * (j - i)
        if parts:
            yield packed()

    found = rows.mapInArrow(work, "chunk long, ids binary, valid binary, learnt binary, sizes binary, data binary")
    return _stored(found)


def _stored(df: DataFrame) -> DataFrame:
    """The rows, as a compressed table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other: a row may be some megabytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


class Chunk:
    def __init__(self, row: dict):
        self.ids, self.valid = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["valid"], bool)
        self.learnt, self.sizes = np.frombuffer(row["learnt"], bool), np.frombuffer(row["sizes"], np.int64)
        size = int(self.sizes.sum())
        data = pa.decompress(row["data"], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        self.raw = np.frombuffer(data, np.uint8)


def gram_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the two latest bytes of the context."""
    mixed = (keys >> (8 * (DEPTH - 1))).astype(np.uint32) * np.uint32(2654435761)
    return ((mixed >> np.uint32(8)) % np.uint32(buckets)).astype(np.int64)


def word_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return keys % buckets


def _by_bucket(where: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets that keys go to, and the places of these keys, in order."""
    where = where.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(where, kind="stable")
    edges = np.searchsorted(where[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def _lists(chunk: Chunk, buckets: int) -> Iterator[tuple[bool, int, np.ndarray, np.ndarray]]:
    keys, counts = gram_counts(chunk.raw, chunk.sizes, chunk.learnt)
    for b, mine in _by_bucket(gram_buckets(keys, buckets), buckets):
        yield True, b, keys[mine], counts[mine]
    words, owner = word_hashes(chunk.raw, chunk.sizes)
    keys, counts = total(words, chunk.learnt[owner].astype(np.int64))
    for b, mine in _by_bucket(word_buckets(keys, buckets), buckets):
        yield False, b, keys[mine], counts[mine]


ASKED = "is_gram boolean, bucket int, salt int, chunk long, key_list binary, counts binary"


def lists(packed: DataFrame, salts: int, buckets: int) -> DataFrame:
    """What every chunk asks every bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            out = [(g, b, _pack(k), c.astype(np.int32).tobytes()) for g, b, k, c in _lists(Chunk(row), buckets)]
            n = row["chunk"]
            yield pa.RecordBatch.from_pydict(
                {
                    "is_gram": pa.array([o[0] for o in out], pa.bool_()),
                    "bucket": pa.array([o[1] for o in out], pa.int32()),
                    "salt": pa.array([crc32(b"%d" % n) % salts] * len(out), pa.int32()),
                    "chunk": pa.array([n] * len(out), pa.int64()),
                    "key_list": pa.array([o[2] for o in out], pa.binary()),
                    "counts": pa.array([o[3] for o in out], pa.binary()),
                }
            )

    return _stored(packed.mapInArrow(work, ASKED))


def _in_order(rows: DataFrame, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, *then)


def _merged(rows: DataFrame, keys: tuple[str, ...], wide: bool) -> DataFrame:
    """Lists that agree in `keys` added up. Counts come as int64 if `wide`, and leave so."""
    names = list(keys)
    kind = np.int64 if wide else np.int32

    def result(at: tuple, lists: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        found, counts = total(*map(np.concatenate, zip(*lists, strict=True)))
        return pa.RecordBatch.from_pydict(
            {n: pa.array([v], pa.bool_() if n == "is_gram" else pa.int32()) for n, v in zip(names, at, strict=True)}
            | {"key_list": pa.array([_pack(found)], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())}
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, waiting = None, [], 0  # the first of the lists held is a sum, `waiting` keys are in the others
        for row in _rows(batches):
            here = tuple(row[n] for n in names)
            if here != at:
                if at is not None:
                    yield result(at, held)
                at, held, waiting = here, [], 0
            found = _unpack(row["key_list"])
            held.append((found, np.frombuffer(row["counts"], kind).astype(np.int64)))
            waiting += len(found)
            if waiting > max(1 << 18, 2 * len(held[0][0])):
                held, waiting = [total(*map(np.concatenate, zip(*held, strict=True)))], 0
        if at is not None:
            yield result(at, held)

    types = ", ".join(f"{n} {'boolean' if n == 'is_gram' else 'int'}" for n in names)
    placed = _in_order(rows.select(*names, "key_list", "counts"), *names)
    return placed.mapInArrow(work, f"{types}, key_list binary, counts binary")


def learn(asked: DataFrame, salts: int) -> DataFrame:
    """All keys of every bucket and their counts. With many chunks, groups of them are added up first."""
    if salts > 1:
        asked = _merged(asked, ("is_gram", "bucket", "salt"), False)
    return _stored(_merged(asked, ("is_gram", "bucket"), salts > 1))


def upper(model: DataFrame) -> Top:
    """The depths of no byte and of one, from sums of all buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = one_byte_sums(_unpack(row["key_list"]), np.frombuffer(row["counts"], np.int64))
                yield pa.RecordBatch.from_pydict(found)

    parts = model.where("is_gram").select("key_list", "counts").mapInArrow(work, "context long, decision long, zeros long, ones long, logs double")
    # Decimals, so that the sum of the logs does not depend on the order of the tasks.
    sums = parts.groupBy("context", "decision").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(F.col("logs").cast("decimal(38,9)")).cast("double").alias("logs")
    )
    return Top([tuple(r) for r in sums.collect()])  # 65,280 rows at most


def word_totals(model: DataFrame) -> tuple[int, int]:
    """Number of words in the texts that are learnt from, and of distinct ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = v = 0
        for batch in batches:
            for data in batch["counts"]:
                counts = np.frombuffer(data.as_py(), np.int64)
                n, v = n + int(counts.sum()), v + int(np.count_nonzero(counts))
        yield pa.RecordBatch.from_pydict({"n": [n], "v": [v]})

    found = model.where("NOT is_gram").select("counts").mapInArrow(work, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return found[0] or 0, found[1] or 0


def _bucket_logs(keys: np.ndarray, counts: np.ndarray, top: Top, some: int = 1 << 19) -> np.ndarray:
    """gram_logs of a bucket, for about `some` keys at a time; what shares two bytes of context stays together."""
    pairs, out, at = keys >> (8 * (DEPTH - 1)), [np.zeros(0)], 0
    while at < len(keys):
        to = min(len(keys), at + some)
        if to < len(keys):
            low = int(np.searchsorted(pairs, pairs[to], side="left"))
            to = low if low > at else int(np.searchsorted(pairs, pairs[to], side="right"))
        out.append(gram_logs(keys[at:to], counts[at:to], top))
        at = to
    return np.concatenate(out)


def answers(model: DataFrame, asked: DataFrame, top: Top, salts: int) -> DataFrame:
    """To every list its values: logs of grams, numbers of words. The model of a bucket comes first in its task."""
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    rows = model.select("is_gram", "bucket", everywhere, F.lit(-1).cast("long").alias("chunk"), "key_list", "counts")
    rows = rows.unionByName(asked.select("is_gram", "bucket", "salt", "chunk", "key_list", F.lit(b"").alias("counts")))
    held_top = model.sparkSession.sparkContext.broadcast(top)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["chunk"] < 0:
                    keys, counts = _unpack(row["key_list"]), np.frombuffer(row["counts"], np.int64)
                    values = _bucket_logs(keys, counts, held_top.value) if row["is_gram"] else counts
                else:
                    value = values[np.searchsorted(keys, _unpack(row["key_list"]))]
                    out.append((row["is_gram"], row["bucket"], row["chunk"], value.tobytes()))
            if out:
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([o[2] for o in out], pa.int64()),
                        "is_gram": pa.array([o[0] for o in out], pa.bool_()),
                        "bucket": pa.array([o[1] for o in out], pa.int32()),
                        "vals": pa.array([o[3] for o in out], pa.binary()),
                    }
                )

    placed = _in_order(rows, "is_gram", "bucket", "salt", then=("chunk",))
    return placed.mapInArrow(work, "chunk long, is_gram boolean, bucket int, vals binary")


def held_out(id_col: str, held: tuple[int, int] = HELD):
    """Rows that are not learnt from: crc32 of the id as text leaves held[0] when divided by held[1]."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % held[1] == held[0], F.lit(False))


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: tuple[int, int] = HELD, buckets: int = BUCKETS) -> DataFrame:
    """Every row: id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    `score` is log10 of the model's probability of the text's bytes (A-Z in lower case) and its
    end; bits_per_byte the code length, the end counted as a byte. `base_score` is that of the
    tokens, words and an end, each by its share in training with one added; words are told apart by hashes of 64 bits. Training takes every
    row whose checksum of the id does not leave `held`; rows without an id are learnt from.

    A null text is empty: its only token is the end. Rows that repeat each count and are each
    scored. If nothing is learnt from, every decision has probability 1/2, and V is 0.
    Texts are read whole, of any length. An empty table gives no rows. Other columns are not read.
    """
    packed = chunks(df, id_col, text_col, held)
    n_chunks = packed.count()
    salts = max(1, -(-n_chunks // LISTS))
    asked = lists(packed, salts, buckets)
    model = learn(asked, salts)
    top, (n, v) = upper(model), word_totals(model)

    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sum(int(np.frombuffer(d.as_py(), bool).sum()) for b in batches for d in b["learnt"])
        yield pa.RecordBatch.from_pydict({"n": [found]})

    ends = packed.select("learnt").mapInArrow(tallies, "n long").agg(F.sum("n")).first()[0] or 0
    n, v = n + ends, v + (ends > 0)
    given = answers(model, asked, top, salts)
    blank = F.lit(b"")
    rows = given.select("chunk", F.lit(0).alias("part"), "is_gram", "bucket", "vals", *(blank.alias(c) for c in ("ids", "valid", "learnt", "sizes", "data")))
    rows = rows.unionByName(
        packed.select("chunk", F.lit(1).alias("part"), F.lit(False).alias("is_gram"), F.lit(0).alias("bucket"), blank.alias("vals"), "ids", "valid", "learnt", "sizes", "data")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_values: dict[tuple[bool, int], bytes] = {}
        for row in _rows(batches):
            if not row["part"]:
                held_values[row["is_gram"], row["bucket"]] = row["vals"]
            else:
                chunk = Chunk(row)
                logs = _gram_values(chunk, held_values, buckets)
                n_tokens, n_known, base = _word_scores(chunk, held_values, buckets, n, v, ends)
                held_values = {}
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: pa.array(chunk.ids, mask=~chunk.valid),
                        "held_out": ~chunk.learnt,
                        "n_bytes": chunk.sizes,
                        "n_tokens": n_tokens,
                        "n_known": n_known,
                        "train_tokens": np.full(len(chunk.ids), n, np.int64),
                        "base_score": base,
                        "score": logs,
                        "bits_per_byte": -logs * np.log2(10) / (chunk.sizes + 1),
                    }
                )

    schema = f"`{id_col}` long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return _in_order(rows, "chunk", then=("part",)).mapInArrow(work, schema)


def _gram_values(chunk: Chunk, values: dict, buckets: int) -> np.ndarray:
    """Scores of the chunk's texts from the answers, which follow the order of its lists."""
    runs = Runs(chunk.raw, chunk.sizes)
    logs = np.zeros(len(runs.keys))
    for b, mine in _by_bucket(gram_buckets(runs.keys, buckets), buckets):
        logs[mine] = np.frombuffer(values[True, b], float)
    return runs.scores(logs)


def _word_scores(chunk: Chunk, values: dict, buckets: int, n: int, v: int, ends: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, known tokens and base score of each text."""
    words, owner = word_hashes(chunk.raw, chunk.sizes)
    keys, which = np.unique(words, return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    for b, mine in _by_bucket(word_buckets(keys, buckets), buckets):
        counts[mine] = np.frombuffer(values[False, b], np.int64)
    logs = np.log10((np.append(counts, ends) + 1) / (n + v + 1))
    size = len(chunk.sizes)
    tokens = np.bincount(owner, minlength=size) + 1
    known = np.bincount(owner, weights=(counts > 0)[which], minlength=size).astype(np.int64) + (ends > 0)
    return tokens, known, np.bincount(owner, weights=logs[which], minlength=size) + logs[-1]
