"""Removal of repeated passages by a depth-limited radix sort of suffixes.

A window of LENGTH bytes is repeated if its suffix equals another suffix in the first LENGTH
bytes. Suffixes are ordered only so far, digit by digit from the front, and those that
are alone leave at once:

1. The first digit is an anchor: of the GRAM-byte strings of a window the one with the
   least hash. Equal windows have the same anchor at the same place, so windows with one
   anchor stand for themselves, and an anchor's windows are neighbours. Anchors that
   occur once are dropped with all their windows.
2. Occurrences whose windows together cover equal bytes are repeated as a whole; this
   settles the inner part of a repeated passage.
3. For the others the bytes around the anchor are fetched, one occurrence for each
   different surrounding, and their windows pass through digits of DIGITS bytes, until
   they are alone or equal to the full depth. An anchor with more than MANY surroundings
   sends a hash of each window in place of bytes, and one of those that a task has seen
   to be equal, so its windows are spread and what they share meets in few rows.
4. Runs of bytes that repeated windows cover are removed from their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import texts
from barloom.llm.common import cut, shuffle_partitions, sieve
from barloom.llm.shingles import mix

LENGTH = 200
GRAM = 32
DIGITS = (8, 24, 56, 112)
# Surroundings of one anchor beyond which its windows are sent one by one.
MANY = 4096
# Windows that one pass sorts, about, and records that a task holds.
HELD = 1 << 20

_U = np.uint64
_BASE = 0x9E6C63D0876A3F35
_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_PLACE_BITS = 21

_RECORD = np.dtype([("g", "<u8"), ("f", "<u8"), ("t", "<i8"), ("n", "<u4"), ("a", "<u4"), ("lo", "u1"), ("hi", "u1")])
# One window: anchor, hash of its bytes, text, place of the anchor and distance from it.
_WINDOW = np.dtype([("g", "<u8"), ("w", "<u8"), ("t", "<i8"), ("n", "<u4"), ("a", "<u4"), ("far", "u1"), ("ask", "u1")])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        have = _TABLES[k]
        while len(have) < n:
            have = np.r_[have, have * _U(pow(base, len(have), 1 << 64))]
        _TABLES[k] = have
    return _TABLES[0], _TABLES[1]


class Hasher:
    """Hashes of any ranges of some bytes, from running sums."""

    def __init__(self, raw: np.ndarray) -> None:
        up, self.down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + _U(1)) * up[: len(raw)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of `width` values, by minima from the borders of blocks."""
    n = len(key) - width + 1
    padded = np.pad(key, (0, -len(key) % width), constant_values=np.iinfo(np.uint64).max).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of texts in one array, at most 2^21 bytes: anchor, first and last window, text, hashes of both.

    begin and end are the texts' borders in raw, in order and without overlap.
    """
    gram = min(GRAM, length)
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    hashed = Hasher(raw)
    n = len(raw) - gram + 1
    h = mix((hashed.sums[gram:] - hashed.sums[:-gram]) * hashed.down[:n])
    mask = _U((1 << _PLACE_BITS) - 1)
    key = (h & ~mask) | (mask - np.arange(n, dtype=np.uint64))  # of equal ones the last
    least = _sliding_least(key, length - gram + 1)
    place = (mask - (least & mask)).astype(np.int64)
    size = np.maximum(end - begin - length + 1, 0)
    shift = np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size)
    window = np.arange(int(size.sum())) + shift
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    place = place[window]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)])
    last = np.r_[first[1:], len(window)] - 1
    a, low, high = place[first], window[first], window[last]
    around = mix(hashed(low, high + length) ^ ((a - low) * 65536 + (a - high)).astype(np.uint64))
    return a, low, high, np.repeat(np.arange(len(size)), size)[first], h[a], around


def _ranges(raw: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]:
    """Bytes, borders of the texts in them, first text, and where in it they begin."""
    for i, j in texts.groups(offsets):
        if j > i + 1 or offsets[j] - offsets[i] <= texts.CHUNK:
            yield raw[offsets[i] : offsets[j]], offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i], i, 0
            continue
        for at in range(0, int(offsets[j] - offsets[i]), texts.CHUNK):
            part = raw[offsets[i] + at : min(offsets[j], offsets[i] + at + texts.CHUNK + length - 1)]
            yield part, np.array([0]), np.array([len(part)]), i, at


def _records(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """bucket and packed records of the anchors of all texts (t, n, text)."""

    def parcels(held: list[np.ndarray]) -> pa.RecordBatch:
        found = np.concatenate(held)
        held.clear()
        bucket = (found["g"] % _U(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        found, bucket = found[by], bucket[by]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        data = [found[a:b].tobytes() for a, b in zip(first, np.r_[first[1:], len(found)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(data, pa.binary())], ["bucket", "records"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            t, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            raw, offsets = texts.flat(batch.column(2))
            for part, begin, end, i, base in _ranges(raw, offsets, length):
                a, low, high, doc, g, around = anchors(part, begin, end, length)
                out = np.empty(len(a), _RECORD)
                out["g"], out["f"], out["t"], out["n"] = g, around, t[i + doc], n[i + doc]
                out["a"], out["lo"], out["hi"] = a - begin[doc] + base, a - low, a - high
                held.append(out)
                size += len(out)
                if size >= HELD // 2:
                    yield parcels(held)
                    size = 0
        if size:
            yield parcels(held)

    return rows.mapInArrow(work, "bucket int, records binary")


def _settle(found: np.ndarray, length: int, most: int) -> dict[str, np.ndarray]:
    """Of a bucket: windows that are repeated as a whole, and occurrences whose bytes have to be seen.

    `ask` is 0 for the former (a is then their begin, up_to their end), else 1, or 2 if
    the windows are known to be repeated and only others may equal them. `many` tells
    anchors with more than `most` surroundings.
    """
    found = found[np.lexsort((found["a"], found["t"], found["hi"], found["lo"], found["f"], found["g"]))]
    g = found["g"]
    new_g = np.r_[True, g[1:] != g[:-1]]
    same = np.ones(len(found), bool)
    same[0:1] = False
    for c in ("g", "f", "lo", "hi"):
        same[1:] &= found[c][1:] == found[c][:-1]
    first = np.flatnonzero(~same)
    count = np.diff(np.r_[first, len(found)])
    around = np.repeat(np.arange(len(first)), count)
    whole = count[around] > 1
    # Surroundings of an anchor: those that are the only ones need no bytes.
    group = np.cumsum(new_g)[first] - 1
    kinds = np.bincount(group)
    asked = first[kinds[group] > 1]
    many = (kinds[group] > most)[kinds[group] > 1]
    done = np.flatnonzero(whole)
    copy = same[done]
    for c in ("t", "n", "a"):
        copy[1:] &= found[c][done[1:]] == found[c][done[:-1]]
    done = done[~copy]  # equal texts give the same rows
    rows = np.r_[done, asked]
    out = {c: found[c][rows].astype(np.int64) for c in ("t", "n", "a", "lo", "hi")}
    out["g"] = found["g"][rows].view(np.int64)
    out["ask"] = np.r_[np.zeros(len(done), np.int32), 1 + whole[asked].astype(np.int32)]
    out["many"] = np.r_[np.zeros(len(done), bool), many]
    head = slice(0, len(done))
    out["up_to"] = out["a"] - out["hi"] + length
    out["a"][head] -= out["lo"][head]
    return out


def _hashed_windows(held: list[tuple], length: int) -> np.ndarray:
    """All windows of occurrences (g, t, n, a, lo, hi, ask, bytes), as records."""
    g, t, n, a, lo, hi, ask = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[:7])
    raw = np.frombuffer(b"".join(h[7] for h in held), np.uint8)
    size = lo - hi + 1
    begin = np.r_[0, np.cumsum(size + length - 1)[:-1]]
    entry = np.repeat(np.arange(len(held)), size)
    nth = np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size)
    start = begin[entry] + nth
    out = np.empty(len(entry), _WINDOW)
    out["g"], out["w"] = g.view(np.uint64)[entry], Hasher(raw)(start, start + length)
    out["t"], out["n"], out["a"], out["far"], out["ask"] = t[entry], n[entry], a[entry], lo[entry] - nth, ask[entry]
    return out


def _combined(found: np.ndarray, length: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Windows with one of those that are equal, and the ranges that repeated ones with ask = 1 cover."""
    found = found[np.lexsort((found["far"], found["w"], found["g"]))]
    new = np.ones(len(found), bool)
    new[1:] = False
    for c in ("g", "w", "far"):
        new[1:] |= found[c][1:] != found[c][:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(found)])
    wanted = found[np.repeat(count > 1, count) & (found["ask"] == 1)]
    left = found[first]
    left["ask"][count > 1] = 2
    start = wanted["a"].astype(np.int64) - wanted["far"]
    by = np.lexsort((start, wanted["n"], wanted["t"]))
    start, t, n = start[by], wanted["t"][by], wanted["n"][by].astype(np.int64)
    new = np.ones(len(by), bool)
    new[1:] = (t[1:] != t[:-1]) | (n[1:] != n[:-1]) | (start[1:] > start[:-1] + length)
    last = np.r_[np.flatnonzero(new)[1:], len(by)][: int(new.sum())] - 1
    return left, {"t": t[new], "n": n[new], "start": start[new], "end": start[last] + length}


def _surroundings(asked: DataFrame, distinct: DataFrame, length: int, buckets: int, held_bytes: int) -> DataFrame:
    """Per occurrence the bytes of its windows.

    Where an anchor has many surroundings, rows with ask = 3 hold records of windows in place
    of bytes, one of those that are equal in about `held_bytes`, and rows with ask = 0
    the ranges (a to lo) that these equal ones cover.
    """
    names = ["bucket", "g", "t", "n", "a", "lo", "hi", "ask", "bytes"]
    kinds = [pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.binary()]

    def rows_of(columns: list) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(columns[0]), 20_000):
            arrays = [pa.array(c[i : i + 20_000], k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    def parcels(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        left, done = _combined(_hashed_windows(held, length), length)
        held.clear()
        bucket = (left["w"] % _U(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        left, bucket = left[by], bucket[by]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        data = [left[a:b].tobytes() for a, b in zip(first, np.r_[first[1:], len(left)], strict=True)]
        none = np.zeros(len(first), np.int64)
        yield from rows_of([bucket[first], *[none] * 6, none + 3, data])
        none = np.zeros(len(done["t"]), np.int64)
        yield from rows_of([done["t"] % buckets, none, done["t"], done["n"], done["start"], done["end"], none, none, [None] * len(none)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in range(batch.num_rows):
                data = batch.column(2)[r].as_buffer()
                t, n = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                asks = batch.column(3)[r].values.flatten()
                g, a, lo, hi, ask, many = (c.to_numpy(zero_copy_only=False) for c in asks)
                out: list[tuple] = []
                for row in zip(g.tolist(), a.tolist(), lo.tolist(), hi.tolist(), ask.tolist(), many.tolist(), strict=True):
                    key, at, low, high, kind, split = row
                    found = data[at - low : at - high + length].to_pybytes()
                    if not split:
                        out.append((key % buckets, key, t, n, at, low, high, kind, found))
                        continue
                    held.append((key, t, n, at, low, high, kind, found))
                    size += len(found)
                    if size >= held_bytes:
                        yield from parcels(held)
                        size = 0
                if out:
                    yield from rows_of(list(zip(*out, strict=True)))
        if held:
            yield from parcels(held)

    by_text = asked.groupBy("t", "n").agg(F.collect_list(F.struct("g", "a", "lo", "hi", "ask", "many")).alias("asks"))
    joined = distinct.join(by_text, ["t", "n"]).select("t", "n", F.col("text").cast("binary").alias("text"), "asks")
    return joined.mapInArrow(work, "bucket int, g long, t long, n long, a long, lo long, hi long, ask int, bytes binary")


def _equal(group: np.ndarray, start: np.ndarray, hashed: Hasher, length: int) -> np.ndarray:
    """Which of the windows are equal to another one of their group, by passes over digits."""
    alive, at = np.arange(len(group)), 0
    for width in digit_widths(length):
        if not len(alive):
            break
        digit = hashed(start[alive] + at, start[alive] + at + width)
        by = np.lexsort((digit, group[alive]))
        g, d = group[alive][by], digit[by]
        new = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
        size = np.diff(np.r_[np.flatnonzero(new), len(new)])
        number = np.cumsum(new) - 1
        several = size[number] > 1
        group = group.copy()
        group[alive[by]] = number
        alive = alive[by][several]
        at += width
    equal = np.zeros(len(group), bool)
    equal[alive] = True
    return equal


def digit_widths(length: int) -> list[int]:
    """Widths of the digits, up to the depth."""
    out, at = [], 0
    for width in (*DIGITS, length):
        width = min(width, length - at)
        if width > 0:
            out.append(width)
        at += width
    return out


def _sorted_out(table: pa.Table, length: int) -> pa.Table:
    """Ranges of bytes that repeated windows of a bucket's surroundings cover: t, n, start, end."""
    table = table.sort_by("g")
    cols = {c: table[c].to_numpy() for c in ("g", "t", "n", "a", "lo", "hi", "ask")}
    if len(table) == 0:
        return pa.table({c: pa.array([], pa.int64()) for c in ("t", "n", "start", "end")})
    data = pa.concat_arrays(table["bytes"].cast(pa.large_binary()).chunks)
    raw, offsets = texts.flat(data)
    _, key = np.unique(cols["g"], return_inverse=True)
    size = cols["lo"] - cols["hi"] + 1
    found = {c: [] for c in ("t", "n", "start", "end")}
    borders = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    i = 0
    while i < len(borders) - 1:
        # Whole groups of about HELD windows; a larger group goes by parts of its windows.
        j = i + 1
        total = int(size[borders[i] : borders[j]].sum())
        while j < len(borders) - 1 and total + int(size[borders[j] : borders[j + 1]].sum()) <= HELD:
            total += int(size[borders[j] : borders[j + 1]].sum())
            j += 1
        rows = np.arange(borders[i], borders[j])
        step = 256 if total <= 2 * HELD else max(1, 256 * HELD // total)
        for low in range(0, 256, step):
            least = np.maximum(cols["hi"][rows], low)
            most = np.minimum(cols["lo"][rows], low + step - 1)
            n_windows = np.maximum(most - least + 1, 0)
            entry = np.repeat(rows, n_windows)
            if not len(entry):
                continue
            # Windows of an entry from its first byte on: distance from the anchor falls.
            nth = np.arange(len(entry)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
            far = np.repeat(most, n_windows) - nth
            start = offsets[entry] + cols["lo"][entry] - far
            base = offsets[rows[0]]
            hashed = Hasher(raw[base : offsets[rows[-1] + 1]])
            equal = _equal(key[entry] * 256 + far, start - base, hashed, length)
            wanted = np.flatnonzero(equal & (cols["ask"][entry] == 1))
            if len(wanted):
                new = np.r_[True, (entry[wanted][1:] != entry[wanted][:-1]) | (nth[wanted][1:] != nth[wanted][:-1] + 1)]
                first = wanted[new]
                last = wanted[np.r_[np.flatnonzero(new)[1:], len(wanted)] - 1]
                for c in ("t", "n"):
                    found[c].append(cols[c][entry[first]])
                found["start"].append(cols["a"][entry[first]] - far[first])
                found["end"].append(cols["a"][entry[last]] - far[last] + length)
        i = j
    return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()})


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that ranges cover; ranges that touch are one run."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], end[np.r_[np.flatnonzero(new)[1:], len(end)] - 1]


def _kept(joined: DataFrame, keep_text: bool) -> DataFrame:
    """Per text its counts, the hash of the bytes that stay, and these themselves if wanted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, hashes, kept = [], [], [], []
            for r in range(batch.num_rows):
                data = batch.column(2)[r].as_buffer()
                ranges = batch.column(3)[r]
                digest, at, n_removed, n_spans, left = hashlib.sha256(), 0, 0, 0, []
                if ranges.is_valid and len(ranges):
                    start, end = (c.to_numpy(zero_copy_only=False) for c in ranges.values.flatten())
                    for a, b in zip(*merged(start, end), strict=True):
                        left.append(memoryview(data)[at:a])
                        at, n_removed, n_spans = int(b), n_removed + int(b - a), n_spans + 1
                left.append(memoryview(data)[at:])
                for part in left:
                    digest.update(part)
                removed.append(n_removed)
                spans.append(n_spans)
                hashes.append(digest.hexdigest())
                kept.append(b"".join(left) if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes, pa.string()), pa.array(kept, pa.binary())],
                ["t", "n", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(work, "t long, n long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row; the bytes that stay, if wanted.

    Removed is each byte that a string of `length` bytes (at most LENGTH) covers which
    also begins elsewhere, in the same or in another text; strings do not cross texts and
    are judged on the input. What stays may cut a character: it is bytes.

    A null text is empty. Rows with equal texts are different texts that repeat each other,
    whatever their ids. Texts are told apart by a 64-bit hash and their size. Other columns
    are not read. An empty table gives an empty one.
    """
    if not 1 <= length <= LENGTH:
        raise ValueError(f"length has to be from 1 to {LENGTH}")
    buckets, many, held = 2 * shuffle_partitions(docs.sparkSession), MANY, HELD
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), F.octet_length(text).cast("long").alias("n"), text.alias("text"))
    long_enough = rows.where(F.col("n") >= length)

    def settle(t: pa.Table) -> pa.Table:
        out = _settle(np.concatenate([np.frombuffer(r.as_py(), _RECORD) for r in t["records"]]), length, many)
        return pa.table({c: out[c] for c in ("t", "n", "a", "up_to", "lo", "hi", "g", "ask", "many")})

    sent = _records(long_enough.select("t", "n", "text"), length, buckets)
    seen = cut(
        sent.groupBy("bucket").applyInArrow(settle, "t long, n long, a long, up_to long, lo long, hi long, g long, ask int, many boolean")
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        """One text for all its copies, which meet before the shuffle, of those that are wanted."""
        kept = sieve(long_enough.select("t", "n", "text"), F.col("t"), wanted, "t")
        return kept.groupBy("t", "n").agg(F.first("text").alias("text"))

    def sort_out(t: pa.Table) -> pa.Table:
        kind = t["ask"].to_numpy()
        done = t.filter(pa.array(kind == 0)).select(["t", "n", "a", "lo"]).rename_columns(["t", "n", "start", "end"])
        out = [done, _sorted_out(t.filter(pa.array((kind == 1) | (kind == 2))), length)]
        windows = [np.frombuffer(r.as_buffer(), _WINDOW) for r in t.filter(pa.array(kind == 3))["bytes"]]
        if windows:
            out.append(pa.table(_combined(np.concatenate(windows), length)[1]))
        return pa.concat_tables(out)

    asked = seen.where("ask > 0")
    around = _surroundings(asked, texts_of(asked), length, buckets, held)
    ranges = around.groupBy("bucket").applyInArrow(sort_out, "t long, n long, start long, end long")
    ranges = cut(ranges.union(seen.where("ask = 0").select("t", "n", F.col("a").alias("start"), F.col("up_to").alias("end"))))
    by_text = ranges.groupBy("t", "n").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = texts_of(ranges).join(by_text, ["t", "n"]).select("t", "n", F.col("text").cast("binary").alias("text"), "ranges")
    found = cut(_kept(joined, keep_text))
    all_of = rows.select("id", "t", "n", F.sha2("text", 256).alias("whole"), *([F.col("text").cast("binary").alias("text")] if keep_text else []))
    out = all_of.join(found, ["t", "n"], "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        *([F.coalesce("kept", "text").alias("kept")] if keep_text else []),
    )
    return out
