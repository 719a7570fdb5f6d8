"""Sets of hashed word shingles of many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from barloom.llm import texts

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
_BASE = 0xD1342543DE82EF95
_POWERS = [np.ones(1, np.uint64)]


def mix(z: np.ndarray) -> np.ndarray:
    """Spreads 64 bits."""
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def _powers(n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64, at least n of them."""
    have = _POWERS[0]
    while len(have) < n:
        have = np.r_[have, have * _U(pow(_BASE, len(have), 1 << 64))]
    _POWERS[0] = have
    return have


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and its text. Works on about a megabyte of whole words at a time."""
    n = len(offsets) - 1
    spread = np.full(len(raw) + n, 0x20, np.uint8)
    spread[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(offsets))] = raw
    first = offsets[:-1] + np.arange(n)
    hashes, owners, at = [], [], 0
    while at < len(spread):
        end = min(len(spread), at + texts.CHUNK)
        while end < len(spread) and not SPACES[spread[end - 1]]:
            more = np.flatnonzero(SPACES[spread[end : end + texts.CHUNK]])
            end = end + int(more[0]) + 1 if len(more) else min(len(spread), end + texts.CHUNK)
        part = _LOWER[spread[at:end]]
        inside = ~SPACES[part]
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if len(starts):
            sizes = np.diff(np.r_[starts, len(part)])
            place = np.arange(starts[0], len(part)) - np.repeat(starts, sizes)
            values = (part[starts[0] :].astype(np.uint64) + _U(1)) * _powers(int(sizes.max()))[place]
            values[~inside[starts[0] :]] = 0
            hashes.append(mix(np.add.reduceat(values, starts - starts[0])))
            owners.append(np.searchsorted(first, starts + at, side="right") - 1)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending in each, and offsets.

    A text of fewer than `width` words has one shingle of all its words, one without words none.
    """
    n = len(offsets) - 1
    words, owner = word_hashes(raw, offsets)
    per = np.bincount(owner, minlength=n)
    begin = np.r_[0, np.cumsum(per)]
    salts = [_U(pow(_BASE, 3 + 2 * k, 1 << 64)) for k in range(width)]
    full = np.zeros(0, np.uint64)
    if len(words) >= width:
        full = sum(words[k : len(words) - width + 1 + k] * salts[k] for k in range(width))
        full = mix(full + _U(width))
    sets = []
    for i in range(n):
        if per[i] >= width:
            own = np.sort(full[begin[i] : begin[i + 1] - width + 1])
            sets.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif per[i]:
            own = words[begin[i] : begin[i + 1]]
            sets.append(mix(np.array([(own * np.array(salts[: len(own)])).sum() + _U(len(own))], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    at = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), at


def of_column(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last + 1 row of a run of texts, their shingles, and offsets."""
    raw, offsets = texts.flat(column)
    for i, j in texts.groups(offsets):
        shingles, at = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
        yield i, j, shingles, at


def digests(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128 bits of each set, as two columns; of an empty set zero."""
    out = np.zeros((len(at) - 1, 2), np.uint64)
    for k, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        sums = np.r_[_U(0), np.cumsum(mix(shingles * _U(salt)), dtype=np.uint64)]
        out[:, k] = sums[at[1:]] - sums[at[:-1]]
    return out
