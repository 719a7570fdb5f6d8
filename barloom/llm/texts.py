"""Texts of an Arrow batch as one array of UTF-8 bytes, and ranges of it that fit in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that one step of the array code works on; a text may be longer.
CHUNK = 1 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (or binaries), and offsets, one more than texts. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(at) == 0:
        at = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def groups(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of whole texts, first and last + 1, of about `most` bytes; a longer text is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j
