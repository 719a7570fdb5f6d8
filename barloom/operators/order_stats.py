"""Moving quantiles over long row windows.

A sorted copy of the window for every row costs a window's length per row.  Here rows are
numbered along their series, and a run of rows, with the window before it, is one group.
A wavelet matrix over the ranks of the group's values then finds the k-th smallest of any
stretch of rows in as many steps as a rank has bits, for all rows at once: the time does
not depend on the window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from barloom.operators.series import DEFAULT_BLOCK_DAYS, over_series
from barloom.schema import KEYS, TIMESTAMP, quoted, require_columns, require_window

# Rows of a group, besides the window before them; a longer window makes longer groups.
GROUP_ROWS = 1 << 15

_AT, _GROUP, _OWN, _VALUE = "_position", "_group", "_own", "_value"


class WaveletMatrix:
    """k-th smallest of any stretch of an array of ranks, for many stretches at once."""

    def __init__(self, ranks: np.ndarray):
        bits = int(ranks.max(initial=0)).bit_length()
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (ranks >> bit) & 1
            zeros = np.concatenate([[0], np.cumsum(1 - one)])
            self.levels.append((bit, zeros))
            ranks = np.concatenate([ranks[one == 0], ranks[one == 1]])

    def smallest(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Rank of the k-th smallest (from 0) of ranks[start:end]; every stretch has more than k."""
        out = np.zeros(len(k), np.int64)
        for bit, zeros in self.levels:
            left, right = zeros[start], zeros[end]
            go = k >= right - left
            k = np.where(go, k - (right - left), k)
            start = np.where(go, zeros[-1] + start - left, left)
            end = np.where(go, zeros[-1] + end - right, right)
            out |= go.astype(np.int64) << bit
        return out


def moving_quantiles(values: np.ndarray, given: np.ndarray, at: np.ndarray, window: int, q: float) -> np.ndarray:
    """Quantile q of the given values among the last ``window`` rows, up to each row ``at``.

    Between two values it is linear, as in SQL's continuous quantile.  NaN where no value is
    given.  NaN as a value is larger than all others.
    """
    before = np.concatenate([[0], np.cumsum(given)])
    end = before[at + 1]
    start = before[np.maximum(at + 1 - window, 0)]
    size = end - start
    some = size > 0
    found, ranks = np.unique(values[given], return_inverse=True)
    if not len(found):
        return np.full(len(at), np.nan)
    matrix = WaveletMatrix(ranks)
    place = q * np.maximum(size - 1, 0)
    low = np.floor(place).astype(np.int64)
    high = np.minimum(low + 1, np.maximum(size - 1, 0))
    start, end = np.where(some, start, 0), np.where(some, end, len(ranks))
    a, b = (found[matrix.smallest(start, end, np.where(some, k, 0))] for k in (low, high))
    part = place - low
    mixed = np.where(part == 0, a, np.where(part == 0.5, (a + b) / 2, a + (b - a) * part))
    return np.where(some, mixed, np.nan)


def moving_quantile(
    df: DataFrame,
    window: int,
    column: str = "close",
    q: float = 0.5,
    name: str | None = None,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
    block_days: int | None = DEFAULT_BLOCK_DAYS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the quantile ``q`` of ``column`` over the last ``window`` rows of the series.

    Early rows use what there is; nulls are skipped, and a window of nulls gives null.  A
    group holds at most ``group_rows`` (or ``window``, if that is more) rows and the
    ``window - 1`` before them, whatever the length of the series, and each row goes to two
    groups at most.  ``block_days`` is the length of the blocks rows are numbered by.
    """
    require_window(window)
    if not 0 <= q <= 1:
        raise ValueError(f"q must be in 0..1, got {q}")
    require_columns(df, [*keys, ts, column, *tiebreak])
    name = name or f"quantile_{window}"
    length = max(group_rows, window)
    rows = over_series(
        df.withColumns({_VALUE: F.col(quoted(column)).cast("double")}),
        lambda w: [{"_numbered": f"sum(_one) {w.running}"}],
        {_AT: "CAST(_numbered - 1 AS BIGINT)"},
        keys=keys,
        ts=ts,
        carry={"_one": ("1L", "sum")},
        block_days=block_days,
        tiebreak=tiebreak,
    )
    kept = [f.name for f in df.schema.fields if f.name != name]
    payload = F.struct(*[F.col(quoted(c)) for c in kept])
    names = [f"_key_{i}" for i in range(len(keys))]
    group = f"{_AT} div {length}"
    # The last rows of a group are the window before the first rows of the next.
    placed = rows.select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(keys, names, strict=True)],
        F.expr(f"explode(sequence({group}, {group} + int({_AT} % {length} > {length - window}))) AS {_GROUP}"),
        F.expr(f"{group} AS _home"),
        _AT,
        _VALUE,
        payload.alias("_row"),
    )
    own = F.col(_GROUP) == F.col("_home")
    dealt = placed.select(*names, _GROUP, own.alias(_OWN), _AT, _VALUE, F.when(own, F.col("_row")).alias("_row"))
    out = T.StructType([T.StructField("_row", dealt.schema["_row"].dataType), T.StructField(name, T.DoubleType())])

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by(_AT)
        value = table[_VALUE].combine_chunks()
        mine = table[_OWN].to_numpy()
        given = value.is_valid().to_numpy(zero_copy_only=False)
        found = moving_quantiles(value.fill_null(0.0).to_numpy(), given, np.flatnonzero(mine), window, q)
        # A window without a value has no quantile; NaN may be one.
        seen = np.concatenate([[0], np.cumsum(given)])
        at = np.flatnonzero(mine)
        none = seen[at + 1] == seen[np.maximum(at + 1 - window, 0)]
        return pa.table({"_row": table["_row"].filter(pa.array(mine)), name: pa.array(found, mask=none)})

    done = dealt.groupBy(*names, _GROUP).applyInArrow(work, out)
    return done.select(*[F.col(f"_row.{quoted(c)}").alias(c) for c in kept], F.col(quoted(name)))
