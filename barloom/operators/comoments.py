"""Counts, means and co-moments of all column pairs, each over the rows where both are known.

A task keeps one square matrix of each for every series it meets, so a row is read once and
copied for no pair.  Matrices merge (pairwise update of means and moments, which keeps its
digits where sums of squares would lose them), first among groups of tasks, then in all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from barloom.schema import KEYS, quoted, require_columns

# Series a task holds before it passes them on, and groups of tasks that are merged first.
_HELD, _SALTS = 4096, 64


class Moments(NamedTuple):
    """Of columns i and j, over rows where both are known: row i, column j."""

    n: np.ndarray
    mean: np.ndarray  # of i
    spread: np.ndarray  # sum of squared deviations of i
    joint: np.ndarray  # sum of products of the deviations of i and j

    @classmethod
    def of(cls, x: np.ndarray, known: np.ndarray) -> Moments:
        """Of rows of values; what is not known is 0.  NaN is a value."""
        odd = np.isnan(x)
        x, k = np.where(odd, 0.0, x), known.astype(float)
        # Around a value of the column first, so that a constant column has no spread at all.
        first = x[known.argmax(axis=0), np.arange(x.shape[1])]
        x = (x - first) * k
        centre = x.sum(axis=0) / np.maximum(k.sum(axis=0), 1)
        x = (x - centre) * k
        n = k.T @ k
        size = np.maximum(n, 1)
        s = x.T @ k
        mean = (first + centre)[:, None] + s / size
        spread, joint = (x * x).T @ k - s * s / size, x.T @ x - s * s.T / size
        bad = odd.astype(float).T @ k > 0
        mean, spread = np.where(bad, np.nan, mean), np.where(bad, np.nan, np.maximum(spread, 0))
        return cls(n, mean, spread, np.where(bad | bad.T, np.nan, joint))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        size = np.maximum(n, 1)
        # A side without rows has no mean.
        step = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / size
        mean = np.where(self.n == 0, other.mean, np.where(other.n == 0, self.mean, self.mean + step * (other.n / size)))
        return Moments(
            n, mean, self.spread + other.spread + step * step * weight, self.joint + other.joint + step * step.T * weight
        )

    def correlation(self) -> np.ndarray:
        """Pearson's r; -inf, which it cannot be, where it is not defined."""
        root = np.sqrt(self.spread) * np.sqrt(self.spread.T)
        none = (self.n < 2) | (root == 0)
        return np.where(none, -np.inf, self.joint / np.where(none, 1.0, root))


def _packed(m: Moments) -> list[float]:
    return np.concatenate([a.ravel() for a in m]).tolist()


def _unpacked(values: np.ndarray, p: int) -> Moments:
    return Moments(*np.asarray(values, float).reshape(4, p, p))


def _merged(table: pa.Table, p: int) -> Moments:
    rows = table["_moments"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, 4 * p * p)
    # In a fixed order, so that a rerun gives the same digits.
    rows = rows[np.lexsort(rows.T[::-1])]
    out = _unpacked(rows[0], p)
    for row in rows[1:]:
        out = out.merged(_unpacked(row, p))
    return out


def comoments(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row a series: the keys as ``_k0``, ``_k1`` ..., and ``_moments``, the four matrices one after the other."""
    require_columns(df, [*keys, *columns])
    p, by = len(columns), [f"_k{i}" for i in range(len(keys))]
    rows = df.select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(keys, by, strict=True)],
        *[F.col(quoted(c)).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)],
    )
    fields = [T.StructField(n, rows.schema[n].dataType) for n in by]
    moments = T.StructField("_moments", T.ArrayType(T.DoubleType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % _SALTS
        held: dict[tuple, Moments] = {}
        types = None

        def out() -> pa.RecordBatch:
            arrays = [pa.array([k[i] for k in held], t) for i, t in enumerate(types)]
            arrays += [pa.array([salt] * len(held), pa.int32()), pa.array([_packed(m) for m in held.values()], pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(arrays, [*by, "_salt", "_moments"])

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(n).type for n in by]
            cells = [batch.column(f"_v{i}") for i in range(p)]
            known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in cells], axis=1)
            x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cells], axis=1)
            code = np.zeros(batch.num_rows, np.int64)
            for n in by:
                found = batch.column(n).dictionary_encode(null_encoding="encode")
                code = code * len(found.dictionary) + found.indices.to_numpy()
                code = np.unique(code, return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(code[order])) + 1, [len(order)]])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                mine = order[a:b]
                key = tuple(batch.column(n)[int(mine[0])].as_py() for n in by)
                m = Moments.of(x[mine], known[mine])
                held[key] = held[key].merged(m) if key in held else m
            if len(held) > _HELD:
                yield out()
                held = {}
        if held:
            yield out()

    parts = rows.mapInArrow(work, T.StructType([*fields, T.StructField("_salt", T.IntegerType()), moments]))

    def first(table: pa.Table) -> pa.Table:
        return pa.table([table[n][:1] for n in by] + [pa.array([_packed(_merged(table, p))], pa.list_(pa.float64()))], [*by, "_moments"])

    some = parts.groupBy(*by, "_salt").applyInArrow(first, T.StructType([*fields, moments]))
    return some.groupBy(*by).applyInArrow(first, T.StructType([*fields, moments]))


def correlations(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, col_a, col_b, r`` for every ordered pair of columns; r is null where it is not defined.

    The rows of ``stats.correlation_matrix``, from one narrow scan and no copies of rows: for
    wide or long tables.  On small ones starting Python costs more than it saves.
    """
    p = len(columns)
    named = T.StructType([T.StructField("_i", T.IntegerType()), T.StructField("_r", T.DoubleType())])
    held = comoments(df, columns, keys=keys)
    by = held.columns[:-1]
    fields = [held.schema[k] for k in by]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = _unpacked(batch.column(len(keys))[i].values.to_numpy(zero_copy_only=False), p).correlation().ravel()
                arrays = [batch.column(j).take(pa.array(np.full(p * p, i))) for j in range(len(keys))]
                arrays += [pa.array(np.arange(p * p, dtype=np.int32)), pa.array(r, mask=np.isneginf(r))]
                yield pa.RecordBatch.from_arrays(arrays, [*by, "_i", "_r"])

    found = held.mapInArrow(work, T.StructType([*fields, *named.fields]))
    labels = F.array(*[F.lit(c) for c in columns])
    return found.select(
        *[F.col(n).alias(k) for n, k in zip(by, keys, strict=True)],
        F.get(labels, F.expr(f"_i div {p}").cast("int")).alias("col_a"),
        F.get(labels, F.expr(f"_i % {p}")).alias("col_b"),
        F.col("_r").alias("r"),
    )
