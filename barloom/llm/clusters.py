"""Centroid clustering of integer vectors, distances from scalar lookup tables.

Vectors are packed where they lie, in blocks of one Arrow batch each, as codes: for every
dimension the integer values that occur in the block, and for every vector the place of its
value among them. In a round a block tabulates (value - centroid)^2 for each dimension,
occurring value and centroid; the distances are sums of what the codes gather from these
tables. What leaves a block is a sum per centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut

DIM, SCALE, K, ROUNDS, SEED = 64, 64, 16, 3, 1
# Largest magnitude of an integer component: 64 squared differences still fit a long.
LARGEST = 1 << 27


class Codes(NamedTuple):
    """Vectors of a block: values[starts[d] + codes[i, d]] is component d of vector i."""

    values: np.ndarray
    starts: np.ndarray
    codes: np.ndarray


def encode(vecs: np.ndarray) -> Codes:
    values, codes, starts = [], [], [0]
    for column in vecs.T:
        found, which = np.unique(column, return_inverse=True)
        values.append(found)
        codes.append(which)
        starts.append(starts[-1] + len(found))
    if not values:
        return Codes(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((len(vecs), 0), np.int32))
    return Codes(np.concatenate(values), np.array(starts), np.stack(codes, axis=1).astype(np.int32))


def distances(block: Codes, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector to every centroid."""
    out = np.zeros((len(block.codes), len(centroids)), np.int64)
    for d in range(block.codes.shape[1]):
        values = block.values[block.starts[d] : block.starts[d + 1]]
        table = (values[:, None] - centroids[None, :, d]) ** 2
        out += table[block.codes[:, d]]
    return out


def nearest(block: Codes, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every vector the number of the nearest centroid, the smaller on ties, and the distance."""
    far = distances(block, centroids)
    which = far.argmin(axis=1)
    return which, far[np.arange(len(far)), which]


def decode(block: Codes) -> np.ndarray:
    return block.values[block.starts[:-1] + block.codes]


def pack(df: DataFrame, id_col: str, vec_col: str, dim: int, scale: float) -> DataFrame:
    """The kept vectors, floor(scale * x), as blocks: ids, valid, values, starts, codes."""
    vec = F.col(vec_col).cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where((F.size(vec) == dim) & ~odd)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(scale * batch["vec"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            if np.abs(x).max(initial=0) > LARGEST:
                raise ValueError(f"components over {LARGEST} have no distance in a long")
            ids = batch["id"]
            block = encode(x.astype(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()],
                    "valid": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
                    "vals": [block.values.tobytes()],
                    "starts": [block.starts.astype(np.int64).tobytes()],
                    "codes": [block.codes.tobytes()],
                }
            )

    return cut(kept.mapInArrow(work, "ids binary, valid binary, vals binary, starts binary, codes binary"))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, Codes]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, valid, vals, starts, codes = (np.frombuffer(batch[n][i].as_py(), t) for n, t in (
                ("ids", np.int64), ("valid", bool), ("vals", np.int64), ("starts", np.int64), ("codes", np.int32)))
            yield ids, valid, Codes(vals, starts, codes.reshape(len(ids), dim))


def first_centroids(blocks: DataFrame, dim: int, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:id`; of one id the smaller vector comes first, and no id last."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for ids, valid, block in _blocks(batches, dim):
            keys = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if ok else "~" for i, ok in zip(ids.tolist(), valid.tolist(), strict=True)]
            order = np.argsort(np.array(keys))  # ids that repeat are few here, their vectors decide below
            last = keys[order[min(k, len(order)) - 1]]
            near = [i for i in order.tolist() if keys[i] <= last]
            vecs = decode(Codes(block.values, block.starts, block.codes[near]))
            best = sorted([*best, *((keys[i], v) for i, v in zip(near, map(tuple, vecs.tolist()), strict=True))])[:k]
        if best:
            yield pa.RecordBatch.from_pydict({"key": [b for b, _ in best], "vec": [list(v) for _, v in best]})

    found = blocks.mapInArrow(work, "key string, vec array<long>").orderBy("key", "vec").limit(k).collect()
    return np.array([r.vec for r in found], np.int64).reshape(len(found), dim)


def sums(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per centroid with vectors: n, sum of each dimension, sum of the distances."""
    k, dim = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, _, block in _blocks(batches, dim):
            which, least = nearest(block, centroids)
            vecs = decode(block)
            for c in range(k):
                mine = which == c
                n[c] += mine.sum()
                far[c] += least[mine].sum()
                total[c] += vecs[mine].sum(axis=0)
        if n.any():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"cluster": used.astype(np.int32), "n": n[used], "far": far[used], "total": total[used].tolist()})

    parts = blocks.mapInArrow(work, "cluster int, n long, far long, total array<long>")
    dims = [F.sum(F.col("total")[d]) for d in range(dim)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("far").alias("far"), F.array(*dims).alias("total"))


def cluster(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, scale: float = SCALE, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """Clusters of the vectors floor(scale * x): id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector takes part if it has exactly `dim` components, none of them null, NaN or infinite.
    Centroids start as the k vectors with the smallest sha256 of `seed:id`. Each round assigns
    every vector to the nearest centroid, ties to the smaller number, and moves every centroid
    that has vectors to the floor of their mean, computed in whole numbers; a last pass assigns.

    Rows that repeat an id or a vector each count and are each returned. Rows without an id
    take part, but begin no cluster before all others. With fewer than k vectors there are as
    many centroids; without any, no rows. Other columns are not read. Components whose
    distance would not fit a long are refused.
    """
    blocks = pack(df, id_col, vec_col, dim, scale)
    centroids = first_centroids(blocks, dim, k, seed)
    for _ in range(rounds):
        moved = centroids.copy()
        for r in sums(blocks, centroids).collect():  # k rows at most
            moved[r.cluster] = [t // r.n for t in r.total]
        centroids = moved
    of_cluster = {r.cluster: r.far for r in sums(blocks, centroids).collect()}
    inertia = sum(of_cluster.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, valid, block in _blocks(batches, dim):
            which, least = nearest(block, centroids)
            yield pa.RecordBatch.from_pydict(
                {
                    id_col: pa.array(ids, mask=~valid),
                    "cluster": which.astype(np.int32),
                    "distance": least,
                    "cluster_inertia": np.array([of_cluster.get(c, 0) for c in range(len(centroids))], np.int64)[which],
                    "inertia": np.full(len(ids), inertia, np.int64),
                    "centroid_sha256": [names[c] for c in which.tolist()],
                }
            )

    schema = f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return blocks.mapInArrow(work, schema)
