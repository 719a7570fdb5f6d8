"""Approximate nearest neighbours by multi-index hashing over learned rotated codes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import vectors
from barloom.llm.common import cut

# Rows that rotations and radius are fitted on, at most.
SAMPLE = 10_000
# Rotations; each gives one bit a dimension.
ROTATIONS = 4
# Share of a sample's true neighbours that the radius takes in.
WITHIN = 0.97
_WORD = 16


def _lifted(vecs: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors whose angle to a query falls as the inner product rises."""
    rest = np.sqrt(np.maximum(norm**2 - (vecs * vecs).sum(axis=1), 0.0))
    return np.c_[vecs, rest] / norm


def _unit(vecs: np.ndarray) -> np.ndarray:
    return np.c_[vecs, np.zeros(len(vecs))] / np.linalg.norm(vecs, axis=1, keepdims=True)


def fit_rotations(x: np.ndarray, n: int, seed: int = 0, rounds: int = 30) -> np.ndarray:
    """n rotations side by side, each turned until signs lie close to the rotated vectors."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r), full_matrices=False)
            r = u @ vt
        out.append(r)
    return np.concatenate(out, axis=1)


def encode(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Codes as rows of 16-bit substrings."""
    bits = x @ rotations > 0
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.packbits(bits, axis=1).view(np.uint16)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all rows of a to all of b."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    out = np.zeros((len(a), len(b)), np.int32)
    for j in range(a.shape[1]):
        out += np.bitwise_count(a[:, j, None] ^ b[None, :, j])
    return out


def fit_radius(vecs: np.ndarray, norm: float, rotations: np.ndarray, k: int, queries: int = 200) -> int:
    """Within it lie WITHIN of the k nearest that the sample's first rows have in the sample."""
    q = vecs[:queries]
    scores = q @ vecs.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argsort(-scores, axis=1)[:, : min(k, len(vecs) - 1)]
    far = _distances(encode(_unit(q), rotations), encode(_lifted(vecs, norm), rotations))
    return int(np.quantile(np.take_along_axis(far, near, axis=1), WITHIN)) if near.size else 0


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: k rows with a large inner product for every query.

    Queries are the rows whose id is divisible by `every`, candidates all other rows. All
    rows are indexed, in blocks: a code, one bit for each of ROTATIONS x (dim + 1) learned
    directions, is cut into 16-bit substrings, and each substring of a block has an index
    of its values. By the pigeonhole principle a code within the radius r has a substring
    within r // m of the query's (r // m - 1 for those beyond the remainder), so probing
    those values finds every code within the radius; farther ones are then dropped, and
    the others ranked by exact inner products in double precision. A block that finds
    fewer than k takes its k nearest codes, as a growing radius would, so a query gets k
    rows, or all there are. Rotations and radius are fitted on `sample` rows at most.
    Zero vectors take no part, like those that `vectors` leaves out. Ties go to the
    smaller id. An empty table gives an empty result.
    """
    zero = F.forall(F.col(vec_col).cast("array<double>"), lambda x: x == 0)
    data = vectors.blocks(df.where(F.coalesce(~zero, F.lit(True))), id_col, vec_col)
    fitted_on = _sample(data, sample)
    if len(fitted_on):
        rotations = fit_rotations(_lifted(fitted_on, data.norm), ROTATIONS)
        radius = fit_radius(fitted_on, data.norm, rotations, k)
    else:
        rotations, radius = np.zeros((data.dim + 1, 0)), 0
    norm = data.norm

    def prepare(ids: np.ndarray, vecs: np.ndarray):
        codes = encode(_lifted(vecs, norm), rotations)
        index = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]
        return ids, vecs, codes, index

    def answer(held, q_ids, q_vecs, state):
        ids, vecs, codes, index = held
        q_codes = encode(_unit(q_vecs), rotations)
        m = len(index)
        least, rest = divmod(radius, m)
        out_q, out_i, out_s = [], [], []
        for first in range(0, len(q_ids), 64):  # keeps the tables in the processor's cache
            part = slice(first, first + 64)
            found = np.zeros((len(q_ids[part]), len(ids)), bool)
            for j, (values, which) in enumerate(index):
                probed = np.bitwise_count(q_codes[part, j, None] ^ values) <= least - (j > rest)
                found |= probed[:, which]
            far = _distances(np.ascontiguousarray(q_codes[part]), codes)
            own = q_ids[part, None] == ids
            far[own] = 1 << 30
            found &= far <= radius
            for q in range(len(found)):
                hits = np.flatnonzero(found[q])
                if len(hits) < k:
                    hits = np.sort(np.argsort(far[q], kind="stable")[:k])
                    hits = hits[far[q, hits] < 1 << 30]
                # Row by row, so that equal vectors get equal scores.
                scores = (vecs[hits] * q_vecs[first + q]).sum(axis=1)
                best = np.lexsort((ids[hits], -scores))[:k]
                out_q.append(np.full(len(best), q_ids[first + q]))
                out_i.append(ids[hits[best]])
                out_s.append(scores[best])
        return {"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_i), "score": np.concatenate(out_s)}

    queries = cut(vectors.query_rows(data, every)).withColumn("state", F.lit(b""))
    found = vectors.against_all(data, queries, prepare, answer, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _sample(data: vectors.Blocks, most: int) -> np.ndarray:
    """The first rows of each block, so many of each that there are `most` at most."""
    dim, each = data.dim, max(1, most // data.n_blocks)
    head = data.rows.limit(most).select(
        F.substring("ids", 1, 8 * each).alias("ids"), F.substring("vecs", 1, 8 * dim * each).alias("vecs")
    )
    parts = [vectors.unpack(r.ids, r.vecs, dim)[1] for r in head.collect()]
    return np.concatenate(parts) if parts else np.zeros((0, dim))
