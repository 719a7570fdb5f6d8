"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import vectors
from barloom.llm.common import cut

BINS = 64


def quantized(vecs: np.ndarray) -> np.ndarray:
    return np.floor(256 * vecs)


def _scores(ids: np.ndarray, vecs: np.ndarray, q_ids: np.ndarray, q_vecs: np.ndarray, low: int) -> np.ndarray:
    """Integer inner products; a query's own row gets a score below `low`, under all others."""
    with np.errstate(invalid="ignore"):
        scores = np.clip(q_vecs @ vecs.T, -(2.0**62), 2.0**62).astype(np.int64)
    scores[q_ids[:, None] == ids[None, :]] = low - 1
    return scores


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest score for every query.

    Components are floored to 256ths, scores are inner products of these whole numbers
    (exact below 2^53). Queries are the rows whose id is divisible by `every`, candidates
    all other rows; ties go to the smaller id. A query with fewer candidates gets all.

    Each round scores every query against every block and counts scores by bin; a block
    reports the bins from its top down to its own k-th score, for the k-th score of all is
    not below. The sums locate the bin of a query's k-th score, which the next round cuts
    into BINS parts, until it is one value wide. Then rows above that value pass, and of
    those equal to it the k smallest ids of each block. Nulls, non-finite components,
    repeated ids and short vectors: see `vectors`. An empty table gives an empty result.
    """
    data = vectors.blocks(df, id_col, vec_col, quantized)
    bound = int(min(data.norm**2 * (1 + 1e-9) + 1, 2.0**62))
    low, span = -bound, 2 * bound + 1
    asked = cut(vectors.query_rows(data, every))

    def prepare(ids: np.ndarray, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ids, vecs

    def histogram(held, q_ids, q_vecs, state):
        start, width, above = np.frombuffer(state, np.int64).reshape(3, -1)
        scores = _scores(*held, q_ids, q_vecs, low)
        part = -(-width // BINS)
        inside = (scores >= start[:, None]) & (scores < (start + width)[:, None])
        bins = np.where(inside, (scores - start[:, None]) // part[:, None], -1)
        row = np.broadcast_to(np.arange(len(q_ids))[:, None], bins.shape)
        flat = (row * BINS + bins)[inside]
        counts = np.bincount(flat, minlength=len(q_ids) * BINS).reshape(-1, BINS)
        from_top = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
        counts[from_top - counts >= k] = 0
        q, b = np.nonzero(counts)
        return {"query_id": q_ids[q], "bin": b.astype(np.int64), "n": counts[q, b].astype(np.int64)}

    def passing(held, q_ids, q_vecs, state):
        least = np.frombuffer(state, np.int64).reshape(3, -1)[0]
        scores = _scores(*held, q_ids, q_vecs, low)
        kept = scores > least[:, None]
        equal = scores == least[:, None]  # ids ascend in a block
        kept |= equal & (equal.cumsum(axis=1) <= k)
        q, i = np.nonzero(kept)
        return {"query_id": q_ids[q], "vec_id": held[0][i], "score": scores[q, i]}

    # State of a query: the k-th score lies in [start, start + width), `above` scores lie over it.
    def begin(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n = len(batch["ids"][i].as_py()) // 8
                state = np.repeat(np.array([[low], [span], [0]], np.int64), n, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([state.tobytes()])], ["block", "ids", "vecs", "state"])

    schema = "block int, ids binary, vecs binary, state binary"
    queries = asked.mapInArrow(begin, schema)
    width = span
    while width > 1:
        counted = vectors.against_all(data, queries, prepare, histogram, "query_id long, bin long, n long")
        totals = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        home = F.pmod(F.xxhash64("query_id"), F.lit(data.n_blocks)).cast("int")
        hits = totals.groupBy(home.alias("block")).agg(F.collect_list(F.struct("query_id", "bin", "n")).alias("bins"))
        queries = cut(_refined(queries, hits, schema, k, low))
        width = -(-width // BINS)

    found = vectors.against_all(data, queries, prepare, passing, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _refined(queries: DataFrame, hits: DataFrame, schema: str, k: int, low: int) -> DataFrame:
    """The queries with the bin that holds their k-th score. A block has at most BLOCK queries of BINS bins."""

    def step(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids = np.frombuffer(batch["ids"][i].as_py(), np.int64)
                start, width, above = (x.copy() for x in np.frombuffer(batch["state"][i].as_py(), np.int64).reshape(3, -1))
                counts = np.zeros((len(q_ids), BINS), np.int64)
                bins = batch["bins"][i].values.flatten() if batch["bins"][i].is_valid else None
                if bins is not None:
                    ids, at, n = (b.to_numpy() for b in bins)
                    counts[np.searchsorted(q_ids, ids), at] = n
                part = -(-width // BINS)
                over = above[:, None] + counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # scores from this bin up
                enough = over >= k
                chosen = np.where(enough.any(axis=1), BINS - 1 - enough[:, ::-1].argmax(axis=1), 0)
                every_one = ~enough.any(axis=1)  # fewer than k candidates: all pass
                row = np.arange(len(q_ids))
                above = over[row, chosen] - counts[row, chosen]
                start = np.where(every_one, low, start + chosen * part)
                state = np.stack([start, np.where(every_one, 1, part), np.where(every_one, 0, above)])
                yield pa.RecordBatch.from_arrays(
                    [batch["block"].slice(i, 1), batch["ids"].slice(i, 1), batch["vecs"].slice(i, 1), pa.array([state.tobytes()])],
                    ["block", "ids", "vecs", "state"],
                )

    return queries.join(hits, "block", "left").select("block", "ids", "vecs", "state", "bins").mapInArrow(step, schema)
