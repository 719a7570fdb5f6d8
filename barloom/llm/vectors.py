"""Vectors in blocks, and every query against every block.

A table of vectors becomes blocks of about BLOCK rows, chosen by a hash of the id, each
one row of packed arrays. Queries are rows of the same table; the queries of a block go to
every block, so a task holds one block and one set of queries at a time.

Rows without an id, without a vector, or with a null or non-finite component take no part.
Of rows that share an id the one with the smallest vector counts. Shorter vectors are
filled up with zeros. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut

BLOCK = 8192


class Blocks(NamedTuple):
    rows: DataFrame  # block, ids, vecs
    n_blocks: int
    dim: int
    norm: float  # largest Euclidean norm


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vec (array<double>) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("id"), vec.alias("vec")
    )


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dim))
    out[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def blocks(df: DataFrame, id_col: str, vec_col: str, change: Callable[[np.ndarray], np.ndarray] = np.asarray, per_block: int = BLOCK) -> Blocks:
    """The vectors, after `change` of each block's matrix, packed in blocks."""
    found = usable(df, id_col, vec_col)
    n, dim = found.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    n_blocks = max(1, -(-n // per_block))

    def pack(t: pa.Table) -> pa.Table:
        ids = t["id"].to_numpy()
        vecs = _matrix(t["vec"], dim)
        order = np.lexsort((*vecs.T[::-1], ids))
        ids, vecs = ids[order], vecs[order]
        first = np.r_[True, ids[1:] != ids[:-1]]
        ids, vecs = ids[first], np.ascontiguousarray(change(vecs[first]))
        norm = float(np.sqrt((vecs * vecs).sum(axis=1).max(initial=0.0)))
        return pa.table({"block": t["block"][:1], "ids": [ids.tobytes()], "vecs": [vecs.tobytes()], "norm": [norm]})

    packed = cut(
        found.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
        .groupBy("block")
        .applyInArrow(pack, "block int, ids binary, vecs binary, norm double")
    )
    norm = packed.agg(F.max("norm")).first()[0] or 0.0
    return Blocks(packed.drop("norm"), n_blocks, dim, norm)


def unpack(ids: bytes, vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    return i, np.frombuffer(vecs, dtype=np.float64).reshape(len(i), dim)


def against_all(
    data: Blocks,
    queries: DataFrame,
    prepare: Callable[[np.ndarray, np.ndarray], object],
    answer: Callable[[object, np.ndarray, np.ndarray, bytes], dict[str, np.ndarray] | None],
    schema: str,
) -> DataFrame:
    """What `answer` returns for every set of queries (ids, vecs, state) and every block.

    A block comes first in its task, then all sets of queries one by one: memory is one
    block and one batch of sets. `prepare` builds from a block what its queries need.
    """
    dim = data.dim
    blank = F.lit(b"")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(data.n_blocks - 1))).alias("block")
    rows = data.rows.select("block", F.lit(0).alias("is_query"), "ids", "vecs", blank.alias("state"))
    rows = rows.unionByName(queries.select(everywhere, F.lit(1).alias("is_query"), "ids", "vecs", "state"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block, is_query, ids, vecs, state = (c[i].as_py() for c in batch.columns)
                i_ids, i_vecs = unpack(ids, vecs, dim)
                if not is_query:
                    held, at = prepare(i_ids, i_vecs), block
                elif block == at:  # a block without rows has no row
                    out = answer(held, i_ids, i_vecs, state)
                    if out is not None:
                        yield pa.RecordBatch.from_pydict(out)

    placed = rows.repartition(data.n_blocks, "block").sortWithinPartitions("block", "is_query")
    return placed.mapInArrow(work, schema)


def query_rows(data: Blocks, every: int) -> DataFrame:
    """Per block its queries, the rows whose id is divisible by `every`: block, ids, vecs."""
    dim = data.dim

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, vecs = unpack(batch["ids"][i].as_py(), batch["vecs"][i].as_py(), dim)
                wanted = ids % every == 0
                if wanted.any():
                    yield pa.RecordBatch.from_pydict(
                        {"block": batch["block"].slice(i, 1), "ids": [ids[wanted].tobytes()], "vecs": [vecs[wanted].tobytes()]}
                    )

    return data.rows.mapInArrow(pick, "block int, ids binary, vecs binary")
