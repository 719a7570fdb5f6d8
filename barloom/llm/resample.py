"""Importance resampling towards a target: hashed n-gram features found by one overlapped scan.

Separators collapse to single spaces. One pattern for each length, with lookarounds that hold
its ends at word boundaries, runs over the text with overlaps allowed, so every match is the
span of one n-gram, and its bytes go to the checksum that names its bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut, written

LEAST, MOST, BUCKETS, SEED = 1, 1, 10_000, 2024
MIN_WORDS, PERCENT = 20, 10

# Bytes of a word: digits, small letters and all that is not ASCII; capitals become small, others a space.
_FOLD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_SPACES = re.compile(rb" {2,}")
_SPAN = itemgetter(0)


def patterns(least: int, most: int) -> list:
    """For each number of words, a pattern whose overlapped matches are all runs of so many words."""
    more = [b"(?: [^ ]+){%d}" % (n - 1) if n > 1 else b"" for n in range(least, most + 1)]
    return [regex.compile(b"(?<![^ ])[^ ]+" + m + b"(?![^ ])") for m in more]


def collapsed(text: str) -> bytes:
    return _SPACES.sub(b" ", text.encode().translate(_FOLD)).strip()


def scan(text: str, found: list, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of the text, by length, then place."""
    data = collapsed(text)
    parts = [np.fromiter(map(crc32, map(_SPAN, p.finditer(data, overlapped=True))), np.int64) for p in found]
    return np.concatenate(parts) % buckets


def n_words(text: str) -> int:
    data = collapsed(text)
    return data.count(b" ") + 1 if data else 0


def features(df: DataFrame, id_col: str, text_col: str, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """Per row: id, n_words, n_features and the buckets of its features, packed. A null text has none."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = patterns(least, most)
        for batch in batches:
            words, sizes, packed = [], [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                hit = scan(text, found, buckets)
                words.append(len(hit) if (least, most) == (1, 1) else n_words(text))
                sizes.append(len(hit))
                packed.append(hit.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["id", "n_words", "n_features", "buckets"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, n_words long, n_features long, buckets binary")


def counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows in each bucket. Counted in every task, then summed by bucket."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch["buckets"]:
                total += np.bincount(np.frombuffer(packed.as_py(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "n": total[used]})

    parts = found.select("buckets").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in parts.collect():  # a row a bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of the smoothed shares), for each bucket."""
    k = len(source)
    up = (target + 1.0) * float(source.sum() + k)
    return np.floor(1000 * np.log(up / ((source + 1.0) * float(target.sum() + k)))).astype(np.int64)


def noise(seed: int, id_col: str = "id"):
    """Gumbel noise from the id, in thousandths, rounded down."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256), 1, 8)
    u = (F.conv(head, 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u))).cast("long")


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features, weight: the floored mean of the gains of the row's features, 0 without any."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for packed in batch["buckets"]:
                hit = np.frombuffer(packed.as_py(), kind)
                weights.append(int(gain[hit].sum()) // len(hit) if len(hit) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n_words"], batch["n_features"], pa.array(weights, pa.int64())],
                ["id", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(work, "id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, eligible, share: int) -> DataFrame:
    """The rows of scored with a column rank: 1, 2, ... of the share (in percent) of the eligible rows that score highest.

    Scores are whole numbers of a bounded range, so a count per score gives the rank at which
    each score begins, and rows are only ordered among those of one score.
    """
    rows = scored.withColumn("eligible", F.coalesce(eligible & F.col("score").isNotNull(), F.lit(False)))
    per_score = rows.where("eligible").groupBy("score").agg(F.count("*").alias("n")).collect()  # a row a score
    per_score = sorted(((r.score, r.n) for r in per_score), reverse=True)
    drawn = sum(n for _, n in per_score) * share // 100
    before, starts = 0, []
    for score, n in per_score:
        if before >= drawn:
            break
        starts.append((score, before))
        before += n
    spark = scored.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "score long, before long"))
    marked = rows.join(offsets, "score", "left").withColumn("near", F.col("eligible") & F.col("before").isNotNull())
    among = Window.partitionBy("score").orderBy("id")
    place = marked.where("near").withColumn("rank", (F.col("before") + F.row_number().over(among)).cast("long"))
    place = place.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = marked.where("NOT near").withColumn("rank", F.lit(None).cast("long"))
    return place.unionByName(rest).drop("before", "near", "eligible")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    least: int = LEAST,
    most: int = MOST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Every row of docs: id, n_features, weight, score, and the rank in the draw (null if not drawn).

    Words are runs of digits, small letters (A-Z become small) and characters outside ASCII;
    features are all runs of `least` to `most` words, repeats counted. A feature's bucket is the
    checksum of its bytes modulo `buckets`; a bucket's gain compares its smoothed shares in
    target and docs; a row's weight is the floored mean of its gains. Rows with at least
    `min_words` words compete for `percent` % of their number by weight and a noise of the id.

    A null or empty text has no features and weight 0. A row without an id has a weight, but no
    score, and takes no part in the draw. Rows that share id and score are ranked one after the
    other. An empty target gives every bucket its share of nothing; empty docs give no rows. Long texts
    are scanned whole. Other columns are not read.
    """
    found = written(features(docs, id_col, text_col, least, most, buckets))
    aim = features(target.select(F.lit(0).alias("_id"), F.col(target_text).alias("_text")), "_id", "_text", least, most, buckets)
    gain = gains(counts(found, buckets), counts(aim, buckets))
    scored = cut(weighted(found, gain).withColumn("score", F.col("weight") + noise(seed)))
    out = ranked(scored, F.col("n_words") >= min_words, percent)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
