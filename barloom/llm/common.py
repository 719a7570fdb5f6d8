"""What several operators share: tables, cutting of lineage, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are what these six characters and the space leave between them.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session (spark.checkpoint.dir), which all executors share.

    Where none is set, a local session (tests) gets a temporary one; a cluster has to name one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="barloom-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The rows of df, as a table of their own in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared checkpoint folder, without their lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# Bits of a sieve: its maps are a megabyte in all, whatever the number of keys.
SIEVE_BITS = 1 << 23


def sieve(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows of df whose key may be in `wanted`, none of those lost, others by chance."""
    return marked(df, key, wanted, wanted_key).where("_maybe_").drop("_maybe_")


def marked(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """df with a column _maybe_: false where the key is surely not in `wanted`.

    Keys are longs, hashes for choice. A bit is set for every wanted key; the maps of bits
    have a fixed size and are broadcast, so rows are left out before they are shuffled.
    The more keys there are, the fewer rows it keeps back.
    """

    def slot(c: Column) -> Column:
        return F.pmod(c, F.lit(SIEVE_BITS)) + 1

    bits = wanted.where(F.col(wanted_key).isNotNull()).select(slot(F.col(wanted_key)).alias("slot"))
    maps = bits.groupBy(F.bitmap_bucket_number("slot").alias("_map_")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits_")
    )
    place = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substr("_bits_", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = df.withColumn("_map_", F.bitmap_bucket_number(slot(key))).join(F.broadcast(maps), "_map_", "left")
    maybe = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return met.withColumn("_maybe_", maybe).drop("_map_", "_bits_")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of each end of the links (a, b): columns id, component.

    Alternates two steps until nothing changes: every neighbour that is larger than
    id gets the smallest neighbour (large star), then every smaller one does (small
    star). Links that repeat collapse before each shuffle; no group is gathered, the
    minimum of a neighbourhood is an aggregate with map-side combine.
    """
    links = cut(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = None
    while True:
        links = _star(_star(links, larger=True), larger=False)
        links = cut(links.distinct())
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    ends = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.union(links.select("v", "v")).distinct()


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (u, v), u > v. Large star looks both ways from u, small star to its smaller ends."""
    seen = links.union(links.select("v", "u")) if larger else links
    least = seen.groupBy("u").agg(F.min("v").alias("low"))
    joined = seen.join(least, "u").withColumn("low", F.least("low", "u"))
    if larger:
        out = joined.where("v > u").selectExpr("v AS u", "low AS v")
    else:
        out = joined.selectExpr("inline(array(struct(u AS u, low AS v), struct(v AS u, low AS v)))")
    return out.where("u != v").distinct()
