"""Mixing sources to target weights by pivotal dependent rounding, in built-in expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut, word_count

# Documents, or residuals, that one fold of the reduction tree settles.
FOLD = 512
# No document is taken more often than this, no source beyond this many times its size.
MOST = 3


def targets(sizes: DataFrame, weights: int = 3, most: int = MOST) -> DataFrame:
    """Per source: source, n, source_size and target, the words that the mix takes of it.

    Sources by code point, null last, weigh 1, 2, ... `weights`, and again. They share
    the words of all; what a target has beyond `most` times its source's size is shared
    anew by weight until none is above. That is a common level: sources by the ratio of
    limit to weight, the first ones are full, the rest divide what these leave.
    One row a source is all that is windowed here.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    per = per.withColumn("w", (F.row_number().over(by_name) - 1) % weights + 1)
    per = per.withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("at", F.row_number().over(by_ratio))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    )
    opens = F.col("cap") * F.col("rest_w") > F.col("left") * F.col("w")
    first = F.min(F.when(opens, F.struct("at", "left", "rest_w"))).over(everything)
    full = F.col("first").isNull() | (F.col("at") < F.col("first.at"))
    shared = (F.col("first.left") * F.col("w")).cast("double") / F.col("first.rest_w")
    return per.withColumn("first", first).select(
        "source", "n", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(shared).alias("target")
    )


def _uniform(*parts: Column) -> Column:
    """In [0, 1), the same for the same parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pair(acc: Column, x: Column, seed: int) -> Column:
    """One pairing: words move between two documents until one of them is settled."""
    c = acc["carry"]
    rise = F.least((1 - c["p"]) * c["size"], x["p"] * x["size"])
    fall = F.least(c["p"] * c["size"], (1 - x["p"]) * x["size"])
    up = _uniform(c["h"], x["h"], F.lit(seed)) * (rise + fall) <= fall
    c_up, x_up = (1 - c["p"]) * c["size"] <= x["p"] * x["size"], c["p"] * c["size"] <= (1 - x["p"]) * x["size"]

    def settled(d: Column, value: int) -> Column:
        return F.concat(acc["done"], F.array(F.struct(d["doc_id"].alias("doc_id"), d["size"].alias("size"), F.lit(value).alias("more"))))

    def moved(d: Column, other: Column, sign: int, all_of: Column) -> Column:
        p = F.least(F.greatest(d["p"] + sign * all_of * other["size"] / d["size"], F.lit(0.0)), F.lit(1.0))
        return F.struct(d["order"].alias("order"), d["h"].alias("h"), d["doc_id"].alias("doc_id"), d["size"].alias("size"), p.alias("p"))

    def state(done: Column, carry: Column) -> Column:
        return F.struct(done.alias("done"), carry.alias("carry"))

    raised = F.when(c_up, state(settled(c, 1), moved(x, c, -1, 1 - c["p"]))).otherwise(
        state(settled(x, 0), moved(c, x, 1, x["p"]))
    )
    lowered = F.when(x_up, state(settled(c, 0), moved(x, c, 1, c["p"]))).otherwise(
        state(settled(x, 1), moved(c, x, -1, 1 - x["p"]))
    )
    first = state(acc["done"], x)
    return F.when(c.isNull(), first).when(up, raised).otherwise(lowered)


def _fold(items: DataFrame, id_type: str, level: int, seed: int) -> DataFrame:
    """Per source and chunk: the settled documents and one that is still open."""
    item = F.struct((-F.col("size")).alias("order"), "h", "doc_id", "size", "p")
    start = f"named_struct('done', CAST(array() AS array<struct<doc_id:{id_type},size:bigint,more:int>>), 'carry', CAST(NULL AS struct<order:bigint,h:bigint,doc_id:{id_type},size:bigint,p:double>))"
    return (
        items.groupBy("source", "chunk")
        .agg(F.sort_array(F.collect_list(item)).alias("items"), F.first("chunks").alias("chunks"))
        .select(
            "source", "chunk", "chunks",
            F.aggregate("items", F.expr(start), lambda acc, x: _pair(acc, x, seed * 1000 + level)).alias("r"),
        )
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, whole: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, part and taken of every document.

    With r = target / source_size of its source, a document is taken floor(r) times or
    once more. The fractions are settled by the pivotal method in words: two open
    documents exchange words at random, without drift, until one is taken once more or
    not, so the words of a source stay as they are. Of the document that is open at the
    end, one a source, the mix takes the open share of its words (part); if `whole`, a
    draw decides whether it is taken once more.
    Documents fight in hashed chunks of about FOLD, the larger first; what each chunk
    leaves open fights on in the next level of the tree, down to one a source. A hot
    source is so many chunks more. Draws are hashes of ids and texts: reruns agree.

    A null or empty text has size 0 and is taken with 0 words. Null sources are a
    source of their own, null and repeated ids are documents like any other, of equal
    rows any may be the one that is taken more often. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    # Rows without an id are told apart by their texts.
    h = F.xxhash64(F.col(id_col), text, F.lit(seed)).alias("h")
    sizes = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"), h))
    per = cut(targets(sizes))
    per = per.withColumn("ratio", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    per = per.withColumn("base", F.floor("ratio").cast("int")).withColumn("p", F.col("ratio") - F.col("base"))
    per = per.withColumn("chunks", F.ceil(F.col("n") / FOLD))
    most = per.agg(F.max("chunks")).first()[0] or 1

    rows = sizes.join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    done = [rows.where(~open_).select("source", "doc_id", "size", F.lit(0).alias("more"))]
    items = rows.where(open_).select("source", "doc_id", "size", "h", "p", "chunks", F.pmod("h", F.col("chunks")).alias("chunk"))
    level = 0
    while True:
        folded = cut(_fold(items, id_type, level, seed))
        done.append(folded.select("source", F.inline("r.done")))
        carry = folded.select("source", "chunk", "chunks", "r.carry.*")
        if most <= 1:
            break
        most, level = -(-most // FOLD), level + 1
        items = carry.withColumn("chunks", F.ceil(F.col("chunks") / FOLD)).withColumn("chunk", F.pmod("chunk", F.col("chunks")))
    share = F.round(F.col("p") * F.col("size")).cast("long")
    drawn = (_uniform(F.col("h"), F.lit(seed * 1000 + 999)) < F.col("p")).cast("int")
    more = drawn if whole else F.floor(share / F.col("size")).cast("int")
    part = F.lit(0).cast("long") if whole else share % F.col("size")
    settled = reduce(DataFrame.union, done).withColumn("part", F.lit(0).cast("long"))
    settled = settled.union(carry.select("source", "doc_id", "size", more, part))
    per = per.select(F.col("source").alias("s"), "source_size", "target", "base")
    copies = F.col("base") + F.col("more")
    return settled.join(per, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), "part", (copies * F.col("size") + F.col("part")).alias("taken"),
    )


def repeat(docs: DataFrame, text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it: not at all, or up to MOST times.

    Rows are told apart by a hash of all columns; of equal rows one stands for all.
    """
    keyed = docs.withColumn("_row_", F.xxhash64(*docs.columns))
    mixed = mix(keyed, "_row_", text_col, source_col, seed, whole=True)
    copies = mixed.groupBy("_row_").agg(F.sum("copies").cast("int").alias("_copies_"), F.count("*").alias("_rows_"))
    met = keyed.join(cut(copies.where("_copies_ > 0")), "_row_")
    again = F.explode(F.sequence(F.lit(1), F.col("_copies_"))).alias("_copy_")
    single = met.where("_rows_ = 1").select(*docs.columns, again).drop("_copy_")
    equal = met.where("_rows_ > 1").dropDuplicates(["_row_"]).select(*docs.columns, again).drop("_copy_")
    return single.union(equal)
