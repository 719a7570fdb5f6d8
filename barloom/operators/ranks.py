"""Exact order statistics without sorting a series in one task.

Values are first counted per *bin*, an order-preserving code of the value that
needs no look at the data.  Running bin counts give every bin its rank offset,
so a rank is an offset plus a position inside one bin, and a quantile touches
only the bins that hold its neighbours.  Bins are fine (50,000 per factor of e)
and ties are collapsed to counts before any bin is ordered, so a value that
fills a third of a series is one row there.  A null key is a key like any other; null
and NaN values are missing and have no rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.schema import quoted

BINS_PER_E_FOLD = 50_000
# Beyond the exponent range of doubles, so positive codes stay positive.
_CODE_BASE = 800 * BINS_PER_E_FOLD
_SALTS = 64
_BIN = "_bin"


def order_bin(value: str) -> Column:
    """A code that never decreases as the value grows; zero has its own."""
    # Spark's ln is the strict one, equal on every machine and monotonic.  The
    # bound keeps infinities among the codes.
    size = (
        f"(floor(least(ln(abs({value})), 750.0D) * {BINS_PER_E_FOLD}.0D) + {_CODE_BASE})"
    )
    return F.expr(
        f"CASE WHEN {value} > 0 THEN {size} WHEN {value} < 0 THEN -{size}"
        f" ELSE CAST(0 AS BIGINT) END"
    )


def salt_of(spread: str | Column, salts: int = _SALTS) -> Column:
    """A repeatable salt from a column that varies within a key, such as the time."""
    return F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")


def spread_join(
    large: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    *,
    spread: str,
    salts: int = _SALTS,
) -> DataFrame:
    """Inner join of many rows per key with one.

    Both sides meet by key and salt: one hot key is spread over ``salts`` tasks,
    and only the small side is repeated.  There is no broadcast hint, since the
    small side grows with the number of keys; Spark broadcasts it when its
    measured size passes the threshold.
    """
    salted = large.withColumn("_salt", salt_of(spread, salts))
    copies = per_key.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies, [*keys, "_salt"], "inner").drop("_salt")


def wrapped_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key as a struct of itself, which is never null.

    Joins on the keys then find null keys as well, and stay plain equi-joins that share
    the shuffles of groupings by the same keys.
    """
    return df.withColumns({k: F.struct(F.col(quoted(k)).alias("key")) for k in keys})


def unwrapped_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.col(quoted(k))["key"] for k in keys})


def _binned(rows: DataFrame, keys: Sequence[str], value: str, copies: str | None) -> DataFrame:
    counted = F.lit(1) if copies is None else F.col(copies)
    named = rows.select(*keys, F.col(value).alias("_value"), counted.alias("_n"))
    return named.where("_value IS NOT NULL AND NOT isnan(_value)").withColumn(
        _BIN, order_bin("_value")
    )


def _values_and_offsets(
    rows: DataFrame, keys: Sequence[str], value: str, copies: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Distinct values with their copies, and each bin's first rank (from 0) and size.

    Values are counted on the map side before they are shuffled.
    """
    by = [*keys, _BIN]
    collapsed = (
        _binned(rows, keys, value, copies)
        .groupBy(*by, "_value")
        .agg(F.sum("_n").alias("_copies"))
    )
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(_BIN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        collapsed.groupBy(*by)
        .agg(F.sum("_copies").alias("_size"))
        .withColumns(
            {
                "_start": F.sum("_size").over(upto) - F.col("_size"),
                "_total": F.sum("_size").over(whole),
            }
        )
    )
    return collapsed, offsets


def _with_first_rank(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the first rank (from 0) of each distinct value of a bin."""
    upto = (
        Window.partitionBy(*keys, _BIN)
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.sum("_copies").over(upto) - F.col("_copies")
    return candidates.withColumn("_first", F.col("_start") + before)


def exact_quantiles(
    rows: DataFrame,
    quantiles: Mapping[str, float],
    *,
    keys: Sequence[str],
    value: str,
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column each."""
    return unwrapped_keys(
        wrapped_quantiles(wrapped_keys(rows, keys), quantiles, keys=keys, value=value), keys
    )


def wrapped_quantiles(
    rows: DataFrame,
    quantiles: Mapping[str, float],
    *,
    keys: Sequence[str],
    value: str,
    copies: str | None = None,
) -> DataFrame:
    """:func:`exact_quantiles` of rows whose keys are not null, e.g. :func:`wrapped_keys`.

    ``copies`` names a column that says for how many values a row stands.
    """
    position = {
        name: F.lit(float(q)) * (F.col("_total") - 1) for name, q in quantiles.items()
    }
    ranks = F.array(
        *[F.floor(p).cast("bigint") for p in position.values()],
        *[F.ceil(p).cast("bigint") for p in position.values()],
    )
    inside = F.array_distinct(
        F.filter(
            ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_size"))
        )
    )
    collapsed, offsets = _values_and_offsets(rows, keys, value, copies)
    wanted = offsets.withColumn("_ranks", inside).where(F.size("_ranks") > 0).drop("_size")
    candidates = collapsed.join(wanted, [*keys, _BIN], "inner")
    picked = (
        _with_first_rank(candidates, keys)
        .withColumn("_rank", F.explode("_ranks"))
        .where("_rank >= _first AND _rank < _first + _copies")
    )
    ends = []
    for name, p in position.items():
        for side, rank in (("lo", F.floor(p)), ("hi", F.ceil(p))):
            found = F.when(F.col("_rank") == rank, F.col("_value"))
            ends.append(F.max(found).alias(f"_{side}_{name}"))
    return (
        picked.groupBy(*keys, "_total")
        .agg(*ends)
        .select(
            *keys,
            *[
                (
                    F.col(f"_lo_{name}")
                    + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (p - F.floor(p))
                ).alias(name)
                for name, p in position.items()
            ],
        )
    )


def ranked_values(rows: DataFrame, *, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values with their copies, first rank (from 1) and series size.

    Columns: keys, ``value``, ``copies``, ``first_rank``, ``n``.
    """
    collapsed, offsets = _values_and_offsets(wrapped_keys(rows, keys), keys, value)
    placed = collapsed.join(offsets.drop("_size"), [*keys, _BIN], "inner")
    ranked = _with_first_rank(placed, keys).select(
        *keys,
        F.col("_value").alias("value"),
        F.col("_copies").alias("copies"),
        (F.col("_first") + 1).alias("first_rank"),
        F.col("_total").alias("n"),
    )
    return unwrapped_keys(ranked, keys)


_RUN = 4_096


def ranked_points(rows: DataFrame, *, keys: Sequence[str], value: str) -> DataFrame:
    """One row per value in rank order: keys, ``rank`` (from 1), ``value``, ``n``.

    A value with many copies is cut into runs that are spread again before they
    are written out row by row; all other rows stay where they are.
    """
    ranked = ranked_values(rows, keys=keys, value=value)
    few = ranked.where(F.col("copies") <= _RUN).select(
        *keys,
        F.explode(
            F.sequence(F.col("first_rank"), F.col("first_rank") + F.col("copies") - 1)
        ).alias("rank"),
        "value",
        "n",
    )
    runs = ranked.where(F.col("copies") > _RUN).select(
        *keys,
        "value",
        "n",
        "first_rank",
        "copies",
        F.explode(
            F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / F.lit(_RUN)).cast("int"))
        ).alias("_run"),
    )
    first = F.col("first_rank") + F.col("_run") * F.lit(_RUN)
    last = F.least(
        first + F.lit(_RUN - 1), F.col("first_rank") + F.col("copies") - F.lit(1)
    )
    many = runs.repartition(*keys, "value", "_run").select(
        *keys, F.explode(F.sequence(first, last)).alias("rank"), "value", "n"
    )
    return few.unionByName(many)
