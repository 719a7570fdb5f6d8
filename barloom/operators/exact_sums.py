"""Sums of doubles that do not depend on the order of rows: exact, and rounded once.

A value is cut into whole digits of 18 bits on a fixed grid, which loses nothing.  Digits of
one place are added as integers, so partial sums of tasks meet in any order.  Only
the few totals of a series are put together and rounded, to the double nearest the true sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import inf, nan

from pyspark.sql import DataFrame, Window, functions as F

from barloom.operators.indicators import vwap_of
from barloom.operators.series import (
    BLOCK_COLUMN,
    CARRY_ROW,
    DEFAULT_BLOCK_DAYS,
    KIND_COLUMN,
    over_context,
    with_context,
)
from barloom.schema import KEYS, TIMESTAMP, quoted, require_columns

# Bits of a digit: 4 of them hold the 53 bits of a double wherever they begin in the first.
# A sum of digits has room for 2^45 rows of one series.
_BITS, _DIGITS = 18, 4


def _digits(j: int) -> list[dict[str, str]]:
    """Columns, step by step, that cut the value ``_x{j}``; null for zero and what is not finite."""
    x, rest = f"_x{j}", f"_rest{j}"
    half = f"pow(2.0D, -{_BITS // 2} * _band{j})"
    steps = [
        {f"_band{j}": f"CASE WHEN abs({x}) < double('Infinity') AND {x} <> 0 THEN CAST(floor(log2(abs({x})) / {_BITS}) AS INT) END"},
        # In two steps, as the power itself may be out of range.
        {f"{rest}_0": f"{x} * {half} * {half}"},
    ]
    for d in range(_DIGITS):
        steps.append({f"_d{j}_{d}": f"CAST({rest}_{d} AS BIGINT)"})
        if d + 1 < _DIGITS:
            steps.append({f"{rest}_{d + 1}": f"({rest}_{d} - _d{j}_{d}) * {2.0**_BITS!r}D"})
    return steps


def _rounded(j: int) -> list[dict[str, str]]:
    """Columns, step by step, from sums of digits by place ``_parts{j}`` to the nearest double ``_sum{j}``."""
    parts, low, cells, signed, digits, top = (f"_{n}{j}" for n in ("parts", "low", "cells", "signed", "digits", "top"))

    def carried(values: str) -> str:
        empty = "struct(0L AS carry, CAST(array() AS ARRAY<BIGINT>) AS ds)"
        step = f"struct(shiftright(a.carry + d, {_BITS}) AS carry, array_append(a.ds, (a.carry + d) & {2**_BITS - 1}L) AS ds)"
        return f"aggregate({values}, {empty}, (a, d) -> {step})"

    def digit(below: int) -> str:
        return f"coalesce(get({digits}, {top} - {below}), 0L)"

    lost = f"array_max(transform({digits}, (d, i) -> IF(i < {top} - 3 AND d <> 0, 1L, 0L)))"
    power = f"{_BITS} * ({low} + {top} - 3)"
    size = f"_size{j} * pow(2.0D, floor({power} / 2)) * pow(2.0D, {power} - floor({power} / 2))"
    return [
        {low: f"array_min(transform({parts}, x -> x.place))"},
        # Four places more than the last, for what is carried up.
        {
            cells: f"transform(sequence({low}, array_max(transform({parts}, x -> x.place)) + 4),"
            f" q -> aggregate(filter({parts}, x -> x.place = q), 0L, (a, x) -> a + x.d))"
        },
        {signed: carried(cells)},
        {digits: f"IF({signed}.carry < 0, {carried(f'transform({cells}, d -> -d)')}.ds, {signed}.ds)"},
        {top: f"array_max(transform({digits}, (d, i) -> IF(d <> 0, i, -1)))"},
        # The highest four digits as two exact halves, the last bit set if anything lies below:
        # over 54 bits, so that the one addition rounds as the whole would.
        {
            f"_size{j}": f"CAST({digit(0)} * {2**_BITS}L + {digit(1)} AS DOUBLE) * {4.0**_BITS!r}D"
            f" + CAST(({digit(2)} * {2**_BITS}L + {digit(3)}) | {lost} AS DOUBLE)"
        },
        {f"_sum{j}": f"CASE WHEN coalesce({top}, -1) < 0 THEN 0.0D WHEN {signed}.carry < 0 THEN -({size}) ELSE {size} END"},
    ]


def exact_sums(df: DataFrame, sums: Mapping[str, str], *, keys: Sequence[str] = KEYS) -> DataFrame:
    """The keys and, for each name, the sum of its SQL expression as the nearest double.

    Null is left out; a sum of nothing is null.  NaN, or infinities of both signs, give NaN,
    infinities of one sign themselves, and a sum beyond the doubles an infinity.  A null key is
    a key like any other.  Rows are combined by series and bands before they are shuffled:
    a hot series sends some rows a task.  Give few expressions at a time, since
    the rows a task sends are the combinations of their bands.
    """
    require_columns(df, keys)
    by = [f"_k{i}" for i in range(len(keys))]
    rows = df.selectExpr(
        *[f"{quoted(k)} AS {n}" for k, n in zip(keys, by, strict=True)],
        *[f"CAST({sql} AS DOUBLE) AS _x{j}" for j, sql in enumerate(sums.values())],
    )
    each = range(len(sums))
    for steps in zip(*[_digits(j) for j in each], strict=True):
        rows = rows.selectExpr("*", *[f"{sql} AS {name}" for step in steps for name, sql in step.items()])
    counted = {
        "n": "count(_x{j})",
        "nan": "count_if(isnan(_x{j}))",
        "up": "count_if(_x{j} = double('Infinity'))",
        "down": "count_if(_x{j} = double('-Infinity'))",
    }
    parts = rows.groupBy(*by, *[f"_band{j}" for j in each]).agg(
        *[F.sum(f"_d{j}_{d}").alias(f"_d{j}_{d}") for j in each for d in range(_DIGITS)],
        *[F.expr(sql.format(j=j)).alias(f"_{name}{j}") for j in each for name, sql in counted.items()],
    )
    placed = {j: ", ".join(f"struct(_band{j} - {d} AS place, _d{j}_{d} AS d)" for d in range(_DIGITS)) for j in each}
    whole = parts.groupBy(*by).agg(
        *[
            F.expr(f"flatten(collect_list(CASE WHEN _band{j} IS NOT NULL THEN array({placed[j]}) END))").alias(f"_parts{j}")
            for j in each
        ],
        *[F.sum(f"_{name}{j}").alias(f"_{name}{j}") for j in each for name in counted],
    )

    def total(j: int):
        up, down = F.col(f"_up{j}") > 0, F.col(f"_down{j}") > 0
        return (
            F.when(F.col(f"_n{j}") == 0, F.lit(None))
            .when((F.col(f"_nan{j}") > 0) | (up & down), F.lit(nan))
            .when(up, F.lit(inf))
            .when(down, F.lit(-inf))
            .otherwise(F.col(f"_sum{j}"))
        )

    for steps in zip(*[_rounded(j) for j in each], strict=True):
        whole = whole.selectExpr("*", *[f"{sql} AS {name}" for step in steps for name, sql in step.items()])
    return whole.select(
        *[F.col(n).alias(k) for n, k in zip(by, keys, strict=True)],
        *[total(j).alias(name) for j, name in enumerate(sums)],
    )


def exact_vwap(
    df: DataFrame, *, price: str = "(high + low + close) / 3.0D", volume: str = "volume", keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row a series: turnover, volume and the mean price by volume, whatever the order of rows.

    ``price`` and ``volume`` are SQL.  Rows count where both are known; null where no volume was traded.
    """
    known = f"CASE WHEN ({price}) IS NOT NULL THEN {volume} END"
    sums = exact_sums(df, {"turnover": f"({price}) * ({volume})", "traded": known}, keys=keys)
    return sums.withColumn("vwap", F.try_divide("turnover", "traded"))


def with_exact_vwap(
    df: DataFrame,
    name: str = "vwap",
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    block_days: int = DEFAULT_BLOCK_DAYS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The running VWAP of ``indicators.with_vwap``, the same to the last bit however rows are dealt.

    What blocks hold is summed exactly, blocks are added in their order, rows of a block in
    theirs.  Rows of one series and time need a ``tiebreak``, or have to be equal.
    """
    indicator = vwap_of(name)
    require_columns(df, [*keys, ts, *indicator.needs])
    added = {column: sql for column, (sql, _) in indicator.carry.items()}
    rows = with_context(
        df.selectExpr("*", *[f"{sql} AS {column}" for column, sql in added.items()]),
        keys=keys, ts=ts, block_days=block_days, tiebreak=tiebreak,
    )
    by_block = [*keys, BLOCK_COLUMN]
    earlier = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(BLOCK_COLUMN).rowsBetween(Window.unboundedPreceding, -1)
    carried = exact_sums(rows, {c: c for c in added}, keys=by_block).select(
        *[F.col(quoted(k)) for k in by_block],
        *[F.sum(c).over(earlier).alias(c) for c in added],
        F.lit(CARRY_ROW).alias(KIND_COLUMN),
    )
    return over_context(
        rows.unionByName(carried, allowMissingColumns=True),
        indicator.stages, indicator.outputs, df.columns, keys=keys, ts=ts, tiebreak=tiebreak,
    )
