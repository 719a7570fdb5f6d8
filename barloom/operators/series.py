"""Ordered work over a long series, cut into time blocks.

A window partitioned by symbol alone puts a symbol's whole history into one
task.  Here the window is partitioned by ``(symbol, block)`` instead, where a
block is a fixed number of days.  A block of bars holds at most
``block length / bar length`` rows whatever the size of the table.  Two kinds of
extra rows make the result equal to the whole-series window:

* *halo* rows: the last ``lookback`` rows before the block, so that row frames
  of that length see their predecessors even when earlier blocks are sparse;
* one *carry* row per block, holding running totals or the last value of all
  earlier blocks, so that frames from the start of the series continue them.

Both come from per-block digests (the last rows, the totals) that are reduced on
the map side before anything is shuffled; the bars themselves are shuffled once.
Added rows sort before the block's own and are removed at the end.

Columns are mostly given as SQL text: a plan of some forty expressions is then a
few calls to the JVM instead of hundreds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barloom.functions.timegrid import day_number_sql
from barloom.schema import KEYS, TIMESTAMP, quoted, require_columns

# 28 days of one-minute bars are at most 40,320 rows a block.
DEFAULT_BLOCK_DAYS = 28
# Block length per timeframe that keeps the same bound; daily history is short
# enough (about 250 bars a year) for one window per symbol.
BLOCK_DAYS: dict[str, int | None] = {"1m": 28, "5m": 140, "30m": 840, "1h": 1680, "1d": None}

_BLOCK = "_block"
_KIND = "_kind"
_OWN, _HALO, _CARRY = 0, 1, 2
BLOCK_COLUMN, KIND_COLUMN, CARRY_ROW = _BLOCK, _KIND, _CARRY


@dataclass(frozen=True)
class SeriesWindow:
    """The window of one series (or block) in time order, as SQL text."""

    partition: tuple[str, ...]
    ts: str
    real: str
    """Condition that is true on bars and false on the carry row of a block."""
    in_blocks: bool
    ties: tuple[str, ...] = ()
    """Columns that order rows of one time."""

    def _over(self, rows: str = "") -> str:
        first = f"{_KIND} DESC, " if self.in_blocks else ""
        by = ", ".join(self.partition)
        return f"OVER (PARTITION BY {by} ORDER BY {first}{', '.join((self.ts, *self.ties))}{rows})"

    @property
    def ordered(self) -> str:
        return self._over()

    def last(self, n: int) -> str:
        return self._over(f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")

    @property
    def running(self) -> str:
        return self._over(" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    @property
    def before(self) -> str:
        return self._over(" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")

    def running_product(self, column: str) -> Column:
        """SQL has no product; this is the one column built from the function."""
        order = [*([F.desc(_KIND)] if self.in_blocks else []), self.ts, *self.ties]
        spec = Window.partitionBy(*self.partition).orderBy(*order)
        return F.product(column).over(
            spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )


# Columns by name; a later stage may use those of earlier ones.  Names start with
# an underscore and do not reach the result.
Stages = list[dict[str, str | Column]]


def over_series(
    df: DataFrame,
    stages: Callable[[SeriesWindow], Stages],
    outputs: Mapping[str, str],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    lookback: int = 0,
    carry: Mapping[str, tuple[str, str]] | None = None,
    block_days: int | None = DEFAULT_BLOCK_DAYS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Compute columns over every series of ``df`` in time order.

    ``outputs`` are the columns to add or replace, over the columns of the
    frame and of ``stages``.  ``lookback`` is the number of earlier rows a row's
    result depends on.  ``carry`` names columns to add, each with its expression
    and what the carry row holds of the earlier blocks: the ``sum`` or
    ``product`` of the column, its ``last`` value, or its ``last_valid``
    (non-null) value.  Stages can then use ``running`` frames, or look one row
    back, without a halo.  ``block_days=None`` uses one window per series.

    ``tiebreak`` names columns that order rows of one series and time.  Where such
    rows exist, as in a union of days, results are only defined with it; rows that
    are equal in it too have to be equal in what is computed from.
    """
    if block_days is None:
        require_columns(df, [*keys, ts, *tiebreak])
        added = [f"{expr} AS {name}" for name, (expr, _) in (carry or {}).items()]
        rows = df.selectExpr("*", *added) if added else df
        ties = tuple(quoted(c) for c in tiebreak)
        window = SeriesWindow(tuple(map(quoted, keys)), quoted(ts), "true", in_blocks=False, ties=ties)
        return _computed(rows, window, stages, outputs, df.columns)
    rows = with_context(
        df, keys=keys, ts=ts, lookback=lookback, carry=carry, block_days=block_days, tiebreak=tiebreak
    )
    return over_context(rows, stages, outputs, df.columns, keys=keys, ts=ts, tiebreak=tiebreak)


def with_context(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    lookback: int = 0,
    carry: Mapping[str, tuple[str, str]] | None = None,
    block_days: int = DEFAULT_BLOCK_DAYS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The rows of every block, with its halo and carry rows: what :func:`over_context` needs.

    Adds the carried columns, the block and the kind of row.
    """
    require_columns(df, [*keys, ts, *tiebreak])
    carried = dict(carry or {})
    added = [f"{expr} AS {name}" for name, (expr, _) in carried.items()]
    block = f"CAST(floor({day_number_sql(ts)} / {block_days}) AS INT) AS {_BLOCK}"
    own = df.selectExpr("*", *added, block)
    return _with_context(own, carried, [*map(quoted, keys), _BLOCK], keys, [ts, *tiebreak], lookback)


def over_context(
    rows: DataFrame,
    stages: Callable[[SeriesWindow], Stages],
    outputs: Mapping[str, str],
    columns: Sequence[str],
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Compute columns over rows of :func:`with_context`; ``columns`` are those to keep."""
    by_block = (*map(quoted, keys), _BLOCK)
    ties = tuple(quoted(c) for c in tiebreak)
    window = SeriesWindow(by_block, quoted(ts), f"{_KIND} <> {_CARRY}", in_blocks=True, ties=ties)
    return _computed(rows, window, stages, outputs, columns)


def _computed(
    rows: DataFrame,
    window: SeriesWindow,
    stages: Callable[[SeriesWindow], Stages],
    outputs: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    for stage in stages(window):
        rows = rows.select("*", *[_named(expr, name) for name, expr in stage.items()])
    if window.in_blocks:
        rows = rows.where(f"{_KIND} = {_OWN}")
    kept = [f"{outputs[c]} AS {quoted(c)}" if c in outputs else quoted(c) for c in columns]
    new = [f"{expr} AS {quoted(c)}" for c, expr in outputs.items() if c not in columns]
    return rows.selectExpr(*kept, *new)


def _named(expr: str | Column, name: str) -> Column:
    return expr.alias(name) if isinstance(expr, Column) else F.expr(f"{expr} AS {name}")


def _with_context(
    own: DataFrame,
    carried: Mapping[str, tuple[str, str]],
    block_keys: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
) -> DataFrame:
    """The bars of each block together with its halo and carry rows."""
    parts = [own.selectExpr("*", f"{_OWN} AS {_KIND}")]
    if lookback:
        # Totals reach a block through its carry row alone.
        totals = {name for name, (_, how) in carried.items() if how in ("sum", "product")}
        payload = [
            quoted(c) for c in own.columns if c not in {*keys, _BLOCK} and c not in totals
        ]
        parts.append(_halo(own, payload, block_keys, order, lookback))
    if carried:
        parts.append(_carry_rows(own, carried, block_keys, order))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _halo(
    own: DataFrame,
    payload: Sequence[str],
    block_keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
) -> DataFrame:
    """The ``lookback`` rows before each block, labelled with that block.

    Taking the last rows of every block is a group limit, which Spark applies
    before the shuffle.  The per-series window then sees only those: at most
    ``lookback`` rows per block.
    """
    descending = ", ".join(f"{quoted(c)} DESC" for c in order)
    newest_first = f"PARTITION BY {', '.join(block_keys)} ORDER BY {descending}"
    tails = (
        own.selectExpr("*", f"row_number() OVER ({newest_first}) AS _age")
        .where(f"_age <= {lookback}")
        .selectExpr(*block_keys, f"struct({', '.join(payload)}) AS _row")
    )
    by_time = f"PARTITION BY {', '.join(block_keys[:-1])} ORDER BY {', '.join(f'_row.{quoted(c)}' for c in order)}"
    earlier = f"ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING"
    return (
        tails.selectExpr(
            *block_keys,
            f"collect_list(_row) OVER ({by_time} {earlier}) AS _earlier",
            f"lag({_BLOCK}) OVER ({by_time}) AS _previous",
        )
        .where(f"_previous < {_BLOCK}")
        .selectExpr(*block_keys, "inline(_earlier)", f"{_HALO} AS {_KIND}")
    )


def _block_digest(name: str, how: str, order: Sequence[str]) -> Column:
    # A struct only where it is needed: Spark aggregates those by sorting.
    at = F.col(quoted(order[0])) if len(order) == 1 else F.struct(*[F.col(quoted(c)) for c in order])
    match how:
        case "sum":
            digest = F.sum(name)
        case "product":
            digest = F.product(name)
        case "last":
            digest = F.max_by(name, at)
        case "last_valid":
            digest = F.max_by(name, F.when(F.col(name).isNotNull(), at))
        case _:
            raise ValueError(f"unknown carry {how!r}")
    return digest.alias(name)


def _carried_value(name: str, how: str, by_block: WindowSpec) -> Column:
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    match how:
        case "sum":
            value = F.sum(name).over(earlier)
        case "product":
            value = F.product(name).over(earlier)
        case "last":
            value = F.lag(name).over(by_block)
        case _:
            value = F.last(name, ignorenulls=True).over(earlier)
    return value.alias(name)


def _carry_rows(
    own: DataFrame,
    carried: Mapping[str, tuple[str, str]],
    block_keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """What each block needs to know of all earlier ones, one row per block."""
    digests = own.groupBy(*block_keys).agg(
        *[_block_digest(name, how, order) for name, (_, how) in carried.items()]
    )
    by_block = Window.partitionBy(*block_keys[:-1]).orderBy(_BLOCK)
    return digests.select(
        *block_keys,
        *[_carried_value(name, how, by_block) for name, (_, how) in carried.items()],
        F.lit(_CARRY).alias(_KIND),
    )


def in_lockstep(stage_lists: Sequence[Stages]) -> Stages:
    """Merge the stages of several indicators: stage ``i`` of all in one projection.

    Catalyst then plans one Window node per stage and computes each column once.
    """
    merged: Stages = []
    for i in range(max(len(s) for s in stage_lists)):
        merged.append({k: v for s in stage_lists if i < len(s) for k, v in s[i].items()})
    return merged
