"""Data-quality checks.  Each returns a table of verdicts and counts per series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.bar_columns import bar_rules
from barloom.functions.timegrid import (
    bucket_offset,
    epoch_seconds_sql,
    session_of,
    step_seconds,
)
from barloom.operators.changes import with_gap_seconds
from barloom.schema import (
    KEYS,
    OHLCV,
    SESSION,
    TIMEFRAME,
    TIMESTAMP,
    indicator_columns,
    require_columns,
)

# How many bar lengths make a gap, how far VWAP may leave the price
# range, and how much volume a roll-up may lose.
GAP_FACTOR = 1.5
VWAP_SLACK = 0.1
VOLUME_TOLERANCE = 1


def holds(rule: Column) -> Column:
    """True when no row breaks the rule; unknown rows and empty input pass."""
    return F.coalesce(F.bool_and(rule), F.lit(True))


def broken(rule: Column) -> Column:
    return F.count_if(~rule)


def all_of(names: Sequence[str]) -> Column:
    verdict = F.lit(True)
    for n in names:
        verdict = verdict & F.col(n)
    return verdict


def validate_bars(df: DataFrame, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """High on top, low at the bottom, prices positive."""
    rules = bar_rules()
    groups = {
        "high": ("high_ge_open", "high_ge_close", "high_ge_low"),
        "low": ("low_le_open", "low_le_close", "high_ge_low"),
        "price": ("open_positive", "high_positive", "low_positive", "close_positive"),
    }
    checks: list[Column] = []
    for name, members in groups.items():
        rule = rules[members[0]]
        for m in members[1:]:
            rule = rule & rules[m]
        checks += [holds(rule).alias(f"{name}_ok"), broken(rule).alias(f"{name}_violations")]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bars"), *checks)
    return out.withColumn("valid", all_of([f"{g}_ok" for g in groups]))


def validate_rollup(
    fine: DataFrame,
    coarse: DataFrame,
    expected_bars: int | None,
    *,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Bar count, the ten bar rules, and volume conserved within one.

    Every symbol of either side has a row, null symbols too: one that was not rolled up
    has no bars, one that only the coarse frame has misses all its volume in the source.
    Without ``expected_bars`` any number but zero is right.
    """
    require_columns(coarse, OHLCV)
    rules = bar_rules()
    rolled = coarse.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bars"),
        *[holds(rule).alias(name) for name, rule in rules.items()],
        F.coalesce(F.sum("volume"), F.lit(0)).alias("rolled_volume"),
    )
    source = fine.groupBy(*keys).agg(
        F.coalesce(F.sum("volume"), F.lit(0)).alias("source_volume")
    )
    difference = F.abs(F.col("source_volume") - F.col("rolled_volume"))
    # Grouping, unlike a join, takes null keys as equal; there are two rows a key at most.
    both = source.unionByName(rolled, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("source_volume", "n_bars")],
        *[holds(F.col(name)).alias(name) for name in rules],
        F.coalesce(F.max("rolled_volume"), F.lit(0)).alias("rolled_volume"),
    )
    count_ok = F.col("n_bars") > 0 if expected_bars is None else F.col("n_bars") == expected_bars
    return (
        both.withColumns(
            {
                "bar_count_ok": count_ok,
                "volume_difference": difference,
                "volume_ok": difference <= VOLUME_TOLERANCE,
            }
        )
        .withColumn("valid", all_of(["bar_count_ok", *rules, "volume_ok"]))
    )


def validate_metrics(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    indicators: Sequence[str] | None = None,
) -> DataFrame:
    """No missing values, VWAP near the price range, RSI in 0..100, bands in order."""
    require_columns(df, ["high", "low", "vwap", "rsi", "bb_upper", "bb_lower"])
    names = list(indicators) if indicators is not None else indicator_columns(df, [*keys, ts])
    middle = "bb_middle" if "bb_middle" in df.columns else "ma"
    ordered = (F.col("bb_lower") <= F.col(middle)) & (F.col(middle) <= F.col("bb_upper"))
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bars"),
        *[F.count_if(F.col(n).isNull()).alias(f"{n}_nulls") for n in names],
        F.min("low").alias("_low"),
        F.max("high").alias("_high"),
        F.min("vwap").alias("vwap_min"),
        F.max("vwap").alias("vwap_max"),
        F.min("rsi").alias("rsi_min"),
        F.max("rsi").alias("rsi_max"),
        broken(ordered).alias("band_violations"),
    )
    nulls = F.lit(0)
    for n in names:
        nulls = nulls + F.col(f"{n}_nulls")
    verdicts = {
        "nulls_ok": nulls == 0,
        "vwap_ok": (F.col("vwap_min") >= F.col("_low") * F.lit(1 - VWAP_SLACK))
        & (F.col("vwap_max") <= F.col("_high") * F.lit(1 + VWAP_SLACK)),
        "rsi_ok": (F.col("rsi_min") >= 0) & (F.col("rsi_max") <= 100),
        "bands_ok": F.col("band_violations") == 0,
    }
    return (
        stats.withColumns({k: F.coalesce(v, F.lit(True)) for k, v in verdicts.items()})
        .withColumn("valid", all_of(list(verdicts)))
        .drop("_low", "_high")
    )


def range_consistency(
    frames: Mapping[str, DataFrame], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Lowest low and highest high of each symbol, and whether all timeframes agree."""
    parts = [
        df.groupBy(*keys).agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
        for df in frames.values()
    ]
    ranges = parts[0]
    for p in parts[1:]:
        ranges = ranges.unionByName(p)
    return ranges.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_timeframes"),
        F.min("_low").alias("low"),
        F.max("_high").alias("high"),
        F.coalesce(
            (F.min("_low") == F.max("_low")) & (F.min("_high") == F.max("_high")), F.lit(True)
        ).alias("consistent"),
    )


def range_consistency_long(
    stacked: DataFrame, *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """:func:`range_consistency` on a long table, in one pass."""
    ranges = stacked.groupBy(*keys, TIMEFRAME).agg(
        F.min("low").alias("_low"), F.max("high").alias("_high")
    )
    return ranges.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_timeframes"),
        F.min("_low").alias("low"),
        F.max("_high").alias("high"),
        F.coalesce(
            (F.min("_low") == F.max("_low")) & (F.min("_high") == F.max("_high")), F.lit(True)
        ).alias("consistent"),
    )


def bar_spacing(
    df: DataFrame, timeframe: str, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """How many neighbours within a session are not exactly one bar apart."""
    step = step_seconds(timeframe)
    gap = F.col("gap_seconds")
    return (
        with_gap_seconds(df, keys=keys, ts=ts)
        .groupBy(*keys)
        .agg(
            F.count("gap_seconds").alias("n_steps"),
            F.count_if(gap != step).alias("uneven_steps"),
            F.min("gap_seconds").alias("min_step_seconds"),
            F.max("gap_seconds").alias("max_step_seconds"),
            holds(gap == step).alias("evenly_spaced"),
        )
    )


def session_counts(
    df: DataFrame,
    expected_bars: int,
    timeframe: str,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Bars per session against the expected number, and how many start off the grid."""
    off_grid = f"({epoch_seconds_sql(ts)} + {bucket_offset(timeframe)}) % {step_seconds(timeframe)}"
    return (
        df.groupBy(*keys, session_of(ts).alias(SESSION))
        .agg(
            F.count(F.lit(1)).alias("n_bars"),
            F.min(ts).alias("first_bar"),
            F.max(ts).alias("last_bar"),
            F.expr(f"count_if({off_grid} <> 0) AS misaligned"),
        )
        .withColumn("count_ok", F.col("n_bars") == F.lit(expected_bars))
    )


def completeness(
    df: DataFrame, timeframe: str = "1m", *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """Gaps longer than one and a half bars inside sessions, and the percentage without."""
    longest = F.lit(step_seconds(timeframe) * GAP_FACTOR)
    return (
        with_gap_seconds(df, keys=keys, ts=ts)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_bars"),
            F.count_if(F.col("gap_seconds") > longest).alias("gap_count"),
        )
        .withColumn(
            "percent_complete",
            (F.col("n_bars") - F.col("gap_count")) / F.col("n_bars") * F.lit(100.0),
        )
    )
