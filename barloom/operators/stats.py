"""Report tables: statistics, risk, correlation, distributions, dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.bar_columns import OVERBOUGHT, OVERSOLD, with_normal_quantile
from barloom.operators.changes import with_returns
from barloom.operators.ranks import (
    ranked_points,
    spread_join,
    unwrapped_keys,
    wrapped_keys,
    wrapped_quantiles,
)
from barloom.schema import (
    KEYS,
    TIMEFRAME,
    TIMESTAMP,
    indicator_columns,
    numeric_columns,
    quoted,
    require_columns,
    require_window,
)

# Fixed value: bars in a trading year, 252 days of 390 minutes.
BARS_PER_YEAR = 252 * 390
# The quartiles described, and the bins of a returns histogram.
DESCRIBE_QUANTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
HISTOGRAM_BINS = 30
# Enough pairs to share a row's cost, few enough for generated code.
_PAIRS_PER_ROW = 8


def bar_stats(df: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP) -> DataFrame:
    """Bar count, time range, price range, total and mean volume."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min(ts).alias("first_bar"),
        F.max(ts).alias("last_bar"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
        F.avg("volume").alias("mean_volume"),
    )


def unpivoted(
    df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row per input row and column, with the value as a double."""
    require_columns(df, columns)
    cells = [
        f"struct({_literal(c)} AS column_name, CAST({quoted(c)} AS DOUBLE) AS value)"
        for c in columns
    ]
    return df.selectExpr(*[quoted(k) for k in keys], f"inline(array({', '.join(cells)}))")


def describe(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Count, null count, mean, std, min, exact quartiles and max of each column.

    NaN is missing, like null, in all of them.
    """
    long = unpivoted(wrapped_keys(df, keys), columns, keys=keys)
    long = long.withColumn("value", F.expr("nullif(value, double('NaN'))"))
    by = [*keys, "column_name"]
    moments = long.groupBy(*by).agg(
        *[
            F.expr(sql)
            for sql in (
                "count(value) AS n",
                "count_if(value IS NULL) AS null_count",
                "avg(value) AS mean",
                "stddev_samp(value) AS std",
                "min(value) AS min",
                "max(value) AS max",
            )
        ]
    )
    quartiles = wrapped_quantiles(
        long, DESCRIBE_QUANTILES, keys=by, value="value"
    )
    return unwrapped_keys(moments.join(quartiles, by, "left"), keys)


def describe_indicators(
    df: DataFrame, *, keys: Sequence[str] = KEYS, ts: str = TIMESTAMP
) -> DataFrame:
    """:func:`describe` on every indicator column present."""
    return describe(df, indicator_columns(df, [*keys, ts]), keys=keys)


def risk_metrics(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    bars_per_year: int = BARS_PER_YEAR,
    **series,
) -> DataFrame:
    """Deviation of per-bar returns, the same per year, and lowest low under highest high."""
    return (
        with_returns(df, keys=keys, ts=ts, **series)
        .groupBy(*keys)
        .agg(
            F.count("returns").alias("n_returns"),
            F.stddev_samp("returns").alias("bar_volatility"),
            F.min("low").alias("_low"),
            F.max("high").alias("_high"),
        )
        .select(
            *keys,
            "n_returns",
            "bar_volatility",
            (F.col("bar_volatility") * F.lit(sqrt(bars_per_year))).alias(
                "annualized_volatility"
            ),
            (F.try_divide(F.col("_low"), F.col("_high")) - F.lit(1.0)).alias("range_drawdown"),
        )
    )


def correlation_matrix(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are known.

    Long form ``(col_a, col_b, r)``; a constant column gives null.  Every row
    is offered to its pairs before the shuffle, several pairs to a row, and
    combined there, so only one partial row per group of pairs and task is sent.
    """
    names = list(columns) if columns is not None else numeric_columns(df, exclude=keys)
    pairs = [(c, c) for c in names] + list(combinations(names, 2))
    width = min(_PAIRS_PER_ROW, len(pairs))
    groups = [pairs[i : i + width] for i in range(0, len(pairs), width)]

    def side(mine: str, other: str) -> str:
        return f"IF({quoted(other)} IS NULL, NULL, CAST({quoted(mine)} AS DOUBLE))"

    def offered(number: int, group: list[tuple[str, str]]) -> str:
        sides = [v for a, b in group for v in (side(a, b), side(b, a))]
        sides += ["CAST(NULL AS DOUBLE)"] * (2 * width - len(sides))
        named = [f"{v} AS _{'xy'[i % 2]}{i // 2}" for i, v in enumerate(sides)]
        return f"struct({number} AS _group, {', '.join(named)})"

    def label(j: int, which: int) -> str:
        known = [_literal(g[j][which]) if j < len(g) else "NULL" for g in groups]
        return f"get(array({', '.join(known)}), _group)"

    by = [quoted(k) for k in keys]
    rows = df.selectExpr(
        *by, f"inline(array({', '.join(offered(i, g) for i, g in enumerate(groups))}))"
    )
    moments = rows.groupBy(*keys, "_group").agg(
        *[
            F.expr(sql)
            for j in range(width)
            for sql in (
                f"covar_samp(_x{j}, _y{j}) AS _cov{j}",
                f"stddev_samp(_x{j}) AS _sx{j}",
                f"stddev_samp(_y{j}) AS _sy{j}",
            )
        ]
    )
    results = [
        f"struct({label(j, 0)} AS _a, {label(j, 1)} AS _b,"
        f" _cov{j} / nullif(_sx{j} * _sy{j}, 0.0D) AS r)"
        for j in range(width)
    ]
    half = moments.selectExpr(*by, f"inline(array({', '.join(results)}))")
    straight, mirrored = "struct(_a AS col_a, _b AS col_b)", "struct(_b AS col_a, _a AS col_b)"
    both = f"IF(_a = _b, array({straight}), array({straight}, {mirrored}))"
    return half.where("_a IS NOT NULL").selectExpr(*by, f"inline({both})", "r")


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _bin_edges(low: Column, high: Column) -> tuple[Column, Column]:
    """Range to cut into bins; a single value sits in the middle of a unit range."""
    flat = low == high
    return (
        F.when(flat, low - F.lit(0.5)).otherwise(low),
        F.when(flat, high + F.lit(0.5)).otherwise(high),
    )


def histogram(
    df: DataFrame,
    column: str = "returns",
    *,
    bins: int = HISTOGRAM_BINS,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
) -> DataFrame:
    """Equal-width bins between each symbol's extremes; the last one is closed.

    Every bin is returned, also empty ones.  Null and NaN values are missing.
    """
    require_window(bins, "bins")
    known = (
        wrapped_keys(df, keys)
        .select(*keys, ts, F.col(column).alias("_x"))
        .where("_x IS NOT NULL AND NOT isnan(_x)")
    )
    low, high = _bin_edges(F.min("_x"), F.max("_x"))
    ranges = known.groupBy(*keys).agg(low.alias("_lo"), high.alias("_hi"))
    share = (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    counts = (
        spread_join(known, ranges, keys, spread=ts)
        .withColumn(
            "bin",
            F.least(F.floor(share * F.lit(float(bins))), F.lit(bins - 1)).cast("int"),
        )
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n_values"))
    )
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        *keys,
        "bin",
        (F.col("_lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_end"),
    )
    counted = every.join(counts, [*keys, "bin"], "left").fillna(0, subset=["n_values"])
    return unwrapped_keys(counted, keys)


def distribution_summary(
    df: DataFrame,
    column: str = "returns",
    *,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Count, mean and exact median: the marks drawn over a histogram."""
    known = F.when(~F.isnan(column), F.col(column))
    wrapped = wrapped_keys(df, keys)
    means = wrapped.groupBy(*keys).agg(F.count(known).alias("n_values"), F.avg(known).alias("mean"))
    medians = wrapped_quantiles(wrapped, {"median": 0.5}, keys=keys, value=column)
    return unwrapped_keys(means.join(medians, [*keys], "left"), keys)


def normal_points(
    df: DataFrame, column: str = "returns", *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Ordered values against normal order-statistic medians (Filliben's estimate)."""
    points = ranked_points(df, keys=keys, value=column)
    n = F.col("n").cast("double")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    share = (
        F.when(F.col("rank") == F.col("n"), top)
        .when(F.col("rank") == 1, F.lit(1.0) - top)
        .otherwise((F.col("rank") - F.lit(0.3175)) / (n + F.lit(0.365)))
    )
    placed = with_normal_quantile(points.withColumn("_share", share), "_share", "theoretical")
    return placed.select(*keys, "rank", "theoretical", F.col("value").alias("ordered"))


def normal_fit(points: DataFrame, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Least-squares line through normal points, with its correlation."""
    x, y = F.col("theoretical"), F.col("ordered")
    moments = points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.avg(x).alias("_mx"),
        F.avg(y).alias("_my"),
        F.covar_samp(y, x).alias("_cov"),
        F.stddev_samp(x).alias("_sx"),
        F.stddev_samp(y).alias("_sy"),
    )
    slope = F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sx"))
    return moments.withColumn("slope", slope).select(
        *keys,
        "n_points",
        "slope",
        (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"),
        F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy")).alias("r"),
    )


def indicator_summary(df: DataFrame, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """Means of close, VWAP and RSI, their deviation, and over- and undersold shares."""
    require_columns(df, ["close", "vwap", "rsi", "bb_upper", "bb_lower"])
    averages = [c for c in df.columns if c == "ma" or c.startswith("ma_")]
    out = df.groupBy(*keys).agg(
        *[
            F.expr(sql)
            for sql in (
                "count(1) AS n_bars",
                "avg(close) AS mean_close",
                "avg(vwap) AS mean_vwap",
                "avg(rsi) AS mean_rsi",
                "min(rsi) AS min_rsi",
                "max(rsi) AS max_rsi",
                f"count_if(rsi > {OVERBOUGHT}D) AS overbought",
                f"count_if(rsi < {OVERSOLD}D) AS oversold",
                "avg(bb_upper - bb_lower) AS mean_band_width",
                *[f"avg({quoted(c)}) AS {quoted(f'mean_{c}')}" for c in averages],
            )
        ]
    )
    return out.selectExpr(
        "*",
        "try_divide(abs(mean_close - mean_vwap), mean_close) * 100.0D AS vwap_deviation_pct",
        "overbought / n_bars * 100.0D AS overbought_pct",
        "oversold / n_bars * 100.0D AS oversold_pct",
    )


def bar_ratio(
    stacked: DataFrame, timeframes: Sequence[str], *, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Bar counts of the timeframes side by side, as ``n_{timeframe}``."""
    return stacked.groupBy(*keys).agg(
        *[F.count_if(F.col(TIMEFRAME) == tf).alias(f"n_{tf}") for tf in timeframes]
    )


def quick_stats(
    minute_bars: DataFrame,
    metric_bars: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    ts: str = TIMESTAMP,
    **series,
) -> DataFrame:
    """The dashboard: size, range, volume and volatility, mean VWAP and RSI."""
    base = (
        with_returns(minute_bars, keys=keys, ts=ts, **series)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_bars"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
            (F.stddev_samp("returns") * F.lit(100.0)).alias("volatility_pct"),
        )
    )
    metrics = metric_bars.groupBy(*keys).agg(
        F.avg("vwap").alias("mean_vwap"), F.avg("rsi").alias("mean_rsi")
    )
    return base.join(metrics, [*keys], "left")


def stack_reports(tables: Mapping[str, DataFrame], label: str = TIMEFRAME) -> DataFrame:
    """Equal-shaped reports of several frames as one table."""
    labelled = [df.withColumn(label, F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, labelled)
