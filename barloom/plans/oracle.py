"""The questions of ``catalog.py`` as DuckDB SQL over whole tables.

Written from the definitions, not from the Spark plans: series windows are plain
windows per symbol, quantiles and ranks are the built-in ones.
"""

from __future__ import annotations

from barloom.functions.bar_columns import NORMAL_CENTRE, NORMAL_FAR, NORMAL_NEAR

INTERVALS = {
    "1m": "1 minute", "2m": "2 minutes", "5m": "5 minutes", "15m": "15 minutes",
    "30m": "30 minutes", "1h": "1 hour", "1d": "1 day",
}
OHLCV = ("open", "high", "low", "close", "volume")
HALF = 0.5001
WEEKLY = "date_trunc('week', \"timestamp\")"

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts AS "timestamp", event_id AS tie, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)"""

BRAND_TICKS = """ticks AS (
  SELECT p_brand AS symbol, l_shipdate AS "timestamp",
         (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS tie,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

ORDER_TICKS = """ticks AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS "timestamp", o_orderkey AS tie,
         o_totalprice AS price, CAST(1 AS BIGINT) AS volume
  FROM orders)"""


def r(expression: str, name: str | None = None) -> str:
    """Round to six places by the same arithmetic as the queries."""
    rounded = f"(floor(({expression}) * 1000000.0::DOUBLE + {HALF}::DOUBLE) / 1000000.0::DOUBLE)"
    return f"{rounded} AS {name}" if name else rounded


def bars(timeframe: str, name: str = "bars", source: str = "ticks") -> str:
    bucket = (
        f"time_bucket(INTERVAL '{timeframe[0]} weeks', \"timestamp\", TIMESTAMP '1970-01-05')"
        if timeframe in ("2w", "4w")
        else WEEKLY
        if timeframe == "1w"
        else f"time_bucket(INTERVAL '{INTERVALS[timeframe]}', \"timestamp\")"
    )
    return f"""{name} AS MATERIALIZED (
  SELECT * FROM (
    SELECT symbol, {bucket} AS "timestamp",
           arg_min_null(price, ("timestamp", tie)) AS open, max(price) AS high,
           min(price) AS low, arg_max_null(price, ("timestamp", tie)) AS close,
           CAST(coalesce(sum(volume), 0) AS BIGINT) AS volume
    FROM {source} GROUP BY ALL) AS rolled
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL)"""


def stacked(timeframes: list[str], name: str = "stacked") -> str:
    parts = [bars(tf, f"bars_{tf}") for tf in timeframes]
    union = " UNION ALL ".join(f"SELECT *, '{tf}' AS timeframe FROM bars_{tf}" for tf in timeframes)
    return ", ".join([*parts, f"{name} AS ({union})"])


def frame(window: int) -> str:
    return (
        f'(PARTITION BY symbol ORDER BY "timestamp" '
        f"ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    )


RUNNING = '(PARTITION BY symbol ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING)'
BEFORE = '(PARTITION BY symbol ORDER BY "timestamp")'
BAR_COLUMNS = 'symbol, "timestamp", open, high, low, close, volume'


def ma(window: int, column: str = "close") -> str:
    return f"avg({column}) OVER {frame(window)}"


def median(window: int) -> str:
    return f"quantile_cont(close, 0.5) OVER {frame(window)}"


def vwap(partition: str = "symbol") -> str:
    over = f'(PARTITION BY {partition} ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING)'
    return (
        f"sum((high + low + close) / 3 * volume) OVER {over}"
        f" / nullif(sum(volume) OVER {over}, 0)"
    )


def std(window: int) -> str:
    return f"coalesce(stddev_samp(close) OVER {frame(window)}, 0)"


def metrics(
    source: str,
    name: str,
    *,
    ma_window: int,
    median_window: int,
    band_window: int,
    rsi_window: int,
    ma_name: str,
    median_name: str,
    middle: str | None = "bb_middle",
) -> str:
    middle_column = f"{ma(band_window)} AS {middle}," if middle else ""
    return f"""{name} AS MATERIALIZED (
  WITH changed AS (
    SELECT *, close - lag(close) OVER {BEFORE} AS chg FROM {source}),
  parted AS (
    SELECT *, CASE WHEN chg > 0 THEN chg ELSE 0.0 END AS gain,
           CASE WHEN chg < 0 THEN -chg ELSE 0.0 END AS loss FROM changed),
  windowed AS (
    SELECT {BAR_COLUMNS},
           {ma(ma_window)} AS {ma_name}, {median(median_window)} AS {median_name},
           {vwap()} AS vwap, {middle_column}
           {ma(band_window)} + 2.0 * {std(band_window)} AS bb_upper,
           {ma(band_window)} - 2.0 * {std(band_window)} AS bb_lower,
           avg(gain) OVER {frame(rsi_window)} AS up,
           avg(loss) OVER {frame(rsi_window)} AS down
    FROM parted)
  SELECT * EXCLUDE (up, down),
         CASE WHEN down = 0 THEN 100.0
              ELSE 100.0 - 100.0 / (1.0 + up / nullif(down, 0)) END AS rsi
  FROM windowed)"""


STANDARD = {"1m": (30, 30, 20, 14), "5m": (6, 6, 4, 3), "30m": (1, 1, 1, 1)}


def standard(
    timeframe: str, source: str = "bars", name: str = "metrics", plain: bool = False
) -> str:
    a, b, c, d = STANDARD[timeframe]
    return metrics(
        source, name, ma_window=a, median_window=b, band_window=c, rsi_window=d,
        ma_name="ma" if plain else f"ma_{a}",
        median_name="median" if plain else f"median_{b}",
    )


def compact(window: int, source: str = "bars", name: str = "metrics") -> str:
    return metrics(
        source, name, ma_window=window, median_window=window, band_window=window,
        rsi_window=14, ma_name="ma", median_name="median", middle=None,
    )


def rounded_metrics(names: list[str], source: str = "metrics") -> str:
    computed = ", ".join(r(n, n) for n in names)
    prices = ", ".join(r(n, n) for n in OHLCV[:4])
    return f'SELECT symbol, "timestamp", {prices}, volume, {computed} FROM {source}'


PRICES = ", ".join(r(n, n) for n in OHLCV[:4])
ROUNDED_BARS = f'symbol, "timestamp", {PRICES}, volume'
STANDARD_TAIL = ["vwap", "bb_middle", "bb_upper", "bb_lower", "rsi"]
COMPACT_NAMES = ["ma", "median", "vwap", "bb_upper", "bb_lower", "rsi"]


def with_bars(timeframe: str, body: str, ticks: str = TICKS) -> str:
    return f"WITH {ticks}, {bars(timeframe)} {body}"


RETURNS = f"""moves AS MATERIALIZED (
  SELECT *, close / nullif(lag(close) OVER {BEFORE}, 0) - 1 AS returns FROM bars)"""


def moves(body: str, timeframe: str = "30m") -> str:
    return f"WITH {TICKS}, {bars(timeframe)}, {RETURNS} {body}"


def described(source: str, columns: list[str], *, value: str = "CAST({c} AS DOUBLE)") -> str:
    long = " UNION ALL ".join(
        f"SELECT symbol, '{c}' AS column_name, {value.format(c=c)} AS value FROM {source}"
        for c in columns
    )
    return f"""SELECT symbol, column_name, count(value) AS n,
       CAST(count(*) - count(value) AS BIGINT) AS null_count,
       {r("avg(value)", "mean")}, {r("stddev_samp(value)", "std")},
       {r("min(value)", '"min"')}, {r("quantile_cont(value, 0.25)", "q25")},
       {r("quantile_cont(value, 0.5)", "median")}, {r("quantile_cont(value, 0.75)", "q75")},
       {r("max(value)", '"max"')}
  FROM ({long}) AS long GROUP BY symbol, column_name"""


def horner(x: str, coefficients) -> str:
    acc = repr(coefficients[0]) + "::DOUBLE"
    for c in coefficients[1:]:
        acc = f"({acc} * {x} + {c!r}::DOUBLE)"
    return acc


def ratio_of(x: str, pair) -> str:
    return f"({horner(x, pair[0])} / {horner(x, pair[1])})"


QQ = f"""ranked AS (
  SELECT symbol, returns AS ordered,
         row_number() OVER (PARTITION BY symbol ORDER BY returns) AS rank,
         CAST(count(*) OVER (PARTITION BY symbol) AS DOUBLE) AS n
  FROM moves WHERE returns IS NOT NULL),
shared AS (
  SELECT symbol, ordered, rank,
         CASE WHEN rank = n THEN pow(0.5, 1 / n)
              WHEN rank = 1 THEN 1 - pow(0.5, 1 / n)
              ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p
  FROM ranked),
stepped AS (
  SELECT *, p - 0.5 AS q, 0.180625::DOUBLE - (p - 0.5) * (p - 0.5) AS centre,
         sqrt(-ln(CASE WHEN p <= 0.5 THEN p ELSE 1 - p END)) AS far_root
  FROM shared),
points AS MATERIALIZED (
  SELECT symbol, rank, ordered,
         CASE WHEN abs(q) <= 0.425 THEN q * {ratio_of("centre", NORMAL_CENTRE)}
              ELSE sign(q) * CASE WHEN far_root <= 5
                THEN {ratio_of("(far_root - 1.6)", NORMAL_NEAR)}
                ELSE {ratio_of("(far_root - 5)", NORMAL_FAR)} END END AS theoretical
  FROM stepped)"""

RULES = {
    "high_ge_open": "high >= open",
    "high_ge_close": "high >= close",
    "high_ge_low": "high >= low",
    "low_le_open": "low <= open",
    "low_le_close": "low <= close",
    "open_positive": "open > 0",
    "high_positive": "high > 0",
    "low_positive": "low > 0",
    "close_positive": "close > 0",
    "volume_non_negative": "volume >= 0",
}


def holds(rule: str) -> str:
    return f"coalesce(bool_and({rule}), true)"


def violations(rule: str, name: str) -> str:
    return f"count(*) FILTER (NOT ({rule})) AS {name}"


GAPS = """gaps AS (
  SELECT *, CAST("timestamp" AS DATE) AS session_date,
         date_sub('second', lag("timestamp") OVER (
           PARTITION BY symbol, CAST("timestamp" AS DATE) ORDER BY "timestamp"),
           "timestamp") AS gap_seconds
  FROM bars)"""

CORRELATED = [*OHLCV, "ma_6", "median_6", *STANDARD_TAIL]


def correlation_sql() -> str:
    pairs = " UNION ALL ".join(
        f"SELECT symbol, '{a}' AS col_a, '{b}' AS col_b, "
        + r(f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)", "r")
        + f" FROM metrics WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY symbol"
        for a in CORRELATED
        for b in CORRELATED
    )
    return f"WITH {TICKS}, {bars('5m')}, {standard('5m')} {pairs}"


def summary_columns(source_ma: str) -> str:
    return f"""count(*) AS n_bars, {r("avg(close)", "mean_close")},
       {r("avg(vwap)", "mean_vwap")}, {r("avg(rsi)", "mean_rsi")},
       {r("min(rsi)", "min_rsi")}, {r("max(rsi)", "max_rsi")},
       count(*) FILTER (rsi > 70) AS overbought, count(*) FILTER (rsi < 30) AS oversold,
       {r("avg(bb_upper - bb_lower)", "mean_band_width")},
       {r(f"avg({source_ma})", f"mean_{source_ma}")},
       {r("abs(avg(close) - avg(vwap)) / nullif(avg(close), 0) * 100", "vwap_deviation_pct")},
       {r("count(*) FILTER (rsi > 70) / count(*) * 100", "overbought_pct")},
       {r("count(*) FILTER (rsi < 30) / count(*) * 100", "oversold_pct")}"""


def run_sql(metric_ctes: dict[str, str], names: list[str]) -> str:
    frames = ["1m", "5m", "30m", "1d"]
    selects = []
    for tf in frames:
        if tf in metric_ctes:
            computed = ", ".join(r(n, n) for n in names)
            source = f"metrics_{tf}"
        else:
            computed = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in names)
            source = f"bars_{tf}"
        selects.append(f"SELECT {ROUNDED_BARS}, '{tf}' AS timeframe, {computed} FROM {source}")
    ctes = [TICKS, *[bars(tf, f"bars_{tf}") for tf in frames], *metric_ctes.values()]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(selects)}"


def scaled_sql() -> str:
    return with_bars("5m", """, ranked AS (
  SELECT symbol, "timestamp", close, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") AS n FROM bars),
firsts AS (
  SELECT *, min(close) OVER p AS c_lo, max(close) OVER p AS c_hi,
         CAST(min(volume) OVER p AS DOUBLE) AS v_lo, CAST(max(volume) OVER p AS DOUBLE) AS v_hi
  FROM ranked WHERE n <= 20 WINDOW p AS (PARTITION BY symbol)),
levels AS (
  SELECT symbol, "timestamp", close, volume, strftime("timestamp", '%H:%M') AS label,
         CAST(coalesce(floor((close - c_lo) / nullif(c_hi - c_lo, 0) * 20), 0) AS BIGINT)
           AS price_level,
         CAST(coalesce(floor((volume - v_lo) / nullif(v_hi - v_lo, 0) * 30), 0) AS BIGINT)
           AS volume_level
  FROM firsts)
SELECT *, price_level + 1 AS price_bar_length, volume_level // 2 + 1 AS volume_bar_length
FROM levels""")


def validate_metrics_sql() -> str:
    names = ["ma_6", "median_6", *STANDARD_TAIL]
    nulls = ", ".join(f"count(*) FILTER ({n} IS NULL) AS {n}_nulls" for n in names)
    total = " + ".join(f"{n}_nulls" for n in names)
    return f"""WITH {TICKS}, {bars('5m')}, {standard('5m')}, checked AS (
  SELECT symbol, count(*) AS n_bars, {nulls}, min(low) AS lo, max(high) AS hi,
         min(vwap) AS vwap_min, max(vwap) AS vwap_max, min(rsi) AS rsi_min, max(rsi) AS rsi_max,
         count(*) FILTER (NOT (bb_lower <= bb_middle AND bb_middle <= bb_upper))
           AS band_violations
  FROM metrics GROUP BY symbol),
verdicts AS (
  SELECT * EXCLUDE (lo, hi), ({total}) = 0 AS nulls_ok,
         coalesce(vwap_min >= lo * 0.9 AND vwap_max <= hi * 1.1, true) AS vwap_ok,
         coalesce(rsi_min >= 0 AND rsi_max <= 100, true) AS rsi_ok,
         band_violations = 0 AS bands_ok
  FROM checked)
SELECT * REPLACE ({r("vwap_min", "vwap_min")}, {r("vwap_max", "vwap_max")},
                  {r("rsi_min", "rsi_min")}, {r("rsi_max", "rsi_max")}),
       nulls_ok AND vwap_ok AND rsi_ok AND bands_ok AS valid
FROM verdicts"""


def validate_rollup_sql() -> str:
    rules = ", ".join(f"{holds(rule)} AS {name}" for name, rule in RULES.items())
    every = " AND ".join(RULES)
    return with_bars("1d", f""", rolled AS (
  SELECT symbol, count(*) AS n_bars, {rules}, CAST(sum(volume) AS BIGINT) AS rolled_volume
  FROM bars GROUP BY symbol),
source AS (
  SELECT symbol, CAST(sum(volume) AS BIGINT) AS source_volume FROM ticks GROUP BY symbol)
SELECT symbol, source_volume, rolled.* EXCLUDE (symbol), n_bars = 30 AS bar_count_ok,
       abs(source_volume - rolled_volume) AS volume_difference,
       abs(source_volume - rolled_volume) <= 1 AS volume_ok,
       n_bars = 30 AND {every} AND abs(source_volume - rolled_volume) <= 1 AS valid
FROM source JOIN rolled USING (symbol)""")


def validate_rollup_odd_sql() -> str:
    """Null, ghost and missing symbols: a full outer join on keys that may be null."""
    rules = ", ".join(f"{holds(rule)} AS {name}" for name, rule in RULES.items())
    kept = ", ".join(f"coalesce(rolled.{name}, true) AS {name}" for name in RULES)
    every = " AND ".join(RULES)
    return with_bars("1d", f""", renamed AS (
  SELECT CASE WHEN symbol = 'view' THEN 'ghost' WHEN symbol <> 'click' THEN symbol END AS symbol,
         bars.* EXCLUDE (symbol) FROM bars),
rolled AS (
  SELECT symbol, count(*) AS n_bars, {rules}, CAST(sum(volume) AS BIGINT) AS rolled_volume
  FROM renamed GROUP BY symbol),
source AS (
  SELECT CASE WHEN symbol <> 'click' THEN symbol END AS symbol,
         CAST(sum(volume) AS BIGINT) AS source_volume FROM ticks GROUP BY ALL),
met AS (
  SELECT coalesce(source.symbol, rolled.symbol) AS symbol,
         coalesce(source_volume, 0) AS source_volume, coalesce(n_bars, 0) AS n_bars, {kept},
         coalesce(rolled_volume, 0) AS rolled_volume
  FROM source FULL JOIN rolled ON source.symbol IS NOT DISTINCT FROM rolled.symbol)
SELECT met.*, n_bars = 30 AS bar_count_ok, abs(source_volume - rolled_volume) AS volume_difference,
       abs(source_volume - rolled_volume) <= 1 AS volume_ok,
       n_bars = 30 AND {every} AND abs(source_volume - rolled_volume) <= 1 AS valid
FROM met""")


def returns_sql(timeframe: str) -> dict[str, str]:
    """The questions about returns that are asked of several timeframes."""
    return {
        "describe": moves(described("moves", ["returns"]), timeframe),
        "risk": moves(f"""SELECT symbol, count(returns) AS n_returns,
       {r("stddev_samp(returns)", "bar_volatility")},
       {r("stddev_samp(returns) * sqrt(252 * 390)", "annualized_volatility")},
       {r("min(low) / nullif(max(high), 0) - 1", "range_drawdown")}
FROM moves GROUP BY symbol""", timeframe),
        "histogram": moves(f""", ranges AS (
  SELECT symbol, CASE WHEN min(returns) = max(returns) THEN min(returns) - 0.5
                      ELSE min(returns) END AS lo,
         CASE WHEN min(returns) = max(returns) THEN max(returns) + 0.5
              ELSE max(returns) END AS hi
  FROM moves WHERE returns IS NOT NULL GROUP BY symbol),
counts AS (
  SELECT symbol, CAST(least(floor((returns - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin,
         count(*) AS n_values
  FROM moves JOIN ranges USING (symbol) WHERE returns IS NOT NULL GROUP BY ALL)
SELECT ranges.symbol, CAST(b AS INTEGER) AS bin, {r("lo + (hi - lo) / 30 * b", "bin_start")},
       {r("lo + (hi - lo) / 30 * (b + 1)", "bin_end")}, coalesce(n_values, 0) AS n_values
FROM ranges CROSS JOIN generate_series(0, 29) AS bins(b)
LEFT JOIN counts ON counts.symbol = ranges.symbol AND counts.bin = b""", timeframe),
        "distribution": moves(f"""SELECT symbol, count(returns) AS n_values,
       {r("avg(returns)", "mean")}, {r("quantile_cont(returns, 0.5)", "median")}
FROM moves GROUP BY symbol""", timeframe),
        "qq_points": moves(f""", {QQ}
SELECT symbol, rank, {r("theoretical", "theoretical")}, {r("ordered", "ordered")} FROM points""", timeframe),
        "qq_fit": moves(f""", {QQ}
SELECT symbol, count(*) AS n_points, {r("regr_slope(ordered, theoretical)", "slope")},
       {r("regr_intercept(ordered, theoretical)", "intercept")},
       {r("corr(ordered, theoretical)", "r")}
FROM points GROUP BY symbol""", timeframe),
    }


def candles_sql(timeframe: str, half_width: int) -> str:
    return with_bars(timeframe, f"""SELECT {ROUNDED_BARS},
       CASE WHEN close >= open THEN 'green' ELSE 'red' END AS color,
       {r("abs(close - open)", "body_height")}, {r("least(open, close)", "body_base")},
       {r("low", "wick_low")}, {r("high", "wick_high")},
       CAST({half_width} AS DOUBLE) AS half_width_seconds
FROM bars""")


def lines_sql(timeframe: str) -> str:
    w = STANDARD[timeframe][0]
    lines = ["close", f"ma_{w}", f"median_{w}", "vwap", "bb_middle", "bb_upper", "rsi"]
    chosen = ", ".join(r(n, n) for n in lines)
    return with_bars(timeframe, f", {standard(timeframe)} SELECT symbol, \"timestamp\", {chosen} FROM metrics")


def checks_sql() -> str:
    """Symbol, check, number and verdict of every check of a run."""
    ctes = [TICKS, *[bars(tf, f"bars_{tf}") for tf in ("1m", "5m", "30m", "1d")]]
    parts = []
    rules = " AND ".join(holds(rule) for rule in RULES.values())
    parts.append(f"SELECT symbol, 'bars' AS check_name, count(*) AS n, {rules} AS ok FROM bars_1m GROUP BY symbol")
    for tf in ("5m", "30m", "1d"):
        parts.append(f"""SELECT symbol, 'rollup_{tf}', n, ok AND abs(a.v - b.v) <= 1
FROM (SELECT symbol, sum(volume) AS v FROM bars_1m GROUP BY symbol) AS a
JOIN (SELECT symbol, count(*) AS n, sum(volume) AS v, {rules} AS ok FROM bars_{tf} GROUP BY symbol) AS b USING (symbol)""")
    for tf, step in (("1m", 60), ("5m", 300), ("30m", 1800)):
        gaps = GAPS.replace("FROM bars", f"FROM bars_{tf}").replace("gaps AS", f"gaps_{tf} AS")
        ctes.append(gaps)
        parts.append(f"""SELECT symbol, 'spacing_{tf}', count(*) FILTER (gap_seconds <> {step}), {holds(f"gap_seconds = {step}")}
FROM gaps_{tf} GROUP BY symbol""")
    union = " UNION ALL ".join(f"SELECT symbol, min(low) AS lo, max(high) AS hi FROM bars_{tf} GROUP BY symbol" for tf in ("1m", "5m", "30m", "1d"))
    parts.append(f"""SELECT symbol, 'ranges', count(*), min(lo) = max(lo) AND min(hi) = max(hi) FROM ({union}) GROUP BY symbol""")
    for tf in ("5m", "30m"):
        ctes.append(standard(tf, f"bars_{tf}", f"metrics_{tf}"))
        w = STANDARD[tf][0]
        known = " AND ".join(f"count({n}) = count(*)" for n in (f"ma_{w}", f"median_{w}", *STANDARD_TAIL))
        parts.append(f"""SELECT symbol, 'metrics_{tf}', count(*), {known}
  AND coalesce(min(vwap) >= min(low) * 0.9 AND max(vwap) <= max(high) * 1.1, true)
  AND coalesce(min(rsi) >= 0 AND max(rsi) <= 100, true)
  AND count(*) FILTER (NOT (bb_lower <= bb_middle AND bb_middle <= bb_upper)) = 0
FROM metrics_{tf} GROUP BY symbol""")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)


def run_tables(sql: dict[str, str]) -> dict[str, str]:
    """The tables a run delivers: those asked for elsewhere too, and the same of other timeframes."""
    minute = returns_sql("1m")
    return {
        "report_overview": f"""WITH {TICKS}, {stacked(['1m', '5m', '30m', '1d'])}
SELECT symbol, timeframe, count(*) AS n_bars, min("timestamp") AS first_bar,
       max("timestamp") AS last_bar, {r("min(low)", "low")}, {r("max(high)", "high")},
       CAST(sum(volume) AS BIGINT) AS total_volume, {r("avg(volume)", "mean_volume")}
FROM stacked GROUP BY symbol, timeframe""",
        "report_bar_counts": sql["ratio"],
        "report_price_statistics": with_bars("1m", described("bars", list(OHLCV[:4]))),
        "report_volume_statistics": with_bars("1m", described("bars", ["volume"])),
        "report_returns_statistics": minute["describe"],
        "report_risk": minute["risk"],
        "report_completeness": sql["completeness"],
        "report_indicator_analysis": sql["stored_run"],
        "report_indicator_statistics": sql["describe_indicators"],
        "report_price_levels": scaled_sql(),
        "report_dashboard": sql["quick_stats"],
        "chart_returns": moves(f"""SELECT symbol, "timestamp", {r('returns', 'returns')},
       CASE WHEN count(returns) OVER {frame(20)} = 20
            THEN {r(f"stddev_samp(returns) OVER {frame(20)}")} END AS volatility FROM moves""", "1m"),
        "chart_returns_histogram": minute["histogram"],
        "chart_returns_marks": minute["distribution"],
        "chart_normal_points": minute["qq_points"],
        "chart_normal_line": minute["qq_fit"],
        "chart_correlation_5m": sql["correlation"],
        "chart_candles_5m": candles_sql("5m", 120),
        "chart_candles_30m": candles_sql("30m", 720),
        "chart_indicators_5m": lines_sql("5m"),
        "chart_indicators_30m": lines_sql("30m"),
        "run_checks": checks_sql(),
        "enriched_csv": sql["run_standard"],
        "published_counts": f"""WITH {TICKS}, odd AS (
  SELECT symbol, CASE WHEN symbol = 'click' AND tie % 10 = 0 THEN NULL ELSE "timestamp" END AS "timestamp", tie,
         CASE WHEN symbol = 'view' AND tie % 7 = 0 THEN NULL ELSE price END AS price, volume FROM ticks),
{bars("1d", source="odd")}, found AS (
  SELECT 'ticks' AS table_name, count(*) AS "rows", count(*) FILTER ("timestamp" IS NULL) AS no_time,
         count(*) FILTER (price IS NULL) AS no_price FROM odd
  UNION ALL SELECT 'bars', count(*), 0, 0 FROM bars WHERE "timestamp" IS NOT NULL)
UNPIVOT found ON "rows", no_time, no_price INTO NAME "check" VALUE n""",
    }


def oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    every_bar = f"SELECT {BAR_COLUMNS} FROM bars"
    for tf in ("1m", "5m", "30m", "1d"):
        sql[f"ohlc_{tf}"] = with_bars(tf, every_bar)
    sql["ohlc_multi"] = f"WITH {TICKS}, {stacked(['5m', '30m', '1d'])} SELECT * FROM stacked"
    sql["ohlc_multi_custom"] = (
        f"WITH {TICKS}, {stacked(['2m', '15m', '1h', '1w'])} SELECT * FROM stacked"
    )
    sql["ohlc_weeks"] = f"""WITH {TICKS}, {stacked(['1d', '1w', '2w', '4w'])}
SELECT * FROM stacked UNION ALL SELECT *, '2w alone' AS timeframe FROM bars_2w"""
    in_days = TICKS.replace("FROM events", "FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-17'")
    sql["run_range"] = with_bars("5m", every_bar, in_days)
    sql["ohlc_daily_brand"] = with_bars("1d", every_bar, BRAND_TICKS)
    sql["ohlc_daily_orders"] = with_bars("1d", every_bar, ORDER_TICKS)

    sql["moving_average"] = with_bars(
        "30m", f"SELECT {ROUNDED_BARS}, {r(ma(14), 'ma_14')} FROM bars"
    )
    sql["moving_average_volume"] = with_bars(
        "30m", f"SELECT {ROUNDED_BARS}, {r(ma(30, 'volume'), 'ma_30')} FROM bars"
    )
    sql["moving_median"] = with_bars(
        "30m", f"SELECT {ROUNDED_BARS}, {r(median(14), 'median_14')} FROM bars"
    )
    of_ticks = (
        'quantile_cont(price, 0.5) OVER (PARTITION BY symbol ORDER BY "timestamp", tie '
        "ROWS BETWEEN 4999 PRECEDING AND CURRENT ROW)"
    )
    sql["moving_median_long"] = f"""WITH {TICKS}
SELECT symbol, "timestamp", tie AS event_id, {r("price", "close")}, {r(of_ticks, "median_5000")} FROM ticks"""
    sql["moving_quantile_long"] = with_bars(
        "1m", f"SELECT {ROUNDED_BARS}, {r(f'quantile_cont(volume, 0.25) OVER {frame(700)}', 'quantile_700')} FROM bars"
    )
    sql["vwap_series"] = with_bars("30m", f"SELECT {ROUNDED_BARS}, {r(vwap(), 'vwap')} FROM bars")
    sql["vwap_exact"] = sql["vwap_series"]
    traded = "sum(volume) FILTER (price IS NOT NULL)"
    sql["exact_totals"] = f"""WITH {TICKS}
SELECT symbol, CAST("timestamp" AS DATE) AS session_date, {r("fsum(price * volume)", "turnover")},
       {r(traded, "traded")}, {r(f"fsum(price * volume) / nullif({traded}, 0)", "vwap")}
FROM ticks GROUP BY ALL"""
    by_day = vwap('symbol, CAST("timestamp" AS DATE)')
    sql["vwap_session"] = with_bars("30m", f"SELECT {ROUNDED_BARS}, {r(by_day, 'vwap')} FROM bars")
    sql["vwap_brand"] = with_bars(
        "1d", f"SELECT {ROUNDED_BARS}, {r(vwap(), 'vwap')} FROM bars", BRAND_TICKS
    )
    sql["bollinger"] = with_bars("30m", f"""SELECT {ROUNDED_BARS}, {r(ma(20), 'bb_middle')},
       {r(f"{ma(20)} + 2 * {std(20)}", "bb_upper")}, {r(f"{ma(20)} - 2 * {std(20)}", "bb_lower")}
FROM bars""")
    sql["rsi"] = with_bars("30m", f", {compact(14)} {rounded_metrics(['rsi'])}")
    sql["metrics_standard_1m"] = with_bars(
        "1m", f", {standard('1m')} {rounded_metrics(['ma_30', 'median_30', *STANDARD_TAIL])}"
    )
    sql["metrics_standard"] = with_bars(
        "5m", f", {standard('5m')} {rounded_metrics(['ma_6', 'median_6', *STANDARD_TAIL])}"
    )
    sql["metrics_standard_30m"] = with_bars(
        "30m", f", {standard('30m')} {rounded_metrics(['ma_1', 'median_1', *STANDARD_TAIL])}"
    )
    sql["metrics_compact"] = with_bars("30m", f", {compact(10)} {rounded_metrics(COMPACT_NAMES)}")
    sql["metrics_brand"] = with_bars(
        "1d", f", {compact(20)} {rounded_metrics(COMPACT_NAMES)}", BRAND_TICKS
    )

    sql["price_change"] = with_bars(
        "30m",
        f"SELECT {ROUNDED_BARS}, {r(f'close - lag(close) OVER {BEFORE}', 'price_change')} FROM bars",
    )
    sql["previous_close"] = with_bars(
        "30m", f"SELECT {BAR_COLUMNS}, lag(close) OVER {BEFORE} AS previous_close FROM bars"
    )
    sql["gap_seconds"] = with_bars("30m", f", {GAPS} SELECT * FROM gaps")
    sql["returns"] = moves(f"SELECT {ROUNDED_BARS}, {r('returns', 'returns')} FROM moves")
    sql["rolling_vol"] = moves(f"""SELECT {ROUNDED_BARS}, {r('returns', 'returns')},
       CASE WHEN count(returns) OVER {frame(20)} = 20
            THEN {r(f"stddev_samp(returns) OVER {frame(20)}")} END AS volatility FROM moves""")
    sql["running_volume"] = with_bars(
        "30m",
        f"SELECT {BAR_COLUMNS}, CAST(sum(volume) OVER {RUNNING} AS BIGINT) AS running_volume"
        " FROM bars",
    )
    sql["smoothness"] = with_bars("1d", f""", averaged AS (
  SELECT *, {ma(30)} AS average FROM bars),
both_returns AS (
  SELECT symbol, close / nullif(lag(close) OVER {BEFORE}, 0) - 1 AS returns,
         average / nullif(lag(average) OVER {BEFORE}, 0) - 1 AS ma_returns FROM averaged)
SELECT symbol, {r("stddev_samp(returns)", "returns_std")},
       {r("stddev_samp(ma_returns)", "ma_returns_std")},
       {r("stddev_samp(ma_returns) / nullif(stddev_samp(returns), 0)", "smoothness_ratio")},
       stddev_samp(ma_returns) < stddev_samp(returns) AS is_smoother
FROM both_returns GROUP BY symbol""", ORDER_TICKS)
    sql["price_index"] = with_bars("1d", f""", {RETURNS}
SELECT symbol, "timestamp", {r("close", "close")}, {r("returns", "returns")},
       {r(f"100 * coalesce(product(1 + returns) OVER {RUNNING}, 1)", "price_index")}
FROM moves""", ORDER_TICKS)
    sql["open_from_prev"] = with_bars("30m", f"""SELECT symbol, "timestamp",
       coalesce(lag(close) OVER {BEFORE}, 100.0) AS open, high, low, close, volume FROM bars""")

    sql["typical_prices"] = with_bars(
        "30m", f"SELECT {ROUNDED_BARS}, {r('(high + low + close) / 3', 'typical_price')} FROM bars"
    )
    sql["repair"] = with_bars("30m", f""", moved AS (
  SELECT * REPLACE (coalesce(lag(close) OVER {BEFORE}, 100.0) AS open) FROM bars)
SELECT * REPLACE (greatest(high, open, close) AS high, least(low, open, close) AS low)
FROM moved""")
    sql["path_bars"] = f"""WITH paths AS (
  SELECT *, l_extendedprice * (1 + l_discount) AS p1 FROM lineitem),
second AS (SELECT *, p1 * (1 - l_tax) AS p2 FROM paths),
third AS (SELECT *, p2 * (1 + l_tax) AS p3 FROM second),
fourth AS (
  SELECT *, p3 * (1 - l_discount) AS p4, l_extendedprice * (1 - l_discount) AS last FROM third)
SELECT l_orderkey, l_linenumber, {r("l_extendedprice", "open")},
       {r("greatest(l_extendedprice, p1, p2, p3, p4, last)", "high")},
       {r("least(l_extendedprice, p1, p2, p3, p4, last)", "low")},
       {r("last", "close")}, {r("p4", "path_end")}
FROM fourth"""
    sql["candles"] = with_bars("30m", f"""SELECT {ROUNDED_BARS},
       CASE WHEN close >= open THEN 'green' ELSE 'red' END AS color,
       {r("abs(close - open)", "body_height")}, {r("least(open, close)", "body_base")},
       {r("low", "wick_low")}, {r("high", "wick_high")},
       CAST(720 AS DOUBLE) AS half_width_seconds
FROM bars""")
    sql["scaled"] = scaled_sql()
    sql["rsi_flags"] = with_bars("30m", f""", {compact(14)}
SELECT symbol, "timestamp", {r("rsi", "rsi")}, rsi > 70 AS overbought, rsi < 30 AS oversold
FROM metrics""")
    lines = ["close", "ma_6", "median_6", "vwap", "bb_middle", "bb_upper", "rsi"]
    sql["indicator_lines"] = with_bars(
        "5m",
        f", {standard('5m')} SELECT symbol, \"timestamp\", "
        + ", ".join(r(n, n) for n in lines)
        + " FROM metrics",
    )
    sql["clock_fields"] = with_bars("30m", """SELECT symbol, "timestamp",
       strftime("timestamp", '%H:%M') AS label, CAST(hour("timestamp") AS INTEGER) AS "hour",
       CAST(minute("timestamp") AS INTEGER) AS "minute",
       CAST("timestamp" AS DATE) AS session_date
FROM bars""")
    sql["conform_types"] = """SELECT l_returnflag AS symbol,
       CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS "timestamp",
       CAST(l_orderkey AS DOUBLE) AS open, CAST(l_orderkey AS DOUBLE) AS high,
       CAST(l_orderkey AS DOUBLE) AS low, l_extendedprice AS close,
       CAST(l_linenumber AS BIGINT) AS volume
FROM lineitem"""
    sql["first_rows"] = with_bars("30m", f"""SELECT {BAR_COLUMNS} FROM bars
QUALIFY row_number() OVER {BEFORE} <= 20""")
    sql["head_rows"] = with_bars(
        "30m", f'SELECT {BAR_COLUMNS} FROM bars ORDER BY "timestamp", symbol LIMIT 5'
    )
    sql["frame_summary"] = with_bars("30m", """SELECT count(*) AS n_rows,
       CAST(7 AS BIGINT) AS n_columns,
       'symbol, timestamp, open, high, low, close, volume' AS column_names FROM bars""")

    sql["join_on_time"] = with_bars("5m", f""", closes AS (
  SELECT symbol, "timestamp", close FROM bars QUALIFY row_number() OVER {BEFORE} <= 20)
SELECT closes.*, bars.volume FROM closes JOIN bars USING (symbol, "timestamp")""")
    coarse = ", ".join(f"c.{n} AS coarse_{n}" for n in OHLCV)
    sql["align_timeframes"] = f"""WITH {TICKS}, {bars("5m")}, {bars("30m", "coarse")}
SELECT b.*, c."timestamp" AS coarse_timestamp, {coarse}
FROM bars AS b JOIN coarse AS c
  ON b.symbol = c.symbol AND b."timestamp" >= c."timestamp"
 AND b."timestamp" < c."timestamp" + INTERVAL '30 minutes'"""
    sql["shift_days"] = with_bars(
        "30m",
        'SELECT * REPLACE ("timestamp" + INTERVAL \'3 days\' AS "timestamp") FROM bars',
    )
    sql["union_days"] = with_bars("1d", f"""{every_bar} UNION ALL
SELECT * REPLACE ("timestamp" + INTERVAL '30 days' AS "timestamp") FROM bars""")
    sql["duplicate_bars"] = with_bars("1d", """, twice AS (
  SELECT symbol, "timestamp" FROM bars UNION ALL
  SELECT symbol, "timestamp" + INTERVAL '10 days' FROM bars)
SELECT symbol, "timestamp", count(*) AS n_copies FROM twice GROUP BY ALL HAVING count(*) > 1""")

    spine = """sessions AS (SELECT DISTINCT symbol, CAST("timestamp" AS DATE) AS session_date
  FROM ticks),
spine AS (
  SELECT symbol, session_date, CAST(session_date AS TIMESTAMP)
         + INTERVAL '570 minutes' + to_minutes(CAST(m AS INTEGER)) AS "timestamp"
  FROM sessions, generate_series(0, 389) AS minutes(m))"""
    sql["session_spine"] = f"WITH {TICKS}, {spine} SELECT * FROM spine"
    sql["missing_minutes"] = with_bars(
        "1m", f', {spine} SELECT spine.* FROM spine ANTI JOIN bars USING (symbol, "timestamp")'
    )

    high = "high >= open AND high >= close AND high >= low"
    low = "low <= open AND low <= close AND high >= low"
    price = "open > 0 AND high > 0 AND low > 0 AND close > 0"
    sql["validate_bars"] = with_bars("30m", f"""SELECT symbol, count(*) AS n_bars,
       {holds(high)} AS high_ok, {violations(high, "high_violations")},
       {holds(low)} AS low_ok, {violations(low, "low_violations")},
       {holds(price)} AS price_ok, {violations(price, "price_violations")},
       {holds(high)} AND {holds(low)} AND {holds(price)} AS valid
FROM bars GROUP BY symbol""")
    sql["validate_rollup"] = validate_rollup_sql()
    sql["validate_rollup_odd"] = validate_rollup_odd_sql()
    sql["validate_metrics"] = validate_metrics_sql()
    sql["range_check"] = f"""WITH {TICKS}, {stacked(['1m', '5m', '30m', '1d'])}, ranges AS (
  SELECT symbol, timeframe, min(low) AS low, max(high) AS high FROM stacked GROUP BY ALL)
SELECT symbol, count(*) AS n_timeframes, min(low) AS low, max(high) AS high,
       min(low) = max(low) AND min(high) = max(high) AS consistent
FROM ranges GROUP BY symbol"""
    sql["spacing"] = with_bars("30m", f""", {GAPS}
SELECT symbol, count(gap_seconds) AS n_steps,
       count(*) FILTER (gap_seconds <> 1800) AS uneven_steps,
       min(gap_seconds) AS min_step_seconds, max(gap_seconds) AS max_step_seconds,
       {holds("gap_seconds = 1800")} AS evenly_spaced
FROM gaps GROUP BY symbol""")
    sql["session_counts"] = with_bars("30m", """SELECT symbol,
       CAST("timestamp" AS DATE) AS session_date, count(*) AS n_bars,
       min("timestamp") AS first_bar, max("timestamp") AS last_bar,
       count(*) FILTER (minute("timestamp") % 30 <> 0 OR second("timestamp") <> 0) AS misaligned,
       count(*) = 48 AS count_ok
FROM bars GROUP BY ALL""")
    complete = f""", {GAPS}
SELECT symbol, count(*) AS n_bars, count(*) FILTER (gap_seconds > 90) AS gap_count,
       {r("(count(*) - count(*) FILTER (gap_seconds > 90)) / count(*) * 100", "percent_complete")}
FROM gaps GROUP BY symbol"""
    sql["completeness"] = with_bars("1m", complete)

    sql["bar_stats"] = f"""WITH {TICKS}, {stacked(['5m', '30m', '1d'])}
SELECT symbol, timeframe, count(*) AS n_bars, min("timestamp") AS first_bar,
       max("timestamp") AS last_bar, {r("min(low)", "low")}, {r("max(high)", "high")},
       CAST(sum(volume) AS BIGINT) AS total_volume, {r("avg(volume)", "mean_volume")}
FROM stacked GROUP BY symbol, timeframe"""
    sql["describe_prices"] = with_bars("30m", described("bars", list(OHLCV)))
    odd = """, odd AS (SELECT CASE WHEN symbol <> 'click' THEN symbol END AS symbol,
  CASE WHEN tie % 11 = 0 OR tie % 13 = 0 THEN NULL ELSE price END AS close FROM ticks)"""
    sql["describe_odd"] = f"WITH {TICKS}{odd} " + described("odd", ["close"])
    sql["describe_returns"] = moves(described("moves", ["returns"]))
    sql["describe_indicators"] = with_bars(
        "5m", f", {standard('5m')} " + described("metrics", ["ma_6", "median_6", *STANDARD_TAIL])
    )
    sql["describe_brand"] = (
        f"WITH {BRAND_TICKS}, renamed AS (SELECT symbol, price AS close, volume FROM ticks) "
        + described("renamed", ["close", "volume"])
    )
    sql["risk"] = moves(f"""SELECT symbol, count(returns) AS n_returns,
       {r("stddev_samp(returns)", "bar_volatility")},
       {r("stddev_samp(returns) * sqrt(252 * 390)", "annualized_volatility")},
       {r("min(low) / nullif(max(high), 0) - 1", "range_drawdown")}
FROM moves GROUP BY symbol""")
    sql["correlation"] = correlation_sql()
    sql["histogram"] = moves(f""", ranges AS (
  SELECT symbol, CASE WHEN min(returns) = max(returns) THEN min(returns) - 0.5
                      ELSE min(returns) END AS lo,
         CASE WHEN min(returns) = max(returns) THEN max(returns) + 0.5
              ELSE max(returns) END AS hi
  FROM moves WHERE returns IS NOT NULL GROUP BY symbol),
counts AS (
  SELECT symbol, CAST(least(floor((returns - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin,
         count(*) AS n_values
  FROM moves JOIN ranges USING (symbol) WHERE returns IS NOT NULL GROUP BY ALL)
SELECT ranges.symbol, CAST(b AS INTEGER) AS bin, {r("lo + (hi - lo) / 30 * b", "bin_start")},
       {r("lo + (hi - lo) / 30 * (b + 1)", "bin_end")}, coalesce(n_values, 0) AS n_values
FROM ranges CROSS JOIN generate_series(0, 29) AS bins(b)
LEFT JOIN counts ON counts.symbol = ranges.symbol AND counts.bin = b""")
    sql["distribution"] = moves(f"""SELECT symbol, count(returns) AS n_values,
       {r("avg(returns)", "mean")}, {r("quantile_cont(returns, 0.5)", "median")}
FROM moves GROUP BY symbol""")
    sql["qq_points"] = moves(f""", {QQ}
SELECT symbol, rank, {r("theoretical", "theoretical")}, {r("ordered", "ordered")} FROM points""")
    sql["qq_fit"] = moves(f""", {QQ}
SELECT symbol, count(*) AS n_points, {r("regr_slope(ordered, theoretical)", "slope")},
       {r("regr_intercept(ordered, theoretical)", "intercept")},
       {r("corr(ordered, theoretical)", "r")}
FROM points GROUP BY symbol""")
    sql["indicator_summary"] = with_bars(
        "5m", f", {standard('5m')} SELECT symbol, {summary_columns('ma_6')} FROM metrics GROUP BY symbol"
    )
    counts = ", ".join(
        f"count(*) FILTER (timeframe = '{tf}') AS n_{tf}" for tf in ("1m", "5m", "30m", "1d")
    )
    sql["ratio"] = (
        f"WITH {TICKS}, {stacked(['1m', '5m', '30m', '1d'])} "
        f"SELECT symbol, {counts} FROM stacked GROUP BY symbol"
    )
    sql["quick_stats"] = f"""WITH {TICKS}, {bars("1m")}, {RETURNS},
{bars("5m", "five")}, {standard("5m", "five")},
base AS (
  SELECT symbol, count(*) AS n_bars, {r("min(low)", "low")}, {r("max(high)", "high")},
         CAST(sum(volume) AS BIGINT) AS total_volume,
         {r("stddev_samp(returns) * 100", "volatility_pct")} FROM moves GROUP BY symbol),
means AS (
  SELECT symbol, {r("avg(vwap)", "mean_vwap")}, {r("avg(rsi)", "mean_rsi")}
  FROM metrics GROUP BY symbol)
SELECT * FROM base JOIN means USING (symbol)"""

    days = """"timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-18'"""

    def of_days(body: str, timeframe: str) -> str:
        some = f"{bars(timeframe, 'all_bars')}, bars AS MATERIALIZED (SELECT * FROM all_bars WHERE {days})"
        return f"WITH {TICKS}, {some}, {RETURNS} {body}"

    every = [*OHLCV, "returns"]
    sql["summary_describe"] = of_days(described("moves", every), "30m")
    sql["summary_describe_all"] = moves(described("moves", every))
    sql["summary_risk"] = of_days(f"""SELECT symbol, count(returns) AS n_returns,
       {r("stddev_samp(returns)", "bar_volatility")},
       {r("stddev_samp(returns) * sqrt(252 * 390)", "annualized_volatility")},
       {r("min(low) / nullif(max(high), 0) - 1", "range_drawdown")}
FROM moves GROUP BY symbol""", "30m")
    sql["summary_bars"] = of_days(f"""SELECT symbol, count(*) AS n_bars, min("timestamp") AS first_bar,
       max("timestamp") AS last_bar, {r("min(low)", "low")}, {r("max(high)", "high")},
       CAST(sum(volume) AS BIGINT) AS total_volume, {r("avg(volume)", "mean_volume")}
FROM bars GROUP BY symbol""", "30m")
    sql["summary_completeness"] = of_days(complete, "1m")
    sql["summary_dashboard"] = of_days(f""", {bars("5m", "five")}, {standard("5m", "five")},
base AS (
  SELECT symbol, count(*) AS n_bars, {r("min(low)", "low")}, {r("max(high)", "high")},
         CAST(sum(volume) AS BIGINT) AS total_volume,
         {r("stddev_samp(returns) * 100", "volatility_pct")} FROM moves GROUP BY symbol),
means AS (
  SELECT symbol, {r("avg(vwap)", "mean_vwap")}, {r("avg(rsi)", "mean_rsi")}
  FROM metrics WHERE {days} GROUP BY symbol)
SELECT * FROM base JOIN means USING (symbol)""", "1m")

    sql["run_standard"] = run_sql(
        {tf: standard(tf, f"bars_{tf}", f"metrics_{tf}", plain=True) for tf in STANDARD},
        ["ma", "median", *STANDARD_TAIL],
    )
    sql["run_compact"] = run_sql(
        {
            tf: compact(w, f"bars_{tf}", f"metrics_{tf}")
            for tf, w in {"1m": 20, "5m": 10, "30m": 5}.items()
        },
        COMPACT_NAMES,
    )
    sql["run_many_symbols"] = run_sql(
        {tf: compact(w, f"bars_{tf}", f"metrics_{tf}") for tf, w in {"5m": 6, "30m": 1}.items()},
        COMPACT_NAMES,
    )
    # Each session is a series of its own.
    per_session = with_bars(
        "5m",
        ', dated AS (SELECT *, CAST("timestamp" AS DATE) AS session_date FROM bars), '
        + compact(6, "dated")
        .replace("PARTITION BY symbol ", "PARTITION BY symbol, session_date ")
        .replace(f"SELECT {BAR_COLUMNS},", f"SELECT {BAR_COLUMNS}, session_date,")
        + " "
        + rounded_metrics(COMPACT_NAMES).replace(
            'SELECT symbol, "timestamp",', 'SELECT symbol, session_date, "timestamp",'
        ),
    )
    sql["session_batches"] = per_session
    summaries = " UNION ALL ".join(
        f"SELECT symbol, {summary_columns('ma')}, '{tf}' AS timeframe "
        f"FROM metrics_{tf} GROUP BY symbol"
        for tf in ("5m", "30m")
    )
    sql["stored_run"] = f"""WITH {TICKS}, {bars("5m", "bars_5m")}, {bars("30m", "bars_30m")},
{standard("5m", "bars_5m", "metrics_5m", plain=True)},
{standard("30m", "bars_30m", "metrics_30m", plain=True)} {summaries}"""

    sql["csv_export"] = sql["ohlc_multi"]
    sql["report_export"] = sql["completeness"]
    closed = """WHERE "timestamp" + INTERVAL '5 minutes'
      <= (SELECT max("timestamp") FROM ticks) - INTERVAL '10 minutes'"""
    sql["streaming_bars"] = with_bars("5m", f"{every_bar} {closed}")
    sql["streaming_all"] = sql["ohlc_5m"]
    sql["streaming_replayed"] = sql["ohlc_5m"]
    # A bar keeps the number of the last arrival that held a new tick of it.
    sql["streaming_corrected"] = f"""WITH {TICKS}, {bars("5m")}, came AS (
  SELECT symbol, time_bucket(INTERVAL '5 minutes', "timestamp") AS "timestamp",
         max(CASE tie % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 3 END)::BIGINT AS revision
  FROM ticks GROUP BY ALL)
SELECT bars.*, revision FROM bars JOIN came
  ON bars.symbol IS NOT DISTINCT FROM came.symbol AND bars."timestamp" = came."timestamp\""""
    sql["streaming_replaced"] = f"""WITH {TICKS}, seen AS (SELECT * FROM ticks WHERE tie % 3 <> 1), {bars("30m", source="seen")}, came AS (
  SELECT symbol, time_bucket(INTERVAL '30 minutes', "timestamp") AS "timestamp",
         max(CASE tie % 3 WHEN 2 THEN 0 ELSE 1 END)::BIGINT AS revision
  FROM seen GROUP BY ALL)
SELECT bars.*, revision FROM bars JOIN came
  ON bars.symbol IS NOT DISTINCT FROM came.symbol AND bars."timestamp" = came."timestamp\""""
    sql["metrics_stored"] = sql["metrics_standard"]
    sql["metrics_stored_week"] = f"""SELECT * FROM ({sql["metrics_standard"]})
WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-18\'"""
    sql["correlation_one_pass"] = sql["correlation"]
    sql |= run_tables(sql)
    sql["streaming_keyed"] = f"{sql['metrics_standard']} {closed}"
    sql["streaming_metrics"] = f"{sql['metrics_standard']} {closed}"
    return sql
