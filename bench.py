"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  directory of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all of them)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom.plans.catalog import QUERIES, table  # noqa: E402
from barloom.session import local_session  # noqa: E402

HEADLINE = (
    "ohlc_5m",
    "ohlc_multi",
    "ohlc_daily_brand",
    "moving_average",
    "moving_median",
    "moving_median_long",
    "vwap_series",
    "bollinger",
    "rsi",
    "metrics_standard_1m",
    "metrics_standard",
    "metrics_compact",
    "metrics_brand",
    "returns",
    "rolling_vol",
    "price_index",
    "validate_rollup",
    "validate_metrics",
    "describe_prices",
    "risk",
    "correlation",
    "histogram",
    "qq_points",
    "indicator_summary",
    "missing_minutes",
    "quick_stats",
    "run_standard",
    "run_compact",
)
# Input rows of the rates reported next to the times.
RATES = {
    "ohlc_multi": "events",
    "metrics_standard": "events",
    "run_standard": "events",
    "ohlc_daily_brand": "lineitem",
    "metrics_brand": "lineitem",
}


# Queries whose result is one row a bar.
BARS = ("ohlc_5m", "ohlc_multi", "metrics_standard_1m", "metrics_standard", "metrics_compact", "run_standard")


def timed(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds in all, and those of them until the query was built; Spark plans once, in the write."""
    start = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    planned = time.perf_counter() - start
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start, planned


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    spark = local_session(cores, shuffle_partitions=int(cores), memory="8g")
    sizes = {t: table(spark, sf_dir, t).count() for t in set(RATES.values())}
    for name in HEADLINE:  # start-up and compilation are not part of a query
        timed(spark, name, sf_dir)
    runs = {name: min(timed(spark, name, sf_dir) for _ in range(3)) for name in HEADLINE}
    best = {name: round(seconds, 4) for name, (seconds, _) in runs.items()}
    made = {n: QUERIES[n](spark, sf_dir).count() for n in BARS}
    rates = {n: round(sizes[t] / best[n]) for n, t in RATES.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, best of three each",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "building_sec": {name: round(planned, 4) for name, (_, planned) in runs.items()},
                "input_rows_per_sec": rates,
                "bars_per_sec": {n: round(made[n] / best[n]) for n in BARS},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
