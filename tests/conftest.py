from __future__ import annotations

import os
import random
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.schema import BAR_SCHEMA  # noqa: E402
from barloom.session import local_session  # noqa: E402

START = datetime(2024, 1, 2, 9, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        shuffle_partitions=4,
        memory="4g",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    def build(rows):
        return spark.createDataFrame(rows, BAR_SCHEMA)

    return build


def minute_rows(
    symbol: str = "A",
    *,
    minutes: int = 390,
    seed: int = 42,
    start: datetime = START,
    price: float = 100.0,
) -> list[tuple]:
    """A random walk of one-minute bars."""
    rng = random.Random(f"{symbol}-{seed}")
    rows = []
    for i in range(minutes):
        open_ = price
        close = open_ * (1 + rng.gauss(0, 0.001))
        inner = [open_ * (1 + rng.gauss(0, 0.0005)) for _ in range(4)]
        rows.append(
            (
                symbol,
                start + timedelta(minutes=i),
                open_,
                max(open_, close, *inner),
                min(open_, close, *inner),
                close,
                rng.randint(1000, 9999),
            )
        )
        price = close
    return rows


def sparse_rows(symbol: str, *, days: int = 40, seed: int = 1) -> list[tuple]:
    """Bars with idle days and busy days, so blocks are short, long or missing."""
    rng = random.Random(f"{symbol}-{seed}")
    rows = []
    for day in range(days):
        busy = rng.choice([0, 0, 1, 2, 5, 40])
        for minute in sorted(rng.sample(range(1440), busy)):
            low = rng.uniform(1, 100)
            high = low + rng.uniform(0, 5)
            rows.append(
                (
                    symbol,
                    datetime(2024, 1, 1) + timedelta(days=day, minutes=minute),
                    rng.uniform(low, high),
                    high,
                    low,
                    rng.uniform(low, high),
                    rng.choice([0, 1, 7, 100]),
                )
            )
    return rows


def collect(df, *order):
    return [r.asDict() for r in df.orderBy(*(order or ("symbol", "timestamp"))).collect()]
