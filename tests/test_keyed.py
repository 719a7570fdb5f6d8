"""Indicators from a ring of rows: any split of a series gives the whole series' values."""

from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest

from barloom.operators import indicators
from barloom.operators.indicators import WindowSet
from barloom.schema import BAR_SCHEMA
from barloom.streaming import bars as streaming
from barloom.streaming.keyed import keyed_metrics, keyed_session, metrics_after
from conftest import START, collect, minute_rows

WINDOWS = WindowSet(5, 4, 6, 3)


@pytest.mark.parametrize("seed", range(4))
def test_any_split(seed):
    rng = random.Random(seed)
    closes = np.array([rng.choice([1.0, 2.0, rng.uniform(1, 3)]) for _ in range(60)])
    whole = metrics_after(closes, True, len(closes), WINDOWS)
    length, at = 6, 0
    while at < len(closes):
        to = min(len(closes), at + rng.choice([1, 1, 2, 7, 20]))
        ring = closes[max(0, at - length - 1) : at]
        part = metrics_after(np.concatenate([ring, closes[at:to]]), at <= length, to - at, WINDOWS)
        for name, values in part.items():
            assert values == pytest.approx(whole[name][at:to], rel=1e-12), (name, at)
        at = to


def test_batches_of_a_stream(spark, tmp_path, make_bars):
    files = []
    for i in range(4):
        rows = [r for s in "AB" for r in minute_rows(s, minutes=25, seed=i, start=START + timedelta(minutes=25 * i))]
        files.append(rows)
        make_bars(rows).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    child = keyed_session(spark, 2)
    source = streaming.read_file_stream(child, str(tmp_path / "in/*"), BAR_SCHEMA, files_per_batch=1)
    out = keyed_metrics(source, "1m", windows=WINDOWS)
    query = streaming.write_available(out, str(tmp_path / "out"), str(tmp_path / "state"))
    # the state is a row a symbol, whatever the number of batches
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 2
    found = collect(spark.read.parquet(str(tmp_path / "out")))
    want = collect(indicators.standard_metrics(make_bars([r for f in files for r in f]), "1m", WINDOWS))
    assert len(found) == len(want) == 200
    for a, b in zip(found, want, strict=True):
        assert (a["symbol"], a["timestamp"]) == (b["symbol"], b["timestamp"]) and a.keys() == b.keys()
        assert [a[c] for c in a if c not in ("symbol", "timestamp")] == pytest.approx([b[c] for c in a if c not in ("symbol", "timestamp")], rel=1e-9)
    # a later run goes on; bars that do not follow are refused
    make_bars(files[0][:25]).coalesce(1).write.parquet(str(tmp_path / "in/9"))
    with pytest.raises(Exception, match="do not follow"):
        streaming.write_available(out, str(tmp_path / "out"), str(tmp_path / "state"))
