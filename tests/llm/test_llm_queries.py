"""The package's queries: against their SQL, and the pipeline against versions by other means."""

from __future__ import annotations

import collections
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402
import corpus_pipeline  # noqa: E402

from barloom.llm import mixing, oracle, pieces, queries, secrets, toxicity  # noqa: E402
from barloom.llm.common import components, sieve, table  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_one_query_an_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert contract.queries().keys() >= {*queries.QUERIES, "pipeline"}


@pytest.mark.parametrize("name", oracle.ORACLES)
def test_query_agrees_with_sql(spark, name):
    ok, note = compare.compare(spark, compare.connect(SF), name, SF)
    assert ok, note


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    # toxicity: the classifier's verdict decides
    scores = toxicity.judge(docs, table(spark, SF, "labels")).collect()
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores if not r.predicted}

    # near duplicates: one of each component of the links
    from test_llm_jaccard import brute

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, found = brute(rows, 5, 80)
    single = stages["near_duplicates"](spark, docs, SF).collect()
    least = collections.defaultdict(list)
    for (i, _), c in zip(rows, found, strict=True):
        least[c].append(i)
    assert sorted(r.doc_id for r in single) == sorted(min(g) for g in least.values())

    # secrets: only spans of the scan change
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secrets.scan(docs).collect()}
    for r in stages["secrets"](spark, docs, SF).collect():
        want, at = "", 0
        for start, end in spans[r.doc_id]:
            if start >= at:
                want += texts[r.doc_id][at:start] + "[SECRET]"
            at = max(at, end)
        want += texts[r.doc_id][at:]
        assert r.text == want and r.n_chars == len(want)

    # mixing: rows as often as the mix says
    copies = collections.Counter()
    mixed = stages["mixing"](spark, docs, SF)
    assert mixed.columns == columns
    for r in mixed.collect():
        assert r.text == texts[r.doc_id]
        copies[r.doc_id] += 1
    plan = {r.doc_id: r for r in mixing.mix(docs, whole=True).collect()}
    ratio = {i: r.target / r.source_size for i, r in plan.items() if r.source_size}
    assert all(int(ratio[i]) <= copies[i] <= int(ratio[i]) + 1 for i in plan if plan[i].size)

    # segmentation: decodes to the text
    ids = stages["sentencepiece"](spark, docs, SF)
    assert ids.where("NOT lossless").count() == 0
    assert {r.doc_id: r.text for r in pieces.decode(ids).collect()} == texts


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) >= {"doc_id", "ids", "n_pieces"} and out.count() > 0


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (7, 10), (5, 5), (20, 21), (21, 20)] + [(100 + i, 101 + i) for i in range(30)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 10: 7, 20: 20, 21: 20} | {100 + i: 100 for i in range(31)}
    assert found == want


def test_sieve_loses_no_row(spark):
    df = spark.range(0, 100_000).selectExpr("xxhash64(id) AS k", "id")
    wanted = spark.range(0, 100_000, 97).selectExpr("xxhash64(id) AS w")
    kept = {r.id for r in sieve(df, df.k, wanted, "w").collect()}
    assert set(range(0, 100_000, 97)) <= kept and len(kept) < 3000
    assert sieve(df, df.k, wanted.limit(0), "w").count() == 0
