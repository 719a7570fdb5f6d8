"""Named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import ann, clusters, html, jaccard, lm, mixing, pieces, repeats, resample, secrets, topk, toxicity, urls
from barloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "part")


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


@query
def op7_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), width=4, percent=85)


@query
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))
