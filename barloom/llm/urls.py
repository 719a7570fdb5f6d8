"""URL filters: a trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Rule = tuple[str, str, str]

# The rules of the query: verdict, host, path.
RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# The trie goes to every executor, so its size is checked.
MAX_RULES = 1_000_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lowered) and path; both empty for null or where there is no ://."""
    if not isinstance(url, str):
        return "", ""
    start = url.find("://")
    if start < 0:
        return "", ""
    rest = url[start + 3 :]
    ends = [i for i in map(rest.find, "?#") if i >= 0]
    if ends:
        rest = rest[: min(ends)]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nodes of host labels, last label first; under "/" of a node its trie of path segments.

    A path's last piece is kept as a prefix, for a rule may end inside a segment. Of
    equal rules with both verdicts the block counts.
    """
    root: dict = {}
    n = 0
    for verdict, host, path in rules:
        n += 1
        if n > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules; the trie is sent to every executor")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.setdefault("labels", {}).setdefault(label, {})
        node = node.setdefault("/", {})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.setdefault("segments", {}).setdefault(segment, {})
        ends = node.setdefault("ends", {})
        if ends.get(rest, ("allow",))[0] != "block":
            ends[rest] = (verdict, host + path)
    return root


def _path_rule(node: dict, segments: list[str]) -> tuple[str, str] | None:
    best = None
    for segment in segments:
        fits = [k for k in node.get("ends", ()) if segment.startswith(k)]
        if fits:
            best = node["ends"][max(fits, key=len)]
        node = node.get("segments", {}).get(segment)
        if node is None:
            break
    return best


def look_up(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Verdict and rule of the deepest host, and there of the longest path, that fit."""
    best, node, segments = None, trie, path.split("/")
    for label in reversed(host.split(".")):
        node = node.get("labels", {}).get(label)
        if node is None:
            break
        if "/" in node:
            best = _path_rule(node["/"], segments) or best
    return best


def filter_urls(
    df: DataFrame,
    rules: Iterable[Rule] = RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """id_col, host, path, rule and verdict of every row.

    Where no rule fits, rule is null and the verdict is `default`. A null url, or one
    without ://, has an empty host and path, which no rule with a host fits. Every
    input row gives one row, repeated ones and those without an id too; other
    columns are not read. An empty table gives an empty one.
    """
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [look_up(trie.value, *p) for p in parts]
            columns = (
                [p[0] for p in parts],
                [p[1] for p in parts],
                [f and f[1] for f in found],
                [f[0] if f else default for f in found],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns)],
                [id_col, "host", "path", "rule", "verdict"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, url_col).mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    )
