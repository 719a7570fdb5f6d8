"""SQL (DuckDB) for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op9_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cleaned AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^?#]*') AS rest FROM parts
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM cleaned
), judged AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM split
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

ORACLES["op3_exact_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)])
  END AS s FROM words
), grams AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * c >= 85 * (len(a.s) + len(b.s) - c)
), directed AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(id, r) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT reach.id, directed.y FROM reach JOIN directed ON reach.r = directed.x
), least AS (
  SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN least ON id = doc_id
"""


def _clustering(rounds: int) -> str:
    """One group of steps a round: assign, then move."""
    parts = [
        """kept AS (
  SELECT row_number() OVER () AS i, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1)::INTEGER AS cluster, x FROM kept
  ORDER BY sha256('1:' || vec_id), x LIMIT 16
)"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""far{r} AS (
  SELECT i, cluster, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(kept.x, c{r}.x)])::BIGINT AS distance
  FROM kept CROSS JOIN c{r}
), near{r} AS (
  SELECT i, cluster, distance FROM far{r}
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY distance, cluster) = 1
)"""
        )
        if r < rounds:
            parts.append(
                f"""mean{r} AS (
  SELECT cluster, d, floor(sum(v) / count(*))::BIGINT AS v
  FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS d FROM near{r} JOIN kept USING (i))
  GROUP BY cluster, d
), c{r + 1} AS (
  SELECT cluster, coalesce(m.x, c{r}.x) AS x
  FROM c{r} LEFT JOIN (SELECT cluster, list(v ORDER BY d) AS x FROM mean{r} GROUP BY cluster) m USING (cluster)
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, cluster, distance,
       sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (i) JOIN c{rounds} USING (cluster)
"""


ORACLES["op11_centroid_clustering"] = _clustering(3)

# DuckDB has no checksum crc32: its table is built bit by bit, then folded over the bytes.
ORACLES["op12_importance_resampling"] = r"""
WITH RECURSIVE bits(i, step, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE step < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8
), texts AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), feature AS (
  SELECT kind, id, unnest(w) AS f FROM words
), spelt AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)
), bucketed AS (
  SELECT f, xor(list_reduce(
      list_prepend(4294967295::BIGINT, [('0x' || h[2 * j - 1:2 * j])::BIGINT for j in range(1, len(h) // 2 + 1)]),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM spelt CROSS JOIN crc
), counted AS (
  SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
  FROM feature JOIN bucketed USING (f) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
      / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS g FROM counted
), meant AS (
  SELECT id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
  FROM feature JOIN bucketed USING (f) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT
           + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN meant ON id = doc_id
), ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * 10 // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
"""
