"""SQL of the text queries that a single-node engine can run on the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+"


def _terms(text: str) -> str:
    return f"unnest(regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '{_TERM}'))"


NORM_BUCKETS = f"""
WITH given AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text FROM documents WHERE text IS NOT NULL),
words AS (SELECT row, {_terms('text')} AS term FROM given),
tf AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM words GROUP BY row, term),
sizes AS MATERIALIZED (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
corpus AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_terms('text')} AS term FROM benchmark WHERE text IS NOT NULL)),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, corpus),
lengths AS (SELECT row, 100 - 50 + (50 * n * docs) // length AS m FROM sizes, corpus),
scores AS (
  SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (row) GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN given USING (row) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


def _clusters(k: int = 8, rounds: int = 10, length: int = 64) -> str:
    parts = [f"""
vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: isfinite(x))) = {length}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS INTEGER) AS cluster, x AS c FROM vectors
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), x) <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, cluster, distance FROM (
    SELECT row, cluster, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
    FROM vectors CROSS JOIN c{r})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (
  SELECT cluster, pos, sum(v) AS s, count(*) AS n FROM (
    SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{r} JOIN vectors USING (row))
  GROUP BY cluster, pos),
m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM s{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN vectors USING (row) JOIN c{rounds} USING (cluster)"""


ORACLES = {"op11_norm_buckets": NORM_BUCKETS, "op13_ns_bounds": _clusters()}
