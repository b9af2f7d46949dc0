"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

HOST_QUALITY_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT rid, p0, array_to_string(ws[p0:p0 + 7], ' ') AS w
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS p0 FROM docs)),
twice AS (
  SELECT rid, p0 FROM (SELECT rid, p0, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(p0, p0 + 8)) AS p FROM twice) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n, count(DISTINCT line) AS own
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
base AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n - l.own, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0)::BIGINT AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN repeated r USING (rid) LEFT JOIN lines l USING (rid)),
judged AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2,
         100 * n_symbols > 10 * word_chars AS f3, 100 * n_dup_lines > 30 * n_lines AS f4
  FROM base),
failures AS (
  SELECT source, rule, count(*) AS n, sum(f::INT) AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS f FROM judged WHERE source IS NOT NULL)
  GROUP BY source, rule),
moments AS (
  SELECT rule, sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 AS v FROM failures GROUP BY rule),
prior AS (
  SELECT rule, m, CASE WHEN v <= 1e-12 THEN 1e6 ELSE least(greatest(m * (1 - m) / v - 1, 1), 1e6) END AS s FROM moments),
hosts AS (
  SELECT source, max((k + m * s) / (n + s)) > 0.5 AS bad FROM failures JOIN prior USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       coalesce(bad, FALSE) AS host_rejected, NOT (f1 OR f2) AND NOT coalesce(bad, FALSE) AS kept
FROM judged LEFT JOIN hosts USING (source)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT rid, array_to_string(ws[p0:p0 + 3], ' ') AS s
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS p0 FROM docs)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
common AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.rid < y.rid GROUP BY 1, 2),
half AS (
  SELECT a, b FROM common JOIN sizes p ON p.rid = a JOIN sizes q ON q.rid = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach(rid, other) AS (
  SELECT rid, rid FROM docs UNION SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.other),
lowest AS (SELECT reach.rid, min(doc_id) AS component_id FROM reach JOIN docs ON docs.rid = reach.other GROUP BY reach.rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(component_id = doc_id, FALSE) AS kept
FROM docs JOIN lowest USING (rid) LEFT JOIN sizes USING (rid)
"""

# One round: every vector to its nearest centroid, then the floors of the means; a centroid without members stays.
CLUSTER_ROUND = r"""
d{n} AS MATERIALIZED (
  SELECT rid, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{n}),
a{n} AS MATERIALIZED (
  SELECT rid, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1),
m{n} AS (
  SELECT k, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
  FROM (SELECT k, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{n} JOIN kept USING (rid)) GROUP BY k, i),
c{next} AS MATERIALIZED (
  SELECT k, coalesce((SELECT list(x ORDER BY i) FROM m{n} WHERE m{n}.k = c{n}.k), c) AS c FROM c{n})"""

CENTROID_CLUSTERS = (
    r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT 40)),"""
    + ",".join(CLUSTER_ROUND.replace("{n}", str(n)).replace("{next}", str(n + 1)) for n in range(6))
    + r"""
SELECT vec_id, a5.k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a5.k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.c, ',')) AS centroid_sha256
FROM a5 JOIN kept USING (rid) JOIN c5 ON c5.k = a5.k
"""
)

LLM_ORACLE: dict[str, str] = {
    "op1_host_quality_rules": HOST_QUALITY_RULES,
    "op6_near_duplicates": NEAR_DUPLICATES,
    "op11_centroid_clusters": CENTROID_CLUSTERS,
}
