"""DuckDB SQL for the corpus queries that SQL can express, by plain search over whole tables."""

#: Rows damaged by crc32, faults, then two recursions: costs to go from the end, edits from the start.
OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS n,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT g.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 20 AS kind
  FROM given g, crc
), damaged AS (
  SELECT conv_id, turn, n, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role)::VARCHAR || ':' || role || text), n, copy) AS i FROM damaged
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before, role[1] AS initial
  FROM placed
), counts AS (
  SELECT conv_id, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), back AS (
  SELECT conv_id, rows + 1 AS i, [0, 4, 2, 0] AS f, [NULL, 'I', 'I', NULL]::VARCHAR[] AS e FROM counts
  UNION ALL
  SELECT conv_id, i, [x.c FOR x IN best], [x.e FOR x IN best] FROM (
    SELECT conv_id, i, list_transform(range(1, 5), lambda s: list_min([{'c': own[s], 'e': kinds[s]}, {'c': 2 + least(own[goes[s]], 2 + own[goes[goes[s]]]), 'e': 'I'}])) AS best
    FROM (
      SELECT conv_id, i, [3, 3, 4, 3] AS goes, [x.c FOR x IN edits] AS own, [x.e FOR x IN edits] AS kinds FROM (
        SELECT b.conv_id, r.i, list_transform(range(1, 5), lambda s: list_min(list_filter([
            {'c': b.f[s] + 3, 'e': 'D'},
            {'c': CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN b.f[[3, 3, 4, 3][s]] + 2 + (r.fault = 'truncated')::INT END, 'e': 'R'},
            {'c': CASE WHEN r.fault NOT IN ('blank', 'duplicate') AND (s = 1 AND r.initial = 's' OR r.initial = CASE s WHEN 3 THEN 'a' ELSE 'u' END)
                THEN b.f[CASE WHEN r.initial = 's' THEN 2 ELSE [3, 3, 4, 3][s] END] + (r.fault = 'truncated')::INT END, 'e': 'K'}
          ], lambda x: x.c IS NOT NULL))) AS edits
        FROM back b JOIN faults r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1
      )
    )
  )
), forth AS (
  SELECT conv_id, 1::BIGINT AS i, 1 AS s, '' AS audit, NULL::VARCHAR AS lines FROM counts
  UNION ALL
  SELECT f.conv_id, f.i + (edit <> 'I')::INT, CASE WHEN edit = 'D' THEN f.s WHEN edit = 'K' AND r.initial = 's' THEN 2 ELSE [3, 3, 4, 3][f.s] END, audit || edit,
    CASE WHEN edit = 'D' THEN lines ELSE coalesce(lines || chr(10), '') || CASE edit WHEN 'K' THEN r.role ELSE ['user', 'user', 'assistant', 'user'][f.s] END || ':' || CASE edit WHEN 'I' THEN '' ELSE r.text END END
  FROM (SELECT f.*, b.e[f.s] AS edit FROM forth f JOIN back b ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.i) f
  LEFT JOIN faults r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i
  WHERE edit IS NOT NULL
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.f[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 1
LEFT JOIN (SELECT conv_id, arg_max(audit, strlen(audit)) AS audit, arg_max(lines, strlen(audit)) FILTER (lines IS NOT NULL) AS lines FROM forth GROUP BY conv_id) f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP12 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""


def _op13(rounds: int = 3) -> str:
    """The rounds one after another: nearest centroids, then floors of means, where a cluster has vectors."""
    steps = []
    for r in range(rounds + 1):
        # centroids may be negative: floors of quotients of integers
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, best.k AS k, best.d AS d FROM (
    SELECT vec_id, v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'k': k}}) AS best FROM v, c{r} GROUP BY vec_id, v))""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY k, i) GROUP BY k) m ON m.k = c.k)""")
    return f"""WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS h, v FROM v ORDER BY h LIMIT 16)
), {', '.join(steps)}
SELECT vec_id, a.k::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


ORACLE_SQL = {"op11_conversation_repair": OP11, "op12_topk_search": OP12, "op13_centroid_clustering": _op13()}
