"""DuckDB SQL for the queries of this subpackage that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) AS i FROM w),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS win FROM s),
f AS (SELECT win, min(doc_id) AS least FROM h GROUP BY win),
hit AS (SELECT h.doc_id, h.i FROM h JOIN f ON h.win = f.win AND f.least < h.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
g AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed,
       sha256(CASE WHEN g.n IS NULL THEN array_to_string(ws, ' ')
              ELSE coalesce(array_to_string(list_filter(ws, lambda x, j: NOT list_contains(g.ps, j)), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""

OP7 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM pairs JOIN n nu ON u = nu.doc_id JOIN n nv ON v = nv.doc_id WHERE 100 * k >= 85 * (nu.n + nv.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.v FROM reach JOIN link ON reach.b = link.u),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN c ON w.doc_id = c.doc_id
"""

ORACLES = {"op1_substring_dedup": OP1, "op7_minhash_dedup": OP7}
