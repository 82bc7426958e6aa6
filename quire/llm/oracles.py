"""DuckDB SQL of the contracts that SQL can express over whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words hold no blank, so words joined by blanks stand for shingles without doubt.
OP4 = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, hash(unnest(sh)) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.x, p.y FROM p JOIN n a ON a.doc_id = p.x JOIN n b ON b.doc_id = p.y WHERE 100 * p.c >= 85 * (a.n + b.n - p.c)),
b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS f, doc_id AS t FROM n UNION SELECT r.f, b.y FROM r JOIN b ON b.x = r.t)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id, m.c = n.doc_id AS kept FROM n JOIN (SELECT f, min(t) AS c FROM r GROUP BY f) m ON m.f = n.doc_id"""

_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)
OP7 = rf"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), i0 AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
i AS (SELECT item_id, ws, least(13, len(ws)) AS k FROM i0 WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, k, g FROM (SELECT item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: array_to_string(ws[j:j + k - 1], ' '))) AS g FROM i)),
ks AS (SELECT DISTINCT k FROM i), dw0 AS (SELECT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda j: {{'j': j, 'g': array_to_string(ws[j:j + k - 1], ' ')}})) AS x FROM d JOIN ks ON len(ws) >= k),
m AS (SELECT w.doc_id, w.k, w.x.j AS j, iw.item_id FROM dw0 w JOIN iw ON iw.k = w.k AND iw.g = w.x.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(j, j + k)) AS q FROM (SELECT DISTINCT doc_id, j, k FROM m)) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS a FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.a, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
