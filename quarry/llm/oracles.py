"""DuckDB statements for the queries of this subpackage that SQL can express."""

from quarry.llm.license_texts import TEMPLATES

EXACT_DEDUP = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)
"""

MIXING = r"""
WITH RECURSIVE s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
b AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS place FROM a),
c AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS most FROM b),
d AS (SELECT *, most / weight AS room FROM c),
e AS (SELECT *, row_number() OVER (ORDER BY room, place) AS step,
        ((sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY room, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY room, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS each FROM d),
f AS (SELECT *, min(CASE WHEN each <= room THEN step END) OVER () AS first FROM e),
g AS (SELECT *, max(CASE WHEN step = first THEN each END) OVER () AS share FROM f),
i AS (SELECT source, source_size, CASE WHEN step < first THEN most::DOUBLE ELSE least(share * weight, most::DOUBLE) END AS target FROM g),
j AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::INT AS whole FROM i),
k AS (SELECT s.*, source_size, target, whole, target - whole * source_size AS budget,
        sum(size) OVER (PARTITION BY s.source ORDER BY h)::BIGINT AS run FROM s JOIN j ON s.source IS NOT DISTINCT FROM j.source),
l AS (SELECT *, run <= budget AS fits, budget - coalesce(max(CASE WHEN run <= budget THEN run END) OVER (PARTITION BY source), 0) AS gap FROM k),
m AS (SELECT source, doc_id, size, gap, row_number() OVER (PARTITION BY source ORDER BY size DESC, h) AS i FROM l WHERE NOT fits AND size > 0 AND size <= gap),
n AS (SELECT DISTINCT source, 0::BIGINT AS i, gap, NULL::BIGINT AS doc_id, false AS extra FROM m
      UNION ALL SELECT m.source, m.i, n.gap - CASE WHEN m.size <= n.gap THEN m.size ELSE 0 END, m.doc_id, m.size <= n.gap FROM n JOIN m ON m.i = n.i + 1 AND m.source IS NOT DISTINCT FROM n.source)
SELECT l.doc_id, size, source_size, target, (least(whole + (fits OR coalesce(extra, false))::INT, 3) * size)::BIGINT AS taken
FROM l LEFT JOIN (SELECT doc_id, extra FROM n WHERE extra) x ON x.doc_id = l.doc_id
"""

LICENSE_SCAN = rf"""
WITH l(template, body) AS (VALUES {", ".join("('%s', '%s')" % (k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))}),
v AS (SELECT template, trim(regexp_replace(lower(body), '[^a-z0-9]+', ' ', 'g')) AS t FROM l),
w AS (SELECT template, string_split(t, ' ') AS w FROM v),
ts AS (SELECT DISTINCT template, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w),
n AS (SELECT template, count(*) AS n_shingles FROM ts GROUP BY template),
d AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d),
s AS (SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s FROM p),
m AS (SELECT doc_id, template, count(DISTINCT s) AS n_matched, min(place) AS first_word, max(place) + 4 AS last_word FROM s JOIN ts USING (s) GROUP BY ALL)
SELECT doc_id, template, n_shingles, n_matched, round(n_matched / n_shingles, 6) AS containment, first_word::INT AS first_word, last_word::INT AS last_word
FROM m JOIN n USING (template) WHERE n_matched >= 0.8 * n_shingles
"""

TOP_K = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS least FROM d UNION SELECT u.b, r.least FROM r JOIN u ON r.doc_id = u.a AND r.least < u.b),
c AS (SELECT doc_id, min(least) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.doc_id = d.doc_id
"""

ORACLES = {"op10_near_dedup": NEAR_DEDUP, "op1_license_scan": LICENSE_SCAN, "op4_topk_search": TOP_K, "op2_mixing": MIXING, "op9_exact_dedup": EXACT_DEDUP}
