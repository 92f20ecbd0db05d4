"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

SUBSTRING = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
    FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
own AS (SELECT g, min(doc_id) AS o FROM win GROUP BY g),
hit AS (
    SELECT DISTINCT doc_id, j
    FROM (SELECT doc_id, i FROM win JOIN own USING (g) WHERE o < doc_id) AS s,
         unnest(range(i, i + 13)) AS t(j)),
gone AS (SELECT doc_id, list(j) AS js FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, k: NOT list_contains(coalesce(js, []), k)),
                              ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

EMBEDDING = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
    SELECT vec_id, e FROM v
    WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
    SELECT vec_id AS x, vec_id AS y FROM v
    UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
comp AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
deg AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM comp LEFT JOIN deg USING (vec_id)
"""

NGRAM = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
g AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                                 ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 9 * count(*) >= 4 * (na.n + nb.n)),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM d
    UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
comp AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
deg AS (SELECT x AS doc_id, count(*) AS n FROM link GROUP BY x),
copies AS (SELECT text, min(doc_id) AS copy_id FROM d WHERE len(w) > 0 GROUP BY text)
SELECT comp.doc_id, coalesce(copy_id, comp.doc_id) AS copy_id, class_id,
       CAST(coalesce(n, 0) AS BIGINT) AS n_links, comp.doc_id = class_id AS kept
FROM comp JOIN d ON d.doc_id = comp.doc_id
LEFT JOIN deg ON deg.doc_id = comp.doc_id LEFT JOIN copies ON copies.text = d.text AND len(d.w) > 0
"""

DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + 12], ' ') AS g
    FROM b, unnest(range(1, greatest(len(w) - 11, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM iw),
dw AS (
    SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
    FROM d, sizes, unnest(range(1, len(w) - m + 2)) AS t(i)),
hit AS (SELECT doc_id, m, i, item_id FROM dw JOIN iw USING (m, g)),
cover AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + m)) AS t(j)
    GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items,
           array_to_string(list_sort(list(CAST(item_id AS VARCHAR))), ',') AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# A run is read off the pairs of equal 6-word grams of a text: at least 6 words agree
# with the words one period on, so neighbouring pairs at one distance form its stretch.
PERIODIC = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
               string_split(CAST(doc_id AS VARCHAR), ''),
               lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))),
               lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END))
           AS crc FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, xor(crc, 4294967295) AS h FROM d),
g AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS parts FROM h),
t AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        CASE WHEN i < a THEN w[i + 1]
             ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END) ELSE w END AS w FROM g),
gram AS (
    SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS s
    FROM t, unnest(range(0, n - 5)) AS u(i)),
pair AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q,
           x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
    FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
stretch AS (
    SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM pair GROUP BY doc_id, q, island),
run AS (
    SELECT doc_id, s, e, min(q) AS q FROM stretch WHERE e - s >= greatest(12, 2 * q)
    GROUP BY doc_id, s, e),
gone AS (
    SELECT doc_id, list(DISTINCT j) AS js FROM run, unnest(range(s + q, e)) AS u(j) GROUP BY doc_id),
per AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
           first(s ORDER BY e - s DESC, s, q) AS start,
           first(e - s ORDER BY e - s DESC, s, q) AS length,
           first(q ORDER BY e - s DESC, s, q) AS period FROM run GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period,
       1000 * length // period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(
           w, lambda x, k: NOT list_contains(js, k - 1)) END, ' ')) AS collapsed_sha256
FROM t LEFT JOIN per USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

HARD_NEGATIVES = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES = {
    "op1_substring_dedup": SUBSTRING,
    "op2_embedding_dedup": EMBEDDING,
    "op9_ngram_join": NGRAM,
    "op10_decontamination": DECONTAMINATION,
    "op11_periodic_runs": PERIODIC,
    "op12_hard_negatives": HARD_NEGATIVES,
}
