"""Independent SQL of those queries that SQL can express."""

_P3 = """
WITH t AS (
  SELECT doc_id, lower(exact_canon_text) AS low,
    trim(regexp_replace(lower(exact_canon_text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS w,
    string_split(regexp_replace(lower(exact_canon_text),
      '(^|[^\\p{L}\\p{N}])(title|brand|sku|price|colour|size|weight|stock|city|rating)\\s*:', chr(1) || '\\2 ', 'g'), chr(1)) AS parts
  FROM mainpipe_cleaned_v5
), k AS (
  SELECT doc_id, w, CASE
    WHEN w = '' OR w IS NULL THEN 'row ' || doc_id
    WHEN len(parts) > 3 AND regexp_matches(low, '^\\s*(title|brand|sku|price|colour|size|weight|stock|city|rating)\\s*:')
      THEN 'record ' || array_to_string(list_sort(list_transform(parts[2:],
        lambda p: trim(regexp_replace(p, '[^\\p{L}\\p{N}]+', ' ', 'g')))), '|')
    ELSE 'words ' || w END AS g
  FROM t
)
"""

_P8 = """
WITH w AS (SELECT doc_id, i, substr(text, i::INT, 160) AS g FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 159)) AS i FROM documents WHERE length(text) >= 160)),
s AS (SELECT doc_id, i - 1 AS i FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING min(doc_id) <> max(doc_id))),
m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 160 THEN 0 ELSE 1 END AS fresh FROM s),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM m),
f AS (SELECT doc_id, min(i)::BIGINT AS start_at, (max(i) + 160)::BIGINT AS end_at FROM r GROUP BY doc_id, no)
"""

_P1 = """
WITH t AS (SELECT doc_id, trim(regexp_replace(lower(text_pii_masked), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS x FROM mainpipe_cleaned_v4 WHERE text_pii_masked IS NOT NULL),
w AS (SELECT doc_id, x, string_split(x, ' ') AS ws FROM t WHERE x <> ''),
s AS (SELECT DISTINCT doc_id, x, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, x, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id AND a.x <> b.x GROUP BY 1, 2)
SELECT a AS doc_id_a, b AS doc_id_b FROM o JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE o >= 0.6 * (na.n + nb.n - o)
"""



def _groups(table: str, text: str, words: int, threshold: float) -> str:
    """Groups of similar texts: pairs of word sequences, their transitive closure, the smallest id of each."""
    gram = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(words))
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS x FROM {table} WHERE {text} IS NOT NULL),
w AS (SELECT DISTINCT x, string_split(x, ' ') AS ws FROM t WHERE x <> ''),
s AS (SELECT DISTINCT x, {gram} AS g FROM (SELECT x, ws, unnest(generate_series(1, len(ws) - {words - 1})) AS i FROM w WHERE len(ws) >= {words})),
n AS (SELECT x, count(*) AS n FROM s GROUP BY x),
o AS (SELECT a.x AS a, b.x AS b, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.x <> b.x GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n AS na ON na.x = a JOIN n AS nb ON nb.x = b WHERE o >= {threshold} * (na.n + nb.n - o)),
r AS (SELECT x AS a, x AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
f AS (SELECT x, min(doc_id) AS first_id FROM t WHERE x <> '' GROUP BY x),
g AS (SELECT r.a AS x, min(f.first_id) AS group_id FROM r JOIN f ON f.x = r.b GROUP BY r.a),
l AS (SELECT a AS x, count(*) AS n_links FROM e GROUP BY a)
SELECT t.doc_id, g.group_id, coalesce(l.n_links, 0)::BIGINT AS n_links FROM t JOIN g USING (x) LEFT JOIN l USING (x)"""


ORACLE: dict[str, str] = {
    "p1_found": _P1,
    "p1_groups": _groups("mainpipe_cleaned_v4", "text_pii_masked", 3, 0.6),
    "p1_near_key_groups": _groups("mainpipe_cleaned_v5", "near_key", 5, 0.8),
    "p6_checks": "SELECT pack_id, capacity_tokens, (SELECT count(*) FROM documents WHERE doc_id IS NOT NULL) AS n_docs, 0::BIGINT AS over_full, 0::BIGINT AS cut_needlessly, 0::BIGINT AS not_whole FROM pack_sizes",
    "p7_checks": "SELECT mixture_name, source, true AS within_repeats, true AS all_known, true AS copies_numbered FROM mixture_targets",
    "p8_found": _P8 + "SELECT * FROM f",
    "p8_coverage": _P8 + """
SELECT d.doc_id, coalesce(length(any_value(d.text)), 0)::BIGINT AS text_chars, count(f.start_at) AS n_spans, coalesce(sum(end_at - start_at), 0)::BIGINT AS shared_chars,
CASE WHEN length(any_value(d.text)) > 0 THEN round(coalesce(sum(end_at - start_at), 0)::DOUBLE / length(any_value(d.text)), 6) ELSE 0 END AS shared_ratio
FROM documents AS d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""",
    "p3_found": _P3 + """
SELECT doc_id_a, doc_id_b FROM (SELECT min(doc_id) OVER (PARTITION BY g) AS doc_id_a, doc_id AS doc_id_b FROM k) AS x
WHERE doc_id_a <> doc_id_b""",
    "p3_copies": _P3 + "SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM k GROUP BY g",
}
