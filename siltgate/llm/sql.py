"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from siltgate.llm.licenses import ANCHORS, FILE_MIN, HEADER_MIN, TEMPLATES, anchored_notices

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op3() -> str:
    templates = ", ".join(
        f"({k}, {_quote(n)}, {_quote(t)})" for k, (n, t) in enumerate(TEMPLATES)
    )
    notices = ", ".join(
        f"({k}, {_quote(n)}, '{a}', {before}, {size})" for k, n, a, before, size in anchored_notices()
    )
    anchors = ", ".join(f"'{a}'" for a in ANCHORS)
    words = f"list_filter(string_split_regex({_LOWER.format('text')}, '[^a-z0-9]+'), lambda w: w <> '')"
    t = f"{1.0 + len(TEMPLATES)}"
    return f"""
WITH templates(template, license, text) AS (VALUES {templates}),
notices(template, license, anchor, before, n) AS (VALUES {notices}),
t_tf AS (SELECT template, license, word, count(*) AS tf
         FROM (SELECT template, license, unnest({words}) AS word FROM templates) GROUP BY ALL),
t_idf AS (SELECT word, ln({t}::DOUBLE / (1 + count(*))) + 1 AS idf FROM t_tf GROUP BY word),
t_norm AS (SELECT template, sqrt(sum(tf * idf * tf * idf)) AS norm FROM t_tf JOIN t_idf USING (word) GROUP BY 1),
vectors AS (SELECT license, template, word, tf * idf / norm AS weight
            FROM t_tf JOIN t_idf USING (word) JOIN t_norm USING (template)),
files AS (SELECT doc_id, concat_ws('/', source, lang, (doc_id // 100)::VARCHAR) AS dir, text FROM documents),
marked AS (SELECT doc_id, w FROM (SELECT doc_id, {words} AS w FROM files) WHERE list_has_any(w, [{anchors}])),
placed AS (SELECT doc_id, w, unnest(w) AS anchor, generate_subscripts(w, 1) AS pos FROM marked),
near AS (SELECT doc_id, pos, template, unnest(w[greatest(pos - before, 1):pos - before + n - 1]) AS word
         FROM placed JOIN notices USING (anchor)),
near_tf AS (SELECT doc_id, pos, template, word, count(*) AS tf FROM near GROUP BY ALL),
near_w AS (SELECT doc_id, pos, template, word, tf * coalesce(idf, ln({t}::DOUBLE) + 1) AS w
           FROM near_tf LEFT JOIN t_idf USING (word)),
in_windows AS (SELECT doc_id, false AS whole, template,
                      round(coalesce(sum(w * weight), 0) / sqrt(sum(w * w)), 6) AS cosine
               FROM near_w LEFT JOIN vectors USING (template, word) GROUP BY doc_id, pos, template),
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM marked) GROUP BY ALL),
weighed AS (SELECT doc_id, word, tf * coalesce(idf, ln({t}::DOUBLE) + 1) AS w FROM tf LEFT JOIN t_idf USING (word)),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
dots AS (SELECT doc_id, template, sum(w * weight) AS dot FROM weighed JOIN vectors USING (word) GROUP BY ALL),
in_whole AS (SELECT doc_id, true AS whole, template, round(dot / norm, 6) AS cosine FROM dots JOIN norms USING (doc_id)),
scored AS (SELECT doc_id, whole, license, cosine
           FROM (SELECT * FROM in_windows UNION ALL SELECT * FROM in_whole) JOIN (SELECT template, license FROM templates) USING (template)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, whole ORDER BY cosine DESC, license) AS k
                        FROM scored) WHERE k = 1),
passed AS (SELECT doc_id, whole, license, cosine FROM best
           WHERE (whole AND cosine >= {FILE_MIN}) OR (NOT whole AND cosine >= {HEADER_MIN})),
own AS (SELECT doc_id, bool_or(whole) AS is_file, arg_min(license, (-cosine, license)) AS license,
               max(cosine) AS cosine FROM passed GROUP BY 1),
by_dir AS (SELECT dir AS from_dir, arg_min(license, (-cosine, license, concat_ws('/', dir, doc_id))) AS license
           FROM passed JOIN files USING (doc_id) WHERE whole GROUP BY 1),
dirs AS (SELECT DISTINCT dir FROM files),
nearest AS (SELECT dir, from_dir, license AS near_license
            FROM dirs JOIN by_dir ON from_dir = '' OR dir = from_dir OR starts_with(dir, from_dir || '/')
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY len(from_dir) DESC) = 1)
SELECT doc_id, coalesce(license, near_license) AS license,
       CASE WHEN is_file THEN 'file' WHEN license IS NOT NULL THEN 'header'
            WHEN near_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       cosine, CASE WHEN license IS NULL THEN from_dir END AS from_dir
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN nearest USING (dir)
"""


def _op10() -> str:
    words = (
        "list_filter(string_split_regex("
        + _LOWER.format("text")
        + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    )
    return f"""
WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2),
                 lambda i: array_to_string(w[i:i + size - 1], ' '))) AS gram
          FROM (SELECT item_id, w, least(len(w), 13) AS size FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
places AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
                  unnest(list_transform(range(1, len(w) - size + 2),
                         lambda i: array_to_string(w[i:i + size - 1], ' '))) AS gram
           FROM docs, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size),
hits AS (SELECT doc_id, item_id, pos, size FROM places JOIN grams USING (size, gram)),
per_doc AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY 1),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
             FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_item USING (doc_id)
"""


SQL: dict[str, str] = {"op3_licenses": _op3(), "op10_decontamination": _op10()}
