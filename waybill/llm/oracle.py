"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from . import audit_sql
from .words import UPPER

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"
_ENDS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = f"'{UPPER}', '{UPPER.lower()}'"

# The three schedules by class: weight at the start, its square, twice the slope, the integral.
OP5 = f"""
WITH d AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS cls
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE cls WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
         source_size * 3 AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) AS whole
  FROM s
), l AS (
  SELECT *, (whole - coalesce(sum(cap) OVER (
               ORDER BY cap / weight, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (
               ORDER BY cap / weight, source IS NULL, source
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), o AS (
  SELECT level AS open_level FROM l WHERE cap > level * weight
  ORDER BY cap / weight, source IS NULL, source LIMIT 1
), t AS (
  SELECT source, source_size, cls, weight,
         coalesce(least(CAST(cap AS DOUBLE), (SELECT open_level FROM o) * weight),
                  CAST(cap AS DOUBLE)) AS target
  FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.cls,
         CAST(round(t.target) AS BIGINT) AS most,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY ord, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE cls WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS area,
         CASE cls WHEN 0 THEN 6e0 WHEN 1 THEN 15e-1 ELSE 5e-1 END AS w0,
         CASE cls WHEN 0 THEN -4e0 ELSE 2e0 END AS slope2,
         greatest(least(size, most - place), 0)
         + greatest(least(size, most - (place + source_size)), 0)
         + greatest(least(size, most - (place + 2 * source_size)), 0) AS taken
  FROM p
), u AS (
  SELECT *, CAST(place AS DOUBLE) / greatest(target, 1e0) * area AS need FROM q
), v AS (
  SELECT *, CASE WHEN need >= area THEN 1e0 WHEN need <= 0 THEN 0e0
    ELSE least(2e0 * need / (w0 + sqrt(greatest(w0 * w0 + slope2 * need, 0e0))), 1e0) END AS due
  FROM u
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN least(size, most - place) > 0 THEN CAST(floor(due * 1000000) AS BIGINT) END
         AS position_ppm
FROM v
"""

OP6 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), lines AS (
  SELECT r, doc_id, i, lines[i] AS line, translate(trim(lines[i], {_ENDS}), {_LOWER}) AS key
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), common AS (
  SELECT key FROM (SELECT DISTINCT key, doc_id FROM lines WHERE key <> '')
  GROUP BY key HAVING count(*) >= 10
), kept AS (
  SELECT r, count(*) AS n_lines, count(c.key) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '') AS text
  FROM lines l LEFT JOIN common c ON l.key = c.key GROUP BY r
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped,
       sha256(kept.text) AS kept_sha256
FROM kept JOIN docs USING (r)
"""


_MARKS = r"</?s>|\[/?(?:INST|SYS|ROLE)\]|\[TEXT\]"
_PLAIN = r"[\\\[<]"


def _escapes(text: str) -> str:
    """Characters that escaping adds to a text: none, one per mark, or one per special."""
    return f"""CASE level WHEN 0 THEN 0 WHEN 1 THEN len(regexp_extract_all({text}, '{_MARKS}'))
             ELSE len(regexp_extract_all({text}, '{_PLAIN}')) END"""


OP1 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), own AS (
  SELECT *, role NOT IN ('user', 'assistant', 'system') AS other FROM turns
), levels AS (
  SELECT *, CASE
    WHEN regexp_matches(text, '\\\\{_PLAIN}') OR (role = 'assistant' AND text LIKE '%\\')
      OR (other AND regexp_matches(role, '\\\\{_PLAIN}')) THEN 2
    WHEN regexp_matches(text, '{_MARKS}') OR (other AND regexp_matches(role, '{_MARKS}')) THEN 1
    ELSE 0 END AS level
  FROM own
), sizes AS (
  SELECT *, length(text) + {_escapes("text")}
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 13
      ELSE 23 + length(role) + {_escapes("role")} END AS chars
  FROM levels
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

_LEVELS = 12  # of segments that may vary; where the tables go deeper, few paths of a host do


def _wildcards() -> str:
    """Tables t1, t2, ...: variable segments of one level after the other become '*'."""
    return ",".join(
        f"""
v{k} AS (
  SELECT host, above FROM (
    SELECT host, template[1:{k}] AS above, template[{k + 1}] AS child, sum(n) AS n
    FROM t{k} WHERE len(template) > {k} GROUP BY ALL)
  GROUP BY host, above HAVING count(*) > 20 AND count(*) * 10 > sum(n)
), t{k + 1} AS (
  SELECT t.host, t.shapes, t.n, t.labelled, t.good,
    CASE WHEN v.host IS NOT NULL AND len(template) > {k}
      THEN list_concat(template[1:{k}], ['*'], template[{k + 2}:]) ELSE template END AS template
  FROM t{k} t LEFT JOIN v{k} v ON t.host = v.host AND t.template[1:{k}] = v.above
)"""
        for k in range(_LEVELS)
    )


OP3 = rf"""
WITH labelled AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality IS NOT NULL
    AND toxic IS NOT NULL OR quality <> 1 OR toxic <> 0 THEN 0 END) AS good
  FROM labels GROUP BY doc_id
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), shaped AS (
  SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x:
      regexp_replace(regexp_replace(x, '(?i)\b[0-9a-f]{{8,}}\b', 'h', 'g'), '[0-9]+', '#', 'g'))
      AS all_shapes,
    try_cast(nullif(regexp_extract(path, '([0-9]+)(?:[.][a-z]+)?/?$', 1), '') AS BIGINT) AS number
  FROM parts
), work AS (
  SELECT page_id, host, path, good, all_shapes AS shapes
  FROM shaped LEFT JOIN labelled ON number = doc_id
), t0 AS (
  SELECT host, shapes, count(*) AS n, count(good) AS labelled, coalesce(sum(good), 0) AS good,
    shapes AS template
  FROM work GROUP BY host, shapes
), {_wildcards()},
ways AS (
  SELECT host, shapes, template[1:d] AS node, labelled, good
  FROM (SELECT *, unnest(range(0, len(template) + 1)) AS d FROM t{_LEVELS})
), nodes AS (
  SELECT host, node, sum(labelled)::BIGINT AS labelled, sum(good)::BIGINT AS good
  FROM ways GROUP BY host, node
), prior AS (
  SELECT coalesce(CASE WHEN sum(labelled) > 0 THEN sum(good)::DOUBLE / sum(labelled) END, 1e0) AS p
  FROM nodes WHERE len(node) = 0
), apart AS (
  SELECT c.host, c.node FROM nodes c
  JOIN (SELECT host, node, labelled, good::DOUBLE / nullif(labelled, 0) AS p FROM nodes) u
    ON c.host = u.host AND c.node[1:len(c.node) - 1] = u.node
  WHERE len(c.node) > 0 AND c.labelled > 0
    AND (c.good - c.labelled * p) * (c.good - c.labelled * p) > 4e0 * c.labelled * p * (1e0 - p)
), deepest AS (
  SELECT w.host, w.shapes, max_by(w.node, len(w.node)) AS node
  FROM ways w LEFT JOIN apart a ON w.host = a.host AND w.node = a.node
  WHERE a.host IS NOT NULL OR len(w.node) = 0 GROUP BY w.host, w.shapes
), judged AS (
  SELECT d.host, d.shapes, d.host || '/' || array_to_string(d.node, '/') AS template,
    (n.good + 10e0 * (SELECT p FROM prior)) / (n.labelled + 10e0) AS purity
  FROM deepest d JOIN nodes n ON d.host = n.host AND d.node = n.node
), ruled AS (
  SELECT page_id, w.host, path, template, purity, CASE
    WHEN (w.host = 'example.com' OR ends_with(w.host, '.example.com'))
      AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (w.host = 'example.net' OR ends_with(w.host, '.example.net'))
      AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (w.host = 'org' OR ends_with(w.host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (w.host = 'net' OR ends_with(w.host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM work w JOIN judged j ON w.host = j.host AND w.shapes = j.shapes
)
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block'
    WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
    WHEN 'org/fr/' THEN 'allow' ELSE CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END END
    AS verdict, template
FROM ruled
"""

OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest
  FROM p
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
              THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": OP1,
        "op3_url_templates": OP3,
        "op4_warc": OP4,
        "op5_mixing": OP5,
        "op6_line_dedup": OP6,
        "op11_merkle": audit_sql.OP11,
        "op12_divergence": audit_sql.OP12,
    }
