"""DuckDB SQL for the Merkle manifest and the source divergence audit."""

from __future__ import annotations

from .words import UPPER

_LOWER = f"'{UPPER}', '{UPPER.lower()}'"

_LEVELS, _TOP = 13, 5  # enough for 1.5 million rows a source, 243 sources


def _nodes(prefix: str, start: str, levels: int) -> str:
    """Nodes {prefix}0, {prefix}1, ... and the siblings {prefix}s0, ... of each level."""
    out = [f"{prefix}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(
            f"""
{prefix}s{k} AS MATERIALIZED (
  SELECT g, r, cnt > 1 AS hashed,
    coalesce(string_agg(node, '') OVER (PARTITION BY g, r // 3 ORDER BY r
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (PARTITION BY g, r // 3 ORDER BY r
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS h
  FROM {prefix}{k}
), {prefix}{k + 1} AS MATERIALIZED (
  SELECT g, r // 3 AS r, (min(cnt) + 2) // 3 AS cnt,
    CASE WHEN min(cnt) > 1 THEN sha256(string_agg(node, '' ORDER BY r)) ELSE min(node) END AS node
  FROM {prefix}{k} GROUP BY g, r // 3
)"""
        )
    return ",".join(out)


def _steps(prefix: str, group: str, place: str, levels: int, first: int) -> str:
    """Steps f{first + 1}, ...: proofs and folded nodes taken up level by level."""
    return ",".join(
        f"""
f{first + k + 1} AS (
  SELECT f.* REPLACE (
    CASE WHEN s.hashed THEN proof || s.l || s.h ELSE proof END AS proof,
    CASE WHEN s.hashed THEN sha256(s.l || fold || s.h) ELSE fold END AS fold)
  FROM f{first + k} f JOIN {prefix}s{k} s ON s.g = {group} AND s.r = f.{place} // {3**k}
)"""
        for k in range(levels)
    )


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = [f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


# The lowest bit of CRC-32, folded over the bytes of the id, eight steps each.
_EVEN = """doc_id IS NOT NULL AND coalesce((list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: [CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))) & 1) = 1, false)"""

OP11 = f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS src,
    {_leaf("text")} AS leaf,
    CASE WHEN {_EVEN} THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS now
  FROM documents
), ranked AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY src) - 1 AS g, count(*) OVER (PARTITION BY src) AS cnt,
    row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
  FROM leaves
), {_nodes("a", "SELECT g, r, cnt, leaf AS node FROM ranked", _LEVELS)},
{_nodes("b", f"SELECT 0 AS g, g AS r, count(*) OVER () AS cnt, node FROM a{_LEVELS}", _TOP)},
f0 AS (SELECT *, '' AS proof, now AS fold FROM ranked),
{_steps("a", "f.g", "r", _LEVELS, 0)},
{_steps("b", "0", "g", _TOP, _LEVELS)}
SELECT doc_id, leaf, s.node AS subroot, t.node AS root, sha256(proof) AS proof_sha256,
  fold AS folded_root, fold = t.node AS verified
FROM f{_LEVELS + _TOP} f
JOIN a{_LEVELS} s ON f.g = s.g CROSS JOIN b{_TOP} t
"""

_SHARE = "1 + (CAST(1000000000 AS HUGEINT) * ({n} + 2)) // ({size} + 2 * v)"
_DIFF = "((({p}) - ({q})) * (({p}) - ({q}))) // (({p}) + ({q}))"

OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), {_LOWER}) AS text FROM documents
), t AS MATERIALIZED (
  SELECT id, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM (SELECT DISTINCT lang, id, term FROM t)
  GROUP BY lang, term HAVING count(*) >= 10
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), g AS (
  SELECT g.lang, g.source, coalesce(n, 0) AS size, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY ALL) USING (lang)
), whole AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {_SHARE.format(n="coalesce(c.n, 0)", size="size")} AS p,
    {_SHARE.format(n="sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term)",
                   size="(SELECT sum(h.size) FROM g h WHERE h.lang = g.lang)")} AS q
  FROM g JOIN kept k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum({_DIFF.format(p="a.p", q="b.p")}) AS value
  FROM whole a JOIN whole b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST({_DIFF.format(p="p", q="q")} AS BIGINT)
  FROM whole WHERE n > 0 AND p > q
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)
    AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM placed WHERE part = 'pair' OR rank <= 10
"""
