"""SQL for the text queries that SQL can express, each over the whole tables."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, MIN(r.y) AS component_id, COUNT(*) AS component_size
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.s)
"""


def _matches(pattern: str, rank: int, kind: str, value: str = "h") -> str:
    """(doc_id, source, start, stop, rank, kind, value) of a pattern's matches: lengths of what lies between add up."""
    return f"""
  SELECT doc_id, source, list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS start_,
    list_sum(list_transform(p[1:i], lambda x: len(x))) + list_sum(list_transform(m[1:i], lambda x: len(x))) AS stop_, {rank} AS rank, '{kind}' AS kind, {value} AS value
  FROM (SELECT doc_id, source, p, m, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS h FROM (
    SELECT doc_id, source, string_split_regex(coalesce(text, ''), '{pattern}') AS p, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m FROM documents))"""


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
PROVIDER = (
    r"gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----|://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~-]{1,64}@"
)
VALUE = r"""regexp_extract(h, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)"""

OP3 = f"""
WITH spans AS (
  SELECT * FROM ({_matches(ASSIGN, 0, "assign", VALUE)}) WHERE len(value) >= 6
  UNION ALL {_matches("AKIA[A-Z0-9]{16,}", 1, "access")}
  UNION ALL {_matches("[0-9a-f]{24,}", 2, "hex")}
  UNION ALL {_matches(PROVIDER, 3, "provider")}
),
owners AS (SELECT value, COUNT(DISTINCT coalesce(source, '?')) AS n FROM spans GROUP BY value),
judged AS (
  SELECT s.*, CASE WHEN n >= 3 OR regexp_matches(lower(value), 'example|changeme|dummy|sample|placeholder|your_|xxxx|123456|test')
      OR len(list_distinct(string_split(value, ''))) <= 3 THEN 'example'
    WHEN n = 1 AND (kind = 'provider' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(value) >= 12)) THEN 'live'
    ELSE 'unclear' END AS verdict
  FROM spans s JOIN owners USING (value)
)
SELECT d.doc_id, COUNT(*) FILTER (kind = 'assign') AS n_assign, COUNT(*) FILTER (kind = 'access') AS n_access, COUNT(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(concat_ws(':', kind, start_, stop_), ',' ORDER BY start_, rank) FILTER (kind <> 'provider'), '')) AS base_sha256,
  coalesce(string_agg(concat_ws(':', kind, start_, stop_), ',' ORDER BY start_, rank), '') AS spans,
  COUNT(*) FILTER (verdict = 'live') AS n_live, COUNT(*) FILTER (verdict = 'example') AS n_example
FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id
"""


OP13 = r"""
WITH tokens AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
places AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::UBIGINT % (len(u) + 1) AS a,
    ('0x' || substr(h, 9, 8))::UBIGINT % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || substr(h, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM tokens),
sections AS (
  SELECT doc_id, text, n::BIGINT AS n, form, array_to_string(u[1:least(a, b)::BIGINT], '') AS p,
    array_to_string(u[least(a, b)::BIGINT + 1:greatest(a, b)::BIGINT], '') AS m,
    array_to_string(u[greatest(a, b)::BIGINT + 1:], '') AS s
  FROM places)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM sections
"""
