"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS at,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT source, line
  FROM (SELECT DISTINCT doc_id, source, trim(line) AS line FROM lines) JOIN pages USING (source)
  WHERE line <> ''
  GROUP BY source, line, pages
  HAVING count(*) >= 5 AND count(*) / pages > 0.1::DOUBLE
), kept AS (
  SELECT l.doc_id, l.source, count(*) AS n_lines, count(*) FILTER (b.line IS NOT NULL) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.at) FILTER (b.line IS NULL), '') AS kept_text
  FROM lines l LEFT JOIN bad b ON b.source = l.source AND b.line = trim(l.line)
  GROUP BY ALL
)
SELECT doc_id, source, n_lines, n_removed, kept_text FROM kept
UNION ALL
SELECT doc_id, source, 0, 0, NULL FROM documents WHERE text IS NULL
"""

ORACLE["op9_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r(h, p, v)
), canon AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)$', '') AS canonical
  FROM split
), spam AS (
  SELECT DISTINCT canonical FROM canon
  WHERE regexp_matches(host, '(^|[.-])(spam|pills?|casinos?|viagra|porn|xxx|loans|bets?|betting)([.-]|$)')
), fit AS (
  SELECT page_id, arg_max(struct_pack(r := h || p, v := v), length(h || p)) AS best
  FROM canon JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, best.r AS rule,
       coalesce(best.v, CASE WHEN canonical <> '' AND canonical IN (SELECT canonical FROM spam) THEN 'block' ELSE 'allow' END) AS verdict
FROM canon LEFT JOIN fit USING (page_id)
"""

_TEMPLATES = """
  ('released under the mit license', 'mit'),
  ('permission is hereby granted free of charge to any person obtaining a copy of this software', 'mit'),
  ('licensed under the apache license version 2 0', 'apache'),
  ('this work is licensed under the gnu general public license version 3', 'gpl'),
  ('gnu lesser general public license version 3', 'lgpl'),
  ('licensed under cc by nc 4 0', 'cc-by-nc'),
  ('licensed under cc by sa 4 0', 'cc-by-sa'),
  ('this work is licensed under a creative commons attribution 4 0 international license', 'cc-by'),
  ('redistribution and use in source and binary forms with or without modification are permitted', 'bsd'),
  ('subject to the terms of the mozilla public license v 2 0', 'mpl'),
  ('all rights reserved', 'reserved')
"""

ORACLE["op10_license_scan"] = rf"""
WITH body AS (
  SELECT doc_id, coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS t
  FROM documents
), ws AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM body
), phrases AS (SELECT * FROM (VALUES ('mit license', 'mit'), ('apache license', 'apache'),
                                     ('general public license', 'gpl')) AS p(phrase, label)),
starts AS (
  SELECT doc_id, w, unnest(range(len(w))) AS pos FROM ws WHERE list_contains(w, 'license')
), places AS (
  SELECT doc_id, pos, label FROM starts, phrases
  WHERE array_to_string(w[pos + 1 : pos + len(string_split(phrase, ' '))], ' ') = phrase
), base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id
), templates AS (SELECT string_split(t, ' ') AS tw, label FROM (VALUES {_TEMPLATES}) AS x(t, label)),
blocks AS (
  SELECT doc_id, list_distinct(regexp_split_to_array(line, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS held
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM body)
), met AS (
  SELECT doc_id, label,
         len(list_intersect(held, tw)) / len(list_distinct(tw)) AS containment
  FROM blocks, templates
  WHERE len(list_intersect(held, tw)) >= 0.8::DOUBLE * len(list_distinct(tw)) - 1e-9
), runs AS (
  SELECT doc_id, label, tw, unnest(range(len(w))) AS pos, w, len(tw) AS n
  FROM ws, templates
  WHERE contains(t, chr(10)) AND len(list_intersect(w, tw)) >= 0.8::DOUBLE * len(list_distinct(tw)) - 1e-9
), met_runs AS (
  SELECT doc_id, label, len(list_intersect(list_distinct(w[pos + 1 : pos + n]), tw)) / len(list_distinct(tw)) AS containment
  FROM runs WHERE list_contains(tw, w[pos + 1])
), met_all AS (
  SELECT * FROM met UNION ALL SELECT * FROM met_runs WHERE containment >= 0.8::DOUBLE - 1e-9
), method AS (SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS containment FROM met_all GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, method.labels))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0) END::DOUBLE AS score
FROM ws LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""

# DuckDB has no CRC-32: a table of 256 values, then one look-up a digit of the id.
ORACLE["op13_merkle_manifest"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]::BIGINT[]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) AS r(i)
), docs AS (
  SELECT row_number() OVER () AS rid, *,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS id_crc
  FROM documents, crc_table
), hashed AS (
  SELECT rid, doc_id, source, head,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS tampered
  FROM (
    SELECT rid, doc_id, source, text,
           CASE WHEN id_crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
    FROM docs)
), ranked AS (
  SELECT rid, doc_id, leaf, tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS rank,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), nodes(level, grp, idx, n, digest) AS (
  SELECT 0, grp, rank, n, leaf FROM ranked
  UNION ALL
  SELECT level + 1, grp, idx // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY level, grp, idx // 3
), subs AS (SELECT level AS depth, grp, digest FROM nodes WHERE n = 1),
upper(level, idx, n, digest) AS (
  SELECT 0, grp, (SELECT count(*) FROM subs), digest FROM subs
  UNION ALL
  SELECT level + 1, idx // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM upper WHERE n > 1 GROUP BY level, idx // 3
), top AS (SELECT level AS height, digest AS root FROM upper WHERE n = 1),
steps AS (
  SELECT l.rid, k.level AS level, (l.rank // (3 ** k.level)::BIGINT) AS own, s.idx, s.digest
  FROM ranked l JOIN subs d USING (grp), range(40) AS k(level), nodes s
  WHERE k.level < d.depth AND s.level = k.level AND s.grp = l.grp
    AND s.idx // 3 = (l.rank // (3 ** (k.level + 1))::BIGINT)
  UNION ALL
  SELECT l.rid, d.depth + k.level, (l.grp // (3 ** k.level)::BIGINT), s.idx, s.digest
  FROM ranked l JOIN subs d USING (grp), top t, range(40) AS k(level), upper s
  WHERE k.level < t.height AND s.level = k.level AND s.idx // 3 = (l.grp // (3 ** (k.level + 1))::BIGINT)
), sides AS (
  SELECT rid, level, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS l,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS r
  FROM steps GROUP BY rid, level
), proofs AS (
  SELECT rid, list({'l': l, 'r': r} ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS proof FROM sides GROUP BY rid
), folds(rid, step, cur, path) AS (
  SELECT rid, 1, tampered, path FROM ranked LEFT JOIN proofs USING (rid)
  UNION ALL
  SELECT rid, step + 1, sha256(path[step].l || cur || path[step].r), path FROM folds WHERE step <= len(path)
)
SELECT k.doc_id, k.leaf, d.digest AS subroot, t.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.cur AS folded_root, f.cur = t.root AS verified
FROM ranked k JOIN subs d USING (grp) LEFT JOIN proofs p USING (rid), top t, folds f
WHERE f.rid = k.rid AND f.step = coalesce(len(f.path), 0) + 1
"""
