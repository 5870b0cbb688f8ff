"""DuckDB SQL for the queries that SQL can express, over whole tables."""

SQL: dict[str, str] = {}

SQL["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
heavy AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id <> h.last_id AS gone
  FROM keyed k LEFT JOIN heavy h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL["op2_decontaminate"] = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
starts AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos0 FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[pos0:pos0 + n - 1], ' ') AS key FROM starts),
places AS (SELECT d.doc_id, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS pos0
           FROM docs d JOIN (SELECT DISTINCT n FROM windows) l ON len(d.w) >= l.n),
hits AS (SELECT p.doc_id, p.pos0, p.n, k.item
         FROM (SELECT doc_id, pos0, n, array_to_string(w[pos0:pos0 + n - 1], ' ') AS key FROM places) p JOIN windows k USING (n, key)),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
              FROM (SELECT doc_id, unnest(range(pos0, pos0 + n)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

SQL["op11_conversation_trie"] = r"""
WITH own AS (
  SELECT conv_id AS c, list({'role': role, 'text': text} ORDER BY turn ASC NULLS FIRST, key) AS own
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
-- crc32 of the decimal id, bit by bit: each byte enters before the first of its eight steps
crc AS (
  SELECT c, own, CAST(xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
                       lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295) % 9 AS BIGINT) AS h
  FROM own),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.own[1:a.h], a.own[1:0]), a.own[a.h + 1:]) AS s
  FROM crc a LEFT JOIN own b ON b.c = a.c - a.c % 5),
members AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(s) = d), '') AS ends
  FROM members GROUP BY s[1:d], d),
sized AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(p[d].text)) END AS saved FROM nodes),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT s.*, coalesce(k.n, 0) AS n_children FROM sized s LEFT JOIN children k ON k.d = s.d AND k.p = s.p),
subtrees AS (
  SELECT p[1:a] AS p, a AS d, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY p[1:a], a)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(n.n_children AS BIGINT) AS n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN subtrees t ON t.d = n.d AND t.p = n.p
LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1] AND n.d > 0
"""
