"""DuckDB SQL for the text-corpus queries that SQL can express, written independently of them."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shard_sql(limit_bytes: int) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
p AS (SELECT d.*, k AS depth, (h >> (60 - k)::INTEGER)::BIGINT AS prefix FROM d, range(0, 61) r(k)),
b AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM p GROUP BY ALL),
f AS (
  SELECT p.doc_id, p.n_bytes, p.depth, p.prefix, b.shard_bytes,
         row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) AS place
  FROM p JOIN b USING (depth, prefix) WHERE b.shard_bytes <= {limit_bytes} OR b.n = 1)
SELECT doc_id, n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
       depth::INTEGER AS shard_depth, shard_bytes
FROM f WHERE place = 1"""


LINES = f"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      '{UPPER}', '{LOWER}') AS key
  FROM l),
c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, pos, line, c.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

MIXING = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM d GROUP BY source),
fill(round, source, source_size, weight, clamped, level) AS (
  SELECT 0, source, source_size, weight, false,
         sum(source_size) OVER ()::DOUBLE / sum(weight) OVER () FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight, full_now,
         (sum(source_size) OVER () - sum(CASE WHEN full_now THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
           / nullif(sum(CASE WHEN full_now THEN 0 ELSE weight END) OVER (), 0)
  FROM (SELECT *, clamped OR weight * level > 3 * source_size AS full_now,
               bool_or(NOT clamped AND weight * level > 3 * source_size) OVER () AS again FROM fill)
  WHERE again),
t AS (
  SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target
  FROM fill WHERE round = (SELECT max(round) FROM fill)),
g AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT // source_size END AS whole,
         floor(target + 0.5)::BIGINT AS goal FROM t),
u AS (SELECT source, h, sum(size)::BIGINT AS unit FROM d GROUP BY source, h),
c AS (
  SELECT source, h, unit, coalesce(sum(unit) OVER (PARTITION BY source ORDER BY h
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM u)
SELECT d.doc_id, d.size, g.source_size, g.target,
       (whole * d.size + CASE WHEN unit = 0 THEN 0 ELSE
         d.size * greatest(0, least(unit, goal - whole * g.source_size - before)) // unit END)::BIGINT AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h"""

EXACT = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
w AS (
  SELECT *, CASE role WHEN 'system' THEN 20 WHEN 'user' THEN 18 WHEN 'assistant' THEN 23
              ELSE 19 + length(role) END  -- marks round the text: open, name, name end, close, line end
         + length(text) + length(text) - length(replace(text, '\', ''))
         + (length(text) - length(replace(text, '### ', ''))) // 4
         + (length(text) - length(replace(text, '</turn>', ''))) // 7
         + (length(text) - length(replace(text, ': ', ''))) // 2 AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id"""

# crc32 bit by bit; a path is the list of its turns' numbers, compared whole.
TRIE = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE "C" NULLS FIRST, text COLLATE "C" NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, list(k ORDER BY pos) AS own
  FROM (SELECT conv_id, pos, dense_rank() OVER (ORDER BY role COLLATE "C", text COLLATE "C") AS k FROM t) GROUP BY conv_id),
h AS (
  SELECT conv_id, own,
         (xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1),
           lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
           lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4)::INTEGER AS n_head
  FROM o),
r AS (
  SELECT h.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, h.n_head), list_slice(h.own, h.n_head + 1, length(h.own))) AS path
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
w AS (
  SELECT k, any_value(words) AS words
  FROM (SELECT dense_rank() OVER (ORDER BY role COLLATE "C", text COLLATE "C") AS k,
               len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t) GROUP BY k),
m AS (SELECT conv_id, path, d AS depth, list_slice(path, 1, d) AS node FROM r, unnest(range(0, length(path) + 1)) u(d)),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length(path) = depth), '')) AS ends_sha256
  FROM m GROUP BY node, depth),
v AS (
  SELECT n.*, coalesce((n_convs - 1) * words, 0) AS saved,
         (SELECT count(*) FROM n c WHERE c.depth = n.depth + 1 AND list_slice(c.node, 1, n.depth) = n.node) AS n_children
  FROM n LEFT JOIN w ON w.k = n.node[n.depth]),
s AS (
  SELECT list_slice(node, 1, d) AS node, sum((n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM v, unnest(range(0, depth + 1)) u(d) GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s ON s.node = v.node LEFT JOIN n p ON p.depth = v.depth - 1 AND p.node = list_slice(v.node, 1, v.depth - 1)"""

FILL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
n AS (
  SELECT doc_id, text, u, length(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (length(u) + 1) AS a,
         ('0x' || substr(h, 9, 8))::BIGINT % (length(u) + 1) AS b, ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 AS e FROM d),
f AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 50
                               THEN 'plain' WHEN e < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(u, 1, least(a, b)), '') AS pre,
         array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') AS mid,
         array_to_string(list_slice(u, greatest(a, b) + 1, n), '') AS suf FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f"""

ORACLES = {
    "op1_extendible_sharding": shard_sql(64 << 20),
    "op2_line_dedup": LINES,
    "op4_source_mixing": MIXING,
    "op8_exact_dedup": EXACT,
    "op9_chat_format": CHAT,
    "op11_prefix_trie": TRIE,
    "op13_fill_in_middle": FILL,
}
