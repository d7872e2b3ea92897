"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

#: The template adds 16 characters a turn (markers and line feeds), and one for each escaped character.
OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace(replace(replace(role, '\', '\e'), '<', '\l'), chr(10), '\n'))
           + length(replace(replace(text, '\', '\e'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(w) AS x, generate_subscripts(w, 1) AS d, len(w) AS n FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM e q JOIN e c ON q.d = c.d AND q.n = c.n AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

#: Texts as hexadecimal strings: every window of 200 bytes is 400 characters from an odd place on.
OP11 = """
WITH b AS (
  SELECT row_number() OVER () AS uid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (  -- the windows that start in each 128 bytes
  SELECT uid, j, substr(x, CAST(256 * j + 1 AS BIGINT), 256 + 398) AS y
  FROM (SELECT uid, x, unnest(generate_series(0, (CAST(length(x) AS BIGINT) // 2 - 200) // 128)) AS j FROM b WHERE length(x) >= 400)),
w AS (
  SELECT uid, 128 * j + i AS i, md5(substr(y, CAST(2 * i + 1 AS BIGINT), 400)) AS window_hash
  FROM (SELECT uid, j, y, unnest(generate_series(0, least(127, CAST(length(y) AS BIGINT) // 2 - 200))) AS i FROM c)),
twice AS (SELECT window_hash FROM w GROUP BY window_hash HAVING count(*) > 1),
gone AS (SELECT uid, i, lag(i) OVER (PARTITION BY uid ORDER BY i) AS before FROM w JOIN twice USING (window_hash)),
marked AS (
  SELECT uid, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY uid ORDER BY i) AS run FROM gone),
spans AS (SELECT uid, run, min(i) AS a, max(i) + 200 AS e FROM marked GROUP BY uid, run),
sums AS (SELECT uid, CAST(sum(e - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY uid),
edges AS (
  SELECT uid, coalesce(lag(e) OVER (PARTITION BY uid ORDER BY a), 0) AS kept_from, a AS kept_to FROM spans
  UNION ALL SELECT b.uid, coalesce(max(e), 0), any_value(CAST(length(x) AS BIGINT) // 2) FROM b LEFT JOIN spans USING (uid) GROUP BY b.uid),
k AS (
  SELECT uid, string_agg(substr(x, CAST(2 * kept_from + 1 AS BIGINT), CAST(2 * (kept_to - kept_from) AS BIGINT)), '' ORDER BY kept_from) AS kept
  FROM edges JOIN b USING (uid) GROUP BY uid)
SELECT doc_id, CAST(length(x) AS BIGINT) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(kept)) AS kept_sha256
FROM b JOIN k USING (uid) LEFT JOIN sums USING (uid)
"""

#: Conversations as lists of turns; a prefix is known by the MD5 of its turns. DuckDB has no crc32, so ``h`` spells it out.
OP13 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(unicode(s) AS BIGINT)),
      lambda crc, b: list_reduce([1, 1, 1, 1, 1, 1, 1, 1], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, b)),
      4294967295)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, b.pos, b.role, b.text FROM c JOIN t b ON b.conv_id = c.base AND b.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t USING (conv_id) WHERE t.pos >= c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
    md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY node, depth),
u AS (
  SELECT n.*, q.node AS parent FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1),
k AS (SELECT parent, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT q.node, CAST(sum(CASE WHEN k.parent IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum((u.n_convs - 1) * u.chars) AS BIGINT) AS saved_tokens
  FROM u JOIN p q ON q.conv_id = u.conv_id AND q.depth <= u.depth LEFT JOIN k ON k.parent = u.node GROUP BY q.node),
e AS (
  SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node)
SELECT u.conv_id, u.depth, v.conv_id AS parent_conv_id, u.n_convs, coalesce(k.n_children, 0) AS n_children,
  below.n_leaves, below.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM u LEFT JOIN n v ON v.node = u.parent LEFT JOIN k ON k.parent = u.node JOIN below ON below.node = u.node LEFT JOIN e ON e.node = u.node
"""

ORACLE_SQL: dict[str, str] = {"op3_chat_formatting": OP3, "op6_exact_top_k": OP6, "op11_suffix_array_dedup": OP11, "op13_conversation_prefix_trie": OP13}
