"""DuckDB SQL of the operators that SQL can express."""

OP11_WINDOWS = r"""
WITH cut AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT row_no, doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM cut
), held AS (
  SELECT row_no, doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS held FROM starts
), least AS (
  SELECT held, min(doc_id) AS least_id FROM held GROUP BY held
), gone AS (
  SELECT DISTINCT row_no, unnest(range(pos, pos + 13)) AS pos FROM held JOIN least USING (held) WHERE least_id < doc_id
), each_word AS (
  SELECT row_no, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM cut
), kept AS (
  SELECT e.row_no, count(*) AS n_kept, string_agg(e.word, ' ' ORDER BY e.pos) AS kept
  FROM each_word e ANTI JOIN gone g ON e.row_no = g.row_no AND e.pos = g.pos GROUP BY e.row_no
)
SELECT c.doc_id, len(c.words)::BIGINT AS n_words, (len(c.words) - coalesce(k.n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k USING (row_no)
"""

OP12_TRIE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 6 AS h
  FROM turns GROUP BY conv_id
), taken AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) AS before FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
  SELECT c.conv_id, t.pos AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + c.before, t.role, t.text FROM taken c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), marked AS (
  SELECT conv_id, depth, length(text) AS chars, md5(length(role) || ':' || role || text) AS mark FROM rebuilt
), listed AS (
  SELECT conv_id, list(mark ORDER BY depth) AS marks FROM marked GROUP BY conv_id
), whole AS (
  SELECT conv_id, coalesce(marks, []) AS marks FROM convs LEFT JOIN listed USING (conv_id)
), members AS (
  SELECT conv_id, d AS depth, array_to_string(marks[1:d], ',') AS key, array_to_string(marks[1:d - 1], ',') AS above, d = len(marks) AS ends
  FROM (SELECT conv_id, marks, unnest(range(0, len(marks) + 1)) AS d FROM whole)
), sized AS (
  SELECT m.*, coalesce(k.chars, 0) AS chars FROM members m LEFT JOIN marked k USING (conv_id, depth)
), nodes AS (
  SELECT key, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM sized GROUP BY key, depth
), tree AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(c.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND n.above = p.key LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.above = n.key
  GROUP BY ALL
), rolled AS (
  SELECT m.key, m.depth, sum((t.n_children = 0)::INT)::BIGINT AS n_leaves, sum((t.n_convs - 1) * t.chars)::BIGINT AS saved_tokens
  FROM tree t JOIN members m ON m.conv_id = t.conv_id AND m.depth <= t.depth GROUP BY m.key, m.depth
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM tree JOIN rolled USING (key, depth)
"""
