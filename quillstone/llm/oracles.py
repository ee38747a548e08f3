"""DuckDB SQL for the llm queries that SQL can express."""

OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '</turn>', '\t'), '### ', '\h') AS escaped,
    replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\t'), '### ', '\h'), ': ', '\c') AS role_escaped
  FROM rows
), conflicts AS (
  SELECT *, bool_or(contains(text, '</turn>') OR contains(text, '### ') OR contains(text, '\b') OR contains(text, '\t') OR contains(text, '\h')) OVER (PARTITION BY conv_id) AS conflict
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role_escaped) + length(CASE WHEN conflict THEN escaped ELSE text END)) AS BIGINT) AS formatted_chars,
  bool_or(conflict) AS escaped
FROM conflicts GROUP BY conv_id
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents
), g AS (
  SELECT plain, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM d GROUP BY plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM d JOIN g USING (plain)
"""

ORACLES = {"op1_chat_format": OP1, "op6_exact": OP6}
