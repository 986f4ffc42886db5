"""The SQL of op12: damage, faults and repair of all conversations at once; grammar and edits are written out as rules."""

SQL = r"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), bits AS MATERIALIZED (
  -- CRC-32 of the key, bit by bit: eight steps for each of its bytes
  SELECT key, 0 AS i, 4294967295::BIGINT AS crc FROM (SELECT DISTINCT key FROM kinds)
  UNION ALL
  SELECT key, i + 1, (SELECT CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    FROM (SELECT CASE WHEN i % 8 = 0 THEN xor(crc, ord(substr(key, i // 8 + 1, 1))) ELSE crc END AS c)) FROM bits WHERE i < 8 * strlen(key)
), crc AS (SELECT key, xor(crc, 4294967295) % 20 AS kind FROM bits WHERE i = 8 * strlen(key)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds JOIN crc USING (key)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), faults AS (
  SELECT conv_id, pos, turn, role, text, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM faults) GROUP BY conv_id
), grammar AS (
  SELECT * FROM (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')) g(state, initial, after)
), walk AS (
  -- one step is one insertion (phase 0 to 2 before each turn) or one turn; a state is the last initial of the repaired roles
  SELECT c.conv_id, 0::BIGINT AS pos, 0 AS phase, '' AS state, {'cost': 0::BIGINT, 'audit': ''} AS best FROM counts c
  UNION ALL
  SELECT conv_id, pos, phase, state, min(best) FROM (
    SELECT w.conv_id, w.pos, w.phase + 1 AS phase, w.state, w.best FROM walk w WHERE w.phase < 2
    UNION ALL
    SELECT w.conv_id, w.pos, w.phase + 1, g.after, {'cost': w.best.cost + 5, 'audit': w.best.audit || 'I'}
    FROM walk w JOIN grammar g ON g.state = w.state AND g.initial <> 's' WHERE w.phase < 2
    UNION ALL
    SELECT w.conv_id, f.pos, 0, w.state, {'cost': w.best.cost + 2, 'audit': w.best.audit || 'D'}
    FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1 WHERE w.phase = 2
    UNION ALL
    SELECT w.conv_id, f.pos, 0, g.after, {'cost': w.best.cost + CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'audit': w.best.audit || 'K'}
    FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1 JOIN grammar g ON g.state = w.state AND g.initial = f.initial
    WHERE w.phase = 2 AND f.fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT w.conv_id, f.pos, 0, g.after, {'cost': w.best.cost + 1 + CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'audit': w.best.audit || 'R'}
    FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1 JOIN grammar g ON g.state = w.state AND g.initial <> 's'
    WHERE w.phase = 2 AND f.fault NOT IN ('blank', 'duplicate')
  ) GROUP BY conv_id, pos, phase, state
), repaired AS (
  SELECT c.conv_id, min(w.best) AS best FROM counts c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.pos = c.n AND w.phase = 2
  WHERE w.state IN ('', 'a') GROUP BY c.conv_id
), letters AS (
  SELECT conv_id, i, substr(best.audit, i, 1) AS letter, i - length(replace(left(best.audit, i), 'I', '')) AS inserted
  FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS i FROM repaired)
), kept AS (
  -- the place among the repaired turns gives the role: user and assistant take turns behind a kept system turn
  SELECT l.conv_id, l.i, l.letter, f.role, f.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) AS place,
    first_value(l.letter = 'K' AND f.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY l.i) AS opened
  FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.i - l.inserted AND l.letter <> 'I' WHERE l.letter <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place + opened::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS lines
  FROM kept GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(r.best.cost, 0)::BIGINT AS cost,
  coalesce(r.best.audit, '') AS audit, sha256(coalesce(t.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""
