"""Check SQL of the filter audit, the conversation repair and the mix, for DuckDB."""

FILTER_AUDIT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
b AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, {
    'A': len(w) < 200,
    'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)} AS f
  FROM t LEFT JOIN labels USING (doc_id)
),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
s AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
c AS (SELECT part, good, toxic, f, count(*) AS n FROM b GROUP BY ALL),
m AS (
  SELECT part, good, toxic, n, o, step, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x:
    CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails
  FROM c, s
),
k AS (
  SELECT *, list_contains(fails, o[step]) AS here, list_has_any(fails, o[:step - 1]) AS gone FROM m
),
r AS (
  SELECT part, array_to_string(o, '') AS filter_order, CAST(step AS INTEGER) AS step, o[step] AS letter,
    sum(CASE WHEN NOT here AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN here AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN here AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN here AND len(fails) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN here AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN here AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM k GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""

CHAT_REPAIR_SQL = r"""
WITH RECURSIVE n AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name
  FROM conversations
),
c AS (
  -- CRC-32 of the name, bit by bit
  SELECT *, xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda s, b: list_reduce(
      list_concat([xor(s, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  ), 4294967295) % 20 AS kind
  FROM n
),
g AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM c
),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM g
),
f AS (
  SELECT *, left(role, 1) AS initial, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous
  FROM o
),
-- what an edit makes of the end of the repaired initials: 0 nothing, 1 s, 2 u, 3 pairs
m(top, after, edit, price, initial) AS (VALUES
  (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (3, 2, 'K', 0, 'u'),
  (0, 2, 'R', 3, ''), (1, 2, 'R', 3, ''), (2, 3, 'R', 3, ''), (3, 2, 'R', 3, ''),
  (0, 0, 'D', 4, ''), (1, 1, 'D', 4, ''), (2, 2, 'D', 4, ''), (3, 3, 'D', 4, '')
),
-- turns inserted after an edit
i(top, after, more, added) AS (VALUES
  (0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 1, '', []),
  (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']), (2, 2, '', []), (2, 3, 'I', ['assistant:']),
  (3, 3, '', []), (3, 2, 'I', ['user:'])
),
r AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, after AS top, CAST(3 * len(more) AS BIGINT) AS cost,
    CAST(more AS VARCHAR) AS audit, added AS told
  FROM conversations, i WHERE top = 0
  UNION ALL
  SELECT conv_id, pos, top, min(cost), arg_min(audit, key), arg_min(told, key) FROM (
    SELECT *, printf('%012d', cost) || audit AS key FROM (
      SELECT f.conv_id, f.pos, i.after AS top,
        r.cost + m.price + 3 * len(i.more) + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 3 ELSE 0 END AS cost,
        r.audit || edit || i.more AS audit,
        list_concat(r.told, CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE
          [CASE m.top WHEN 2 THEN 'assistant:' ELSE 'user:' END || text] END, i.added) AS told
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.pos + 1
      JOIN m ON m.top = r.top AND (edit <> 'K' OR m.initial = f.initial)
        AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
      JOIN i ON i.top = m.after
    )
  ) GROUP BY conv_id, pos, top
),
t AS (
  SELECT conv_id, count(role) AS turns, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN f USING (conv_id) GROUP BY conv_id
),
e AS (
  SELECT conv_id, min(cost) AS cost, arg_min(audit, printf('%012d', cost) || audit) AS audit,
    arg_min(told, printf('%012d', cost) || audit) AS told
  FROM r JOIN t USING (conv_id) WHERE r.pos = t.turns AND top IN (0, 3) GROUP BY conv_id
)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit,
  sha256(array_to_string(told, chr(10))) AS repaired_sha256
FROM t JOIN e USING (conv_id)
"""

MIXING_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5(concat_ws(':', '13', CAST(doc_id AS VARCHAR))) AS h,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
),
x AS (
  SELECT *, row_number() OVER () AS id, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo
  FROM d
),
w AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
),
g AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight FROM w),
z AS (SELECT sum(source_size) AS words, sum(weight) AS weights, count(*) AS n FROM g),
v AS (
  SELECT *, 2 * source_size / weight AS ratio,
    coalesce(sum(2 * source_size) OVER b, 0) AS taken, coalesce(sum(weight) OVER b, 0) AS gone
  FROM g
  WINDOW b AS (ORDER BY 2 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
q AS (
  SELECT max((1.5 * words::DOUBLE - taken::DOUBLE) / (weights - gone)::DOUBLE) AS level FROM v, z
  WHERE (1.5 * words::DOUBLE - taken::DOUBLE) / (weights - gone)::DOUBLE <= ratio
),
t AS (SELECT g.*, least(CAST(2 * source_size AS DOUBLE), level * weight) AS target FROM g, q),
e AS (
  SELECT min(b) AS bits FROM range(60) r(b), z
  WHERE (CAST(1 AS HUGEINT) << b) >= ceil(1.5 * words::DOUBLE / 256 + n)
),
u AS (
  SELECT t.*, CAST(1 + floor(((1 << bits) - n)::DOUBLE * target / (1.5 * words::DOUBLE)) AS BIGINT) AS slots, bits
  FROM t, z, e
),
p AS (
  SELECT *, CAST(coalesce(sum(slots) OVER (
    ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS point FROM u
),
j AS (SELECT *, unnest(range(point, point + slots)) AS j FROM p),
k AS (
  SELECT *, CAST(list_sum(list_transform(range(bits), lambda i: ((j >> i) & 1) << (bits - 1 - i))) AS BIGINT) AS slot
  FROM j
),
n AS (
  SELECT source, slot, CAST(floor(target) AS BIGINT) AS line, slots,
    row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS block FROM k
),
s AS (
  SELECT source, slot, block * (line // slots) + least(block, line % slots) AS a,
    (block + 1) * (line // slots) + least(block + 1, line % slots) AS z FROM n
),
y AS (
  SELECT x.id, greatest(s.a, x.lo + r * source_size) AS a, least(s.z, x.lo + x.size + r * source_size) AS z, slot
  FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source CROSS JOIN range(2) c(r)
  JOIN s ON s.source IS NOT DISTINCT FROM x.source
    AND s.a < x.lo + x.size + r * source_size AND s.z > x.lo + r * source_size
),
o AS (SELECT id, sum(z - a) AS taken, min(slot) AS first_slot FROM y WHERE z > a GROUP BY id)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_slot
FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source LEFT JOIN o USING (id)
"""
