"""The queries as SQL, for those that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{_WORD}+') AS words FROM texts),
windows AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS i,
    unnest(list_transform(range(1, len(words) - 6), lambda i: list_slice(words, i, i + 7))) AS w
  FROM worded WHERE len(words) >= 8),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(next - i, 8))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) GROUP BY r),
measured AS (
  SELECT r, doc_id, text, words, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '{_WORD}')) AS lines
  FROM worded),
counted AS (
  SELECT m.*, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM measured m LEFT JOIN covered c ON c.r = m.r),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND 10 * n_symbols <= n_words
  AND word_chars BETWEEN 2 * n_words AND 12 * n_words
  AND 10 * n_dup_lines <= 4 * (length(text) - length(replace(text, chr(10), '')) + 1)
  AND 10 * (length(text) - length(replace(text, '!', ''))) <= n_words
  AND 10 * (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g'))) <= 4 * word_chars
  AND 10 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) <= 3 * n_words
  AND 10 * len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) >= 5 * n_words AS kept
FROM judged
"""

_ESCAPE = r"replace(replace(replace({}, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"

CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS n,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS before
  FROM turns),
judged AS (
  SELECT *, CASE WHEN n = 1 THEN role IN ('system', 'user') WHEN before = 'user'
      THEN role = 'assistant' ELSE role = 'user' END AS allowed,
    CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant'
      THEN 'Assistant' ELSE CASE WHEN role IN ('System', 'User', 'Assistant') THEN '\' ELSE '' END
        || replace({_ESCAPE.format("role")}, ':', '\:') END AS shown
  FROM numbered)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), ''))
    AS loss_sha256,
  CAST(sum(length(shown) + length({_ESCAPE.format("text")}) + 14) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AND arg_max(role, n) = 'assistant' AS valid
FROM judged GROUP BY conv_id
"""

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT l.vec_id, (SELECT count(*) FROM links k WHERE k.a = l.vec_id) AS n_links, l.component_id,
  l.vec_id = l.component_id AS kept
FROM least l
"""

JACCARD = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4))
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS s
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

NEGATIVES = """
WITH finite AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM finite a JOIN finite b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)
    AS INTEGER) AS rank,
  s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

# The checksum's table from its polynomial, and a checksum over a list of bytes.
_CRC_TABLE = """
SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
  THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS crcs FROM range(256) r(i)"""
_CRC = """
xor(list_reduce({bytes}, lambda c, b: xor(c // 256, crcs[xor(c % 256, b) + 1]), 4294967295),
  4294967295)"""

SHARDS = rf"""
WITH crc_table AS ({_CRC_TABLE}),
texts AS (
  SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS no_source,
    coalesce(text, '') AS text FROM documents),
keyed AS (
  SELECT doc_id, CASE WHEN no_source THEN '' ELSE '=' || source END AS source,
    CAST(strlen(text) + 8 AS BIGINT) AS size,
    {_CRC.format(bytes="list_transform(regexp_extract_all(hex(text), '..'), lambda h: CAST('0x' || h AS BIGINT))")} AS text_crc32,
    CAST('0x' || substr(md5(concat_ws(':', '12', coalesce(CAST(doc_id AS VARCHAR), ''), md5(text))), 1, 15)
      AS BIGINT) AS key
  FROM texts, crc_table),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, text_crc32) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + 0.5::DOUBLE) / n, source, r) - 1 AS place,
    count(*) OVER () AS rows FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 24 // rows AS INTEGER) AS shard,
  CAST(place - (place * 24 // rows * rows + 23) // 24 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

TRIE = rf"""
WITH crc_table AS ({_CRC_TABLE}),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 100 AS family,
    {_CRC.format(bytes="list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns) c, crc_table),
lent AS (
  SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t
    ON t.conv_id = c.family AND t.place < c.h),
rebuilt AS (
  SELECT conv_id, place + 1 AS depth, role, text FROM lent
  UNION ALL
  SELECT t.conv_id, t.place - c.h + 1
    + (SELECT count(*) FROM lent l WHERE l.conv_id = t.conv_id), t.role, t.text
  FROM turns t JOIN convs c ON c.conv_id = t.conv_id AND t.place >= c.h),
starts AS (
  SELECT conv_id, depth, length(text) AS chars,
    list(role || chr(0) || text) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM starts GROUP BY conv_id),
nodes AS (
  SELECT s.path, min(s.conv_id) AS conv_id, any_value(s.depth) AS depth, any_value(s.chars) AS chars,
    count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(s.conv_id AS VARCHAR), ',' ORDER BY s.conv_id)
      FILTER (WHERE l.depth = s.depth), '')) AS ends_sha256
  FROM starts s JOIN lengths l ON l.conv_id = s.conv_id GROUP BY s.path),
kin AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.path AS above,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]),
below AS (
  SELECT list_slice(path, 1, d) AS path, n_children, n_convs, chars
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM kin))
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, any_value(k.parent_conv_id) AS parent_conv_id,
  any_value(k.n_convs) AS n_convs, any_value(k.n_children) AS n_children,
  count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
  CAST(sum((b.n_convs - 1) * b.chars) AS BIGINT) AS saved_tokens, any_value(k.ends_sha256) AS ends_sha256
FROM kin k JOIN below b ON b.path = k.path GROUP BY k.path, k.conv_id, k.depth
"""
