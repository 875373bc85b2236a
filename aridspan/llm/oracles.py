"""SQL of those text queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = "coalesce(regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
SPACE_WORDS = r"coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {ALNUM_WORDS.format("text")} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {ALNUM_WORDS.format("text")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
),
found AS (SELECT doc_id, item_id, i, n FROM doc_windows JOIN item_windows USING (n, s)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS l FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {SPACE_WORDS.format(LOWER.format("text"))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM named LEFT JOIN sizes USING (doc_id)
"""

REPEATED_TEXT = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM docs WHERE len(h) >= 100)
),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (s) WHERE doc_id > first),
runs AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM gone),
spans AS (SELECT doc_id, min(p) AS a, max(p) AS b FROM runs GROUP BY doc_id, island),
parts AS (
  SELECT s.doc_id, substr(d.h, 2 * from_ + 1, 2 * (a - from_)) AS x, a, b FROM (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a) + 1, 0) AS from_ FROM spans) s JOIN docs d USING (doc_id)
),
cut AS (SELECT doc_id, string_agg(x, '' ORDER BY a) AS head, max(b) AS last, count(*) AS n_spans, CAST(sum(b - a + 1) AS BIGINT) AS n_removed FROM parts GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last + 3) END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

#: White space that is stripped from lines, for DuckDB's trim.
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def line_rules(separators: str, phrases: str, menu: list[str], ends: str) -> str:
    """separators, phrases: patterns; menu: words; ends: characters that may close a line."""
    quoted = ", ".join(f"'{w}'" for w in sorted(menu))
    marks = ends.replace("'", "''")
    return rf"""
WITH docs AS (SELECT doc_id, text, {SPACE_WORDS.format("text")} AS w FROM documents),
base AS (
  SELECT doc_id, text, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(coalesce(regexp_extract_all(text, '[#*$%&|<>]'), [])) AS n_symbols FROM docs
),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 2) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, k, trim(line, {BLANK}) AS core FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM docs)
),
full_lines AS (SELECT doc_id, line, k, core, {SPACE_WORDS.format("core")} AS lw, {LOWER.format("core")} AS low FROM lines WHERE core <> ''),
counted AS (
  SELECT *, len(lw) AS n, len(coalesce(regexp_extract_all(core, '{separators}'), [])) AS parts,
    len(coalesce(regexp_extract_all(core, '[#*$%&|<>]'), [])) AS marks,
    len(list_filter({SPACE_WORDS.format("low")}, lambda v: trim(v, '.,:;!?') IN ({quoted}))) AS menu, len(array_to_string(lw, '')) AS chars FROM full_lines
),
judged AS (
  SELECT *, CASE WHEN regexp_matches(low, '{phrases}') THEN 3
    WHEN parts >= 2 AND n <= 4 * (parts + 1) THEN 2 WHEN n <= 6 AND menu * 2 >= n THEN 2
    WHEN position(right(core, 1) IN '{marks}') = 0 AND NOT regexp_matches(core, '[.!?] ') THEN 1 WHEN marks >= 3 AND 3 * marks >= n THEN 1 ELSE 0 END AS fault FROM counted
),
sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (fault = 1) AS n_bad_punctuation,
    count(*) FILTER (fault = 2) AS n_navigation, count(*) FILTER (fault = 3) AS n_boilerplate,
    CAST(coalesce(sum(chars) FILTER (fault > 0), 0) AS BIGINT) AS lost_chars FROM judged GROUP BY doc_id
),
clean AS (
  SELECT l.doc_id, CAST(sum(len(l.line)) + count(*) - 1 AS BIGINT) AS clean_chars FROM lines l LEFT JOIN judged j ON j.doc_id = l.doc_id AND j.k = l.k
  WHERE coalesce(j.fault, 0) = 0 GROUP BY l.doc_id
),
every AS (
  SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    b.n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * b.n_words AS base_failed, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_bad_punctuation, 0) AS n_bad_punctuation, coalesce(n_navigation, 0) AS n_navigation, coalesce(n_boilerplate, 0) AS n_boilerplate,
    coalesce(lost_chars, 0) AS lost_chars, CASE WHEN text IS NOT NULL THEN coalesce(clean_chars, 0) END AS clean_chars
  FROM base b LEFT JOIN sums s ON s.doc_id = b.doc_id LEFT JOIN repeats r ON r.doc_id = b.doc_id LEFT JOIN clean c ON c.doc_id = b.doc_id
)
SELECT *, NOT base_failed AND 2 * lost_chars <= word_chars AS kept FROM every
"""

#: CRC-32 in SQL: the table of 256 remainders, by its rule, and the checksum of an ASCII string with that table in column t.
CRC_TABLE = """(SELECT list_transform(range(256), lambda b: list_reduce(range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t)"""
CRC = """xor(list_reduce(list_transform(range(1, len({0}) + 1), lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""

STRUCTURE_REPAIR = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
),
kinds AS (SELECT conv_id, turn, role, text, {CRC.format("k")} % 20 AS kind FROM keyed, {CRC_TABLE}),
changed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last, left(role, 1) AS initial FROM changed
),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS k, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
faults AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN k > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id
),
inserts(a, b, k) AS (VALUES ('-', '-', 0), ('-', 'u', 1), ('-', 'a', 2), ('s', 's', 0), ('s', 'u', 1), ('s', 'a', 2), ('u', 'u', 0), ('u', 'a', 1), ('a', 'a', 0), ('a', 'u', 1)),
edits(initial, a, b, cost, letter) AS (VALUES
  ('s', '-', 's', 0, 'K'), ('u', '-', 'u', 0, 'K'), ('u', 's', 'u', 0, 'K'), ('u', 'a', 'u', 0, 'K'), ('a', 'u', 'a', 0, 'K'),
  ('*', '-', 'u', 1, 'R'), ('*', 's', 'u', 1, 'R'), ('*', 'a', 'u', 1, 'R'), ('*', 'u', 'a', 1, 'R'),
  ('*', '-', '-', 2, 'D'), ('*', 's', 's', 2, 'D'), ('*', 'u', 'u', 2, 'D'), ('*', 'a', 'a', 2, 'D')),
ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '-' AS state, {{'c': 0, 's': ''}} AS way FROM counts
  UNION ALL
  SELECT w.conv_id, f.i, e.b, min({{'c': way.c + 5 * x.k + e.cost + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END, 's': way.s || repeat('I', x.k) || letter}})
  FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN inserts x ON x.a = state
  JOIN edits e ON e.a = x.b AND (e.initial = '*' OR e.initial = f.initial) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) GROUP BY w.conv_id, f.i, e.b
),
best AS (
  SELECT w.conv_id, min({{'c': way.c + 5 * x.k, 's': way.s || repeat('I', x.k)}}) AS way
  FROM ways w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts x ON x.a = state AND x.b IN ('-', 'a') GROUP BY w.conv_id
),
letters AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER p AS i, count(*) FILTER (letter <> 'D') OVER p AS place
  FROM (SELECT conv_id, unnest(string_split(way.s, '')) AS letter, generate_subscripts(string_split(way.s, ''), 1) AS g FROM best WHERE way.s <> '')
  WINDOW p AS (PARTITION BY conv_id ORDER BY g)
),
rows AS (
  SELECT l.conv_id, place, letter, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN place = 1 AND letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS head
  FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE letter <> 'D'
),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS body
  FROM rows GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(way.c, 0) AS BIGINT) AS cost, coalesce(way.s, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS k FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (
  SELECT c, c - c % 5 AS base, {CRC.format("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM turns), {CRC_TABLE}
),
rebuilt AS (
  SELECT c, 0 AS part, k, role, text FROM ids JOIN turns ON conv_id = base AND k <= h
  UNION ALL SELECT c, 1, k, role, text FROM ids JOIN turns ON conv_id = c AND k > h
),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, k) AS d, md5(role) || md5(text) AS x, strlen(text) AS bytes FROM rebuilt),
paths AS (SELECT c, d, md5(string_agg(x, '') OVER (PARTITION BY c ORDER BY d)) AS p, bytes FROM placed),
members AS (
  SELECT c, 0 AS d, 'root' AS p, NULL AS parent, 0 AS bytes FROM ids
  UNION ALL SELECT c, d, p, coalesce(lag(p) OVER (PARTITION BY c ORDER BY d), 'root'), bytes FROM paths
),
nodes AS (SELECT p, d, parent, bytes, count(*) AS n_convs, min(c) AS conv_id FROM members GROUP BY p, d, parent, bytes),
children AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children ON children.parent = nodes.p),
below AS (
  SELECT m.p, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * n.bytes) AS BIGINT) AS saved_tokens
  FROM full_nodes n JOIN members m ON m.c = n.conv_id AND m.d <= n.d GROUP BY m.p
),
lengths AS (SELECT c, max(d) AS d FROM members GROUP BY c),
ends AS (SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS s FROM members JOIN lengths USING (c, d) GROUP BY p)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, coalesce(s, sha256('')) AS ends_sha256
FROM full_nodes n JOIN below USING (p) LEFT JOIN nodes u ON u.p = n.parent LEFT JOIN ends ON ends.p = n.p
"""
