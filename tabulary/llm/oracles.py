"""DuckDB SQL for the operators that SQL can express; each compares texts directly and uses none of the operator's index."""

from __future__ import annotations

_WORDS = r"string_split_regex(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+')"

LEAKS = rf"""
WITH texts AS (SELECT DISTINCT doc_id, md5(text) AS text_md5, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
placed AS (
  SELECT doc_id, text_md5, len(w) - 4 AS size, unnest(range(0, len(w) - 4)) AS place,
    unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS shingle
  FROM texts WHERE len(w) >= 5),
item_words AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
item_places AS (
  SELECT item_id, len(w) - 4 AS n, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS shingle
  FROM item_words WHERE len(w) >= 5),
item_counts AS (SELECT item_id, n, shingle, count(*) AS c FROM item_places GROUP BY ALL),
pairs AS (SELECT DISTINCT doc_id, text_md5, size, item_id, n FROM placed JOIN item_counts USING (shingle)),
starts AS (SELECT *, unnest(range(0, greatest(0, size - n) + 1)) AS start FROM pairs),
counted AS (
  SELECT s.doc_id, s.text_md5, s.item_id, s.start, s.n, least(s.n, s.size) AS m, p.shingle, count(*) AS c
  FROM starts s JOIN placed p ON p.doc_id = s.doc_id AND p.text_md5 = s.text_md5 AND p.place >= s.start AND p.place < s.start + s.n
  GROUP BY ALL),
common AS (
  SELECT doc_id, text_md5, item_id, start, n, m, sum(least(k.c, i.c)) AS common
  FROM (SELECT doc_id, text_md5, item_id, start, n, m, shingle, c FROM counted) k JOIN (SELECT item_id, shingle, c FROM item_counts) i USING (item_id, shingle)
  GROUP BY ALL)
SELECT doc_id, text_md5, item_id, max(CAST(common AS DOUBLE) / CAST(n + m - common AS DOUBLE)) AS similarity
FROM common WHERE CAST(common AS DOUBLE) / CAST(n + m - common AS DOUBLE) >= 0.8
GROUP BY doc_id, text_md5, item_id
"""

CHAT = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos,
    '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM t),
w AS (SELECT conv_id, max(pos) AS turns, string_agg(md5(role || chr(31) || text), '' ORDER BY pos) AS whole FROM p GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, turns, whole, count(*) AS copies FROM w GROUP BY turns, whole),
m AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.turns > k.turns AND starts_with(w.whole, k.whole)))
SELECT m.conv_id, CAST(floor(p.turn / 256.0) AS BIGINT) AS part, m.turns, m.copies, string_agg(p.line, '' ORDER BY p.pos) AS text
FROM m JOIN p ON p.conv_id = m.conv_id GROUP BY m.conv_id, floor(p.turn / 256.0), m.turns, m.copies
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE named AS (SELECT doc_id, md5(text) AS node, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
full_texts AS (SELECT doc_id, node, w FROM named WHERE len(list_filter(w, lambda x: x <> '')) > 0),
nodes AS (SELECT node, any_value(w) AS w FROM full_texts GROUP BY node),
shingle AS (
  SELECT node, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
    ELSE [array_to_string(w, ' ')] END) AS s FROM nodes),
counts AS (SELECT node, s, count(*) AS c FROM shingle GROUP BY node, s),
sizes AS (SELECT node, sum(c) AS n FROM counts GROUP BY node),
common AS (
  SELECT a.node AS x, b.node AS y, sum(least(a.c, b.c)) AS common FROM counts a JOIN counts b ON a.s = b.s AND a.node <> b.node GROUP BY a.node, b.node),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.node = x JOIN sizes q ON q.node = y WHERE common >= 0.8 * (p.n + q.n - common)),
reach(x, y) AS (
  SELECT node, node FROM nodes UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
class AS (SELECT x AS node, min(y) AS component FROM reach GROUP BY x),
labelled AS (SELECT doc_id, component FROM full_texts JOIN class USING (node)),
merged AS (SELECT component, min(doc_id) AS class_id, count(*) AS class_size FROM labelled GROUP BY component)
SELECT doc_id, class_id, class_size FROM labelled JOIN merged USING (component)
UNION ALL
SELECT doc_id, doc_id, CAST(1 AS BIGINT) FROM documents WHERE text IS NULL
UNION ALL
SELECT doc_id, doc_id, CAST(1 AS BIGINT) FROM named WHERE len(list_filter(w, lambda x: x <> '')) = 0
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents WHERE text IS NOT NULL),
split AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (SELECT unnest(range(1, 5)) AS k))),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
long AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM long),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, h.a AS l, t.a AS r, (2000000 * c.a) // (h.a + t.a) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(list_slice(c.w, c.cut + 1, c.k), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i FROM long, (SELECT unnest(range(2, 4)) AS m) WHERE m < k)),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN covers c ON c.lang = s.lang AND c.phrase = s.phrase
  WHERE c.longer IS NULL OR 100 * c.longer < 80 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_CRC_TABLE = "(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c FROM (SELECT unnest(range(256)) AS i)))"


def _crc32(blob: str) -> str:
    """The unsigned crc32 of an expression of type BLOB, byte by byte with the table ``crc.t``."""
    octets = f"list_transform(regexp_extract_all(hex({blob}), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c // 256, crc.t[xor(c % 256, b) + 1]), 4294967295), 4294967295)"


SHARDS = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
docs AS (
  SELECT doc_id, COALESCE(text, '') AS text, md5(COALESCE(text, '')) AS key, octet_length(encode(COALESCE(text, ''))) + 1 AS size FROM documents),
grouped AS (SELECT key, CAST(sum(size) AS BIGINT) AS size FROM docs GROUP BY key),
by_size AS (
  SELECT key, size, row_number() OVER (ORDER BY size DESC, key) AS nth,
    sum(size) OVER (ORDER BY size DESC, key) - size AS before, sum(size) OVER () AS total FROM grouped),
own AS (
  SELECT key, CAST(nth - 1 AS INTEGER) AS shard FROM by_size
  WHERE nth < 16 AND nth <= (SELECT COALESCE(min(nth) - 1, 15) FROM by_size WHERE size * (17 - nth) <= total - before)),
left_over AS (SELECT 16 - count(*) AS shards FROM own),
ranked AS (
  SELECT key, size, CAST(sum(size) OVER (ORDER BY key) AS BIGINT) AS finish FROM grouped WHERE key NOT IN (SELECT key FROM own)),
all_ends AS (SELECT list(finish ORDER BY finish) AS ends, max(finish) AS total, max(size) AS largest, count(*) AS n FROM ranked),
search(low, high) AS (
  SELECT greatest(largest, -(-total // shards)), total FROM all_ends, left_over
  UNION ALL
  SELECT CASE WHEN fits THEN low ELSE middle + 1 END, CASE WHEN fits THEN middle ELSE high END
  FROM (
    SELECT low, high, (low + high) // 2 AS middle,
      list_reduce(range(shards), lambda place, k: COALESCE(list_max(list_filter(ends, lambda e: e <= place + (low + high) // 2)), 0), CAST(0 AS BIGINT)) >= total AS fits
    FROM search, all_ends, left_over WHERE low < high)),
capacity AS (SELECT low AS c FROM search WHERE low = high),
least(k, place) AS (
  SELECT CAST(shards AS BIGINT), total FROM all_ends, left_over
  UNION ALL
  SELECT k - 1, CASE WHEN place <= c THEN 0 ELSE list_min(list_filter(ends, lambda e: e >= place - c)) END
  FROM least, all_ends, capacity WHERE k > 1),
cuts(k, place) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT cuts.k + 1, greatest(least.place, COALESCE(list_max(list_filter(ends, lambda e: e <= least(total * (cuts.k + 1) // shards, cuts.place + c))), 0))
  FROM cuts JOIN least ON least.k = cuts.k + 1, all_ends, capacity, left_over),
placed AS (
  SELECT key, shard FROM own
  UNION ALL
  SELECT key, CAST((16 - shards) + (SELECT count(*) FROM cuts WHERE k >= 1 AND k < shards AND place <= finish - size) AS INTEGER) FROM ranked, left_over),
folded AS (
  SELECT doc_id, d.key, size, shard, {_crc32("encode(text)")} AS text_crc32,
    {_crc32("encode(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || d.key)")} % 1024 AS fold
  FROM docs d JOIN placed USING (key), crc)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY fold, key, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM folded
"""
