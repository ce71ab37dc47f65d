"""SQL for DuckDB with the results that the operators must give."""

_ASCII = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 has no function there: the table of its 256 steps, then one step per byte.
_STEPS = """steps AS (
  SELECT list(crc ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)),
      lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS crc
    FROM (SELECT unnest(range(256)) AS b))
)"""


def _crc32(text: str) -> str:
    """The unsigned checksum of a text, where ``steps`` is joined."""
    digits = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ('0x' || p)::BIGINT)"
    step = "xor(a >> 8, t[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda a, b: {step}), 4294967295)"


SHARDS = f"""
WITH {_STEPS},
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(text, '') AS whole FROM documents
),
coded AS (SELECT doc_id, size, {_crc32("whole")} AS text_crc32 FROM sized, steps),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before,
    sum(size) OVER () AS total
  FROM coded
),
dealt AS (
  SELECT *, least(39, ((2 * before + size) * 40) // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM dealt
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  true AS has_request, true AS has_metadata
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

# Windows have ten words, or all words of a shorter item; a document's runs of each length
# that occurs are compared.
DECONTAMINATION = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_ASCII}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
),
pattern AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[i + 1 : i + least(10, len(w))], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)
),
doc AS (
  SELECT doc_id, regexp_extract_all({_ASCII}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
run AS (
  SELECT doc_id, size, i, array_to_string(w[i + 1 : i + size], ' ') AS run
  FROM (
    SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS i
    FROM doc, (SELECT DISTINCT size FROM pattern) WHERE len(w) >= size
  )
),
found AS (SELECT doc_id, item_id, i, r.size FROM run r JOIN pattern p ON r.size = p.size AND r.run = p.run),
hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT doc_id, i, unnest(range(size)) AS k FROM found) GROUP BY 1
),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM found GROUP BY 1
)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_ASCII}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(5, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(1, len(w) - 4))) AS i FROM doc WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
  SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)
),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, y FROM reach JOIN link ON other = x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM documents LEFT JOIN size USING (doc_id) JOIN reach ON doc_id = node
GROUP BY doc_id, n
"""


def _leaf(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    fields = [f"coalesce(strlen(({v})::VARCHAR)::VARCHAR || ':' || ({v})::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(fields)})"


MERKLE = f"""
WITH RECURSIVE {_STEPS},
leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS own,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS claim
  FROM documents, steps
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, own) - 1 AS i, count(*) OVER (PARTITION BY g) AS n
  FROM leaf
),
tree AS (
  SELECT g, 0 AS lvl, i, n, own AS h FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY g, lvl, i // 2, n
),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, i, n, h FROM sub
  UNION ALL
  SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM crown WHERE n > 1 GROUP BY lvl, i // 2, n
),
above AS (
  SELECT doc_id, 0 AS stage, lvl, i, (i >> lvl) % 2 AS odd, xor(i >> lvl, 1) AS beside, p.g
  FROM (SELECT doc_id, g, i, unnest(range((SELECT max(lvl) FROM tree t WHERE t.g = placed.g))) AS lvl FROM placed) p
),
step AS (
  SELECT a.doc_id, 0 AS stage, a.lvl, odd, h FROM above a LEFT JOIN tree t ON t.g = a.g AND t.lvl = a.lvl AND t.i = beside
  UNION ALL
  SELECT doc_id, 1, u.lvl, u.odd, c.h
  FROM placed JOIN (
    SELECT g, lvl, (i >> lvl) % 2 AS odd, xor(i >> lvl, 1) AS beside
    FROM (SELECT g, i, unnest(range((SELECT max(lvl) FROM crown))) AS lvl FROM sub)) u USING (g)
  LEFT JOIN crown c ON c.lvl = u.lvl AND c.i = beside
),
path AS (
  SELECT doc_id, coalesce(string_agg(h, '' ORDER BY stage, lvl), '') AS beside,
    list(CASE WHEN h IS NULL THEN '-' WHEN odd = 1 THEN 'l' || h ELSE 'r' || h END ORDER BY stage, lvl) AS steps
  FROM step GROUP BY doc_id
),
folded AS (
  SELECT p.*, coalesce(beside, '') AS beside,
    list_reduce(list_prepend(coalesce(claim, own), coalesce(path.steps, [])), lambda a, s:
      sha256(CASE s[1:1] WHEN '-' THEN a WHEN 'l' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM placed p LEFT JOIN path USING (doc_id)
)
SELECT doc_id, own AS leaf, sub.h AS subroot, crown.h AS root, sha256(beside) AS proof_sha256,
  folded_root, folded_root = crown.h AS verified
FROM folded JOIN sub USING (g) JOIN crown ON crown.n = 1
"""

PREFIX_TRIE = f"""
WITH {_STEPS},
placed AS (
  SELECT conv_id AS c, sha256(strlen(role) || ':' || role || ':' || strlen(text) || ':' || text) AS t,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(role) || ':' || role || ':' || strlen(text) || ':' || text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)
),
conv AS (
  SELECT c, c - c % 20 AS head, {_crc32("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM placed), steps
),
kept AS (
  SELECT conv.c, head, h, least(h, count(p.c)) AS k FROM conv LEFT JOIN placed p ON p.c = head GROUP BY conv.c, head, h
),
rebuilt AS (
  SELECT k.c, pos AS depth, t, words FROM kept k JOIN placed p ON p.c = head AND pos <= k
  UNION ALL
  SELECT c, k + pos - h, t, words FROM kept JOIN placed p USING (c) WHERE pos > h
  UNION ALL
  SELECT c, 0, '', 0 FROM kept
),
path AS (
  SELECT c, depth, words, sha256(string_agg(t, ',') OVER (PARTITION BY c ORDER BY depth)) AS id,
    max(depth) OVER (PARTITION BY c) = depth AS ends
  FROM rebuilt
),
linked AS (SELECT *, lag(id) OVER (PARTITION BY c ORDER BY depth) AS above FROM path),
node AS (
  SELECT id, above, depth, words, min(c) AS conv, count(*) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends
  FROM linked GROUP BY id, above, depth, words
),
children AS (SELECT above, count(*) AS n FROM node GROUP BY above),
whole AS (
  SELECT n.*, coalesce(children.n, 0) AS children FROM node n LEFT JOIN children ON children.above = n.id
),
below AS (
  SELECT p.id, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * w.words)::BIGINT AS saved
  FROM whole w JOIN path p ON p.c = w.conv AND p.depth <= w.depth GROUP BY p.id
)
SELECT w.conv AS conv_id, w.depth, up.conv AS parent_conv_id, w.n AS n_convs, w.children AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN below USING (id) LEFT JOIN node up ON up.id = w.above
"""
