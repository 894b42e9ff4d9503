"""The queries that SQL can express, in DuckDB's SQL, written from the definitions and not from the operators."""

from __future__ import annotations

from veilcount.llm import mixing, ngram_join, url_filter

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in url_filter.RULES)

URLS = f"""
WITH cut AS (
  SELECT row_number() OVER () AS id, page_id,
         coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END, '') AS rest FROM pages),
parts AS (
  SELECT id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules AS (SELECT * FROM (VALUES {_RULES}) r(name, start, verdict)),
fitting AS (
  SELECT id, max_by(struct_pack(rule := name || start, verdict := verdict), length(name || start) * 1000 + length(name)) AS best
  FROM parts JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY id)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN regexp_matches(host, '{"|".join(url_filter.TERMS)}') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fitting USING (id)"""

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, words[pos + 1:pos + size] AS w
  FROM (SELECT *, least(len(words), 10) AS size, unnest(range(len(words) - least(len(words), 10) + 1)) AS pos FROM items WHERE len(words) > 0)),
places AS (
  SELECT id, size, pos, words[pos + 1:pos + size] AS w
  FROM (SELECT *, unnest(range(len(words) - size + 1)) AS pos FROM docs JOIN (SELECT DISTINCT size FROM windows) ON len(words) >= size)),
hits AS (SELECT id, pos, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND p.w = v.w),
counted AS (
  SELECT id, count(DISTINCT word) AS n_hit FROM (SELECT id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY id),
found AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted USING (id) LEFT JOIN found USING (id)"""

JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT id, words[pos + 1:pos + least(len(words), {ngram_join.WORDS})] AS s
  FROM (SELECT *, unnest(range(greatest(len(words) - {ngram_join.WORDS}, 0) + 1)) AS pos FROM docs WHERE len(words) > 0)),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.id JOIN sizes y ON b = y.id
  WHERE 100 * k >= {ngram_join.PERCENT} * (x.n + y.n - k)),
reach AS (SELECT id AS a, id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS id, min(doc_id) AS component_id FROM reach JOIN docs ON b = id GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs LEFT JOIN sizes USING (id) LEFT JOIN least USING (id)"""



def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# Fixed value: the reversed polynomial of the usual 32-bit checksum.
_CRC = """xor(list_reduce(list_transform(range(len(CAST(doc_id AS VARCHAR))), lambda i: ord(CAST(doc_id AS VARCHAR)[i + 1])),
  lambda c, byte: list_reduce(range(8), lambda d, bit: xor(d >> 1, 3988292384 * (d & 1)), xor(c, byte)), 4294967295), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS changed FROM documents),
placed AS (
  SELECT *, coalesce('=' || lang, '') AS tree, row_number() OVER trees - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves WINDOW trees AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS node, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 1) // 2 FROM nodes WHERE n > 1
  GROUP BY tree, level, pos // 2),
tops AS (
  SELECT tree, node AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
crown AS (
  SELECT 0 AS level, pos, subroot AS node, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 1) // 2 FROM crown WHERE n > 1
  GROUP BY level, pos // 2),
whole AS (SELECT node AS root, level AS height FROM crown WHERE n = 1),
steps AS (
  SELECT p.tree, p.pos, s.level, CASE WHEN x.node IS NULL THEN '' WHEN x.pos % 2 = 0 THEN 'b' ELSE 'a' END || coalesce(x.node, '') AS step
  FROM placed p JOIN tops t USING (tree), LATERAL (SELECT unnest(range(t.height)) AS level) s
  LEFT JOIN nodes x ON x.tree = p.tree AND x.level = s.level AND x.pos = xor(p.pos >> s.level, 1)),
above AS (
  SELECT t.tree, list(CASE WHEN x.node IS NULL THEN '' WHEN x.pos % 2 = 0 THEN 'b' ELSE 'a' END || coalesce(x.node, '') ORDER BY l.level) AS way
  FROM tops t JOIN (SELECT unnest(range(height)) AS level FROM whole) l ON true
  LEFT JOIN crown x ON x.level = l.level AND x.pos = xor(t.pos >> l.level, 1) GROUP BY t.tree),
ways AS (SELECT tree, pos, list(step ORDER BY level) AS way FROM steps GROUP BY tree, pos),
folded AS (
  SELECT p.*, subroot, root, list_concat(coalesce(w.way, []), coalesce(a.way, [])) AS way
  FROM placed p JOIN tops t USING (tree) CROSS JOIN whole LEFT JOIN ways w ON w.tree = p.tree AND w.pos = p.pos LEFT JOIN above a ON a.tree = p.tree),
results AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda s: s[2:]), '')) AS proof_sha256,
         list_reduce(way, lambda node, s: sha256(CASE WHEN s[1] = 'b' THEN s[2:] || node ELSE node || s[2:] END), coalesce(changed, leaf)) AS folded_root
  FROM folded)
SELECT *, folded_root = root AS verified FROM results"""

_BASE32 = """array_to_string(list_transform(range(32), lambda i:
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((CAST('0x' || hex[i // 4 * 5 + 1:i // 4 * 5 + 5] AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1]), '')"""

ARCHIVES = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads),
kinds AS (SELECT *, page_id IS DISTINCT FROM first AS again FROM digests)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM kinds"""

ORACLES = {
    "op5_temperature_mix": mixing.ORACLE,
    "op6_ngram_join": JACCARD,
    "op7_url_cascade": URLS,
    "op9_decontaminate": DECONTAMINATION,
    "op12_merkle_manifest": MERKLE,
    "op13_warc_reader": ARCHIVES,
}
