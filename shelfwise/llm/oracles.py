"""DuckDB SQL of the queries that SQL can express, written on bytes (hex digits)
and words, without minimizers, fingerprints or prefix sums per partition."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: CRC-32 of the bytes in hex(h): the table by its rule, then a fold over the bytes.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY b) AS t FROM (
  SELECT b, list_reduce([b::UBIGINT] || list_transform(range(8), lambda i: 0::UBIGINT),
                        lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c
  FROM range(256) r(b)))"""
_CRC = """CAST(xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(h, '..'), lambda b: ('0x' || b)::UBIGINT),
       lambda a, x: xor(a >> 8, t[((xor(a, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) AS BIGINT)"""
_HEX = "d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)"

BYTE_SHARDS = f"""WITH {_HEX}, {_CRC_TABLE},
s AS (SELECT doc_id, h, length(h) // 2 + 1 AS size, sum(length(h) // 2 + 1) OVER (ORDER BY doc_id) AS upto, sum(length(h) // 2 + 1) OVER () AS total FROM d),
p AS (SELECT *, CAST(least(15, (2 * (upto - size) + size) * 16 // (2 * total)) AS INTEGER) AS shard FROM s)
SELECT doc_id, CAST(size AS BIGINT) AS size, {_CRC} AS text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p, crc_table"""

REPEATED_STRINGS = f"""WITH {_HEX},
b AS (SELECT doc_id, unnest(range(length(h) // 2)) AS j, unnest(regexp_extract_all(h, '..')) AS byte FROM d),
w AS (SELECT doc_id, j, substr(h, 2 * j + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS j FROM d)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT w.doc_id, w.j FROM w JOIN f ON w.s = f.s WHERE f.first_doc < w.doc_id),
c AS (SELECT b.doc_id, b.j, b.byte, coalesce(b.j - max(hit.j) OVER (PARTITION BY b.doc_id ORDER BY b.j) < 50, FALSE) AS cut
      FROM b LEFT JOIN hit ON b.doc_id = hit.doc_id AND b.j = hit.j),
e AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY j), FALSE) AS opens FROM c),
r AS (SELECT doc_id, count(*) FILTER (WHERE cut) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
             string_agg(byte, '' ORDER BY j) FILTER (WHERE NOT cut) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(r.n_removed, 0) AS n_removed, coalesce(r.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(r.kept, ''))) AS kept_sha256
FROM d LEFT JOIN r ON d.doc_id = r.doc_id"""


def _grams(table: str, key: str) -> str:
    return f"""(SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '(?:[0-9a-z]|[^\\x00-\\x7F])+') AS w FROM {table})"""


CONTAINED_ITEMS = f"""WITH i AS (SELECT item_id, w, least(5, len(w)) AS k FROM {_grams("benchmark", "item_id")} WHERE len(w) > 0),
ig AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM i)),
n AS (SELECT item_id, count(*) AS n FROM ig GROUP BY item_id),
k AS (SELECT DISTINCT k FROM ig),
dw AS (SELECT doc_id, w, k FROM {_grams("documents", "doc_id")}, k),
dg AS (SELECT DISTINCT doc_id, k, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM dw))
SELECT dg.doc_id, ig.item_id, CAST(count(*) AS DOUBLE) / n.n AS containment
FROM dg JOIN ig ON dg.g = ig.g AND dg.k = ig.k JOIN n ON n.item_id = ig.item_id
GROUP BY dg.doc_id, ig.item_id, n.n HAVING CAST(count(*) AS DOUBLE) / n.n >= 0.8"""


def _leaf_field(expr: str) -> str:
    return f"coalesce(octet_length(encode(CAST({expr} AS VARCHAR))) || ':' || CAST({expr} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_leaf_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: Trees level by level from whole tables of nodes; every row then walks up them.
MERKLE_MANIFEST = f"""WITH RECURSIVE {_CRC_TABLE},
x AS (SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS changed, hex(encode(CAST(doc_id AS VARCHAR))) AS h FROM documents),
r AS (SELECT doc_id, coalesce('=' || lang, '-') AS key, leaf, CASE WHEN {_CRC} % 3 = 0 THEN changed ELSE leaf END AS altered,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM x, crc_table),
up(key, lev, pos, n, d) AS (
  SELECT key, 0, pos, n, leaf FROM r
  UNION ALL SELECT key, lev + 1, pos // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY key, lev, pos // 8, n),
sub AS (SELECT key, lev, d, row_number() OVER (ORDER BY encode(key)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top(lev, pos, n, d) AS (
  SELECT 0, pos, n, d FROM sub
  UNION ALL SELECT lev + 1, pos // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lev, pos // 8, n),
root AS (SELECT d AS root FROM top WHERE n = 1),
nodes AS (SELECT key, lev, pos, d FROM up WHERE n > 1 UNION ALL SELECT '', lev, pos, d FROM top WHERE n > 1),
step AS (SELECT key, lev, pos, pos // 8 AS run, d FROM nodes),
walk(id, key, lev, pos, own, tail) AS (
  SELECT row_number() OVER (), key, 0, pos, altered, '' FROM r
  UNION ALL
  SELECT w.id, w.key, w.lev + 1, w.pos // 8, sha256(string_agg(CASE WHEN s.pos = w.pos THEN w.own ELSE s.d END, '' ORDER BY s.pos)),
         w.tail || coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (WHERE s.pos <> w.pos), '')
  FROM walk w JOIN step s ON s.key = w.key AND s.lev = w.lev AND s.run = w.pos // 8
  GROUP BY w.id, w.key, w.lev, w.pos, w.tail),
numbered AS (SELECT *, row_number() OVER () AS id FROM r),
climbed AS (SELECT id, arg_max(own, lev) AS own, arg_max(tail, lev) AS tail FROM walk GROUP BY id),
crown(id, lev, pos, own, tail) AS (
  SELECT c.id, 0, sub.pos, c.own, c.tail FROM climbed c JOIN numbered m ON m.id = c.id JOIN sub ON sub.key = m.key
  UNION ALL
  SELECT w.id, w.lev + 1, w.pos // 8, sha256(string_agg(CASE WHEN s.pos = w.pos THEN w.own ELSE s.d END, '' ORDER BY s.pos)),
         w.tail || coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (WHERE s.pos <> w.pos), '')
  FROM crown w JOIN step s ON s.key = '' AND s.lev = w.lev AND s.run = w.pos // 8
  GROUP BY w.id, w.lev, w.pos, w.tail),
done AS (SELECT id, arg_max(own, lev) AS own, arg_max(tail, lev) AS tail FROM crown GROUP BY id)
SELECT m.doc_id, m.leaf, sub.d AS subroot, root.root, sha256(done.tail) AS proof_sha256, done.own AS folded_root, done.own = root.root AS verified
FROM done JOIN numbered m ON m.id = done.id JOIN sub ON sub.key = m.key, root"""
