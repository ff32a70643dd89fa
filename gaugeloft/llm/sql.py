"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from gaugeloft.llm.pii import AFTER, BASE, BEFORE, CONTEXT, LOWER, OCTET, SCORES, UPPER
from gaugeloft.llm.sharding import PRIME, ROUNDS, _key

SHARDS, SHARD_SEED = 8, 20

#: CTEs ``crc_bits`` (the table of the CRC-32 polynomial) and ``crc``: doc_id, text_crc32 of the UTF-8 bytes.
CRC = """
crc_bits AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM crc_bits, (
    SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: instr('0123456789ABCDEF', x[1]) * 16 + instr('0123456789ABCDEF', x[2]) - 17) AS bytes FROM documents))
"""


def _feistel(source: str, value: str) -> str:
    """Rows of ``source`` (row_number, half_bits and ``value``) with the permuted value as ``v``."""
    inner = f"SELECT row_number, half_bits, rows, {value} >> half_bits AS l, {value} & ((1::BIGINT << half_bits) - 1) AS r FROM {source}"
    for k in range(ROUNDS):
        first, added, second = (_key(SHARD_SEED, 3 * k + j) for j in range(3))
        x = f"((r * {first} + {added}) % {PRIME})"
        inner = (
            f"SELECT row_number, half_bits, rows, r AS l, xor(l, (xor(x, x >> 15) * {second}) % {PRIME} & ((1::BIGINT << half_bits) - 1)) AS r "
            f"FROM (SELECT *, {x} AS x FROM ({inner}))"
        )
    return f"SELECT row_number, half_bits, rows, (l << half_bits) | r AS v FROM ({inner})"


SHARDS_SQL = f"""
WITH RECURSIVE {CRC},
numbered AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    row_number() OVER (ORDER BY doc_id) - 1 AS row_number, count(*) OVER () AS rows FROM documents),
bits AS (
  SELECT row_number, rows, greatest(1, (ceil(log2(greatest(rows, 2)))::BIGINT + 1) // 2) AS half_bits FROM numbered),
walk AS (
  {_feistel("bits", "row_number")}
  UNION ALL
  {_feistel("(SELECT * FROM walk WHERE v >= rows)", "v")})
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (v % {SHARDS})::INTEGER AS shard,
  (v // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard, row_number::BIGINT AS row_number
FROM numbered JOIN crc USING (doc_id) JOIN walk USING (row_number) WHERE v < walk.rows
"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
classes AS (SELECT md5(list_sort(s)::VARCHAR) AS class, min(doc_id) AS doc_id, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY 1),
held AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM classes),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n_a, b.n AS n_b, count(*) AS n FROM held a JOIN held b
  ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * n >= 80 * (n_a + n_b - n)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS other FROM classes UNION SELECT r.node, e.b FROM reached r JOIN either e ON r.other = e.a),
named AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(n.component_id, s.doc_id)::BIGINT AS component_id, s.doc_id = coalesce(n.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON md5(list_sort(s.s)::VARCHAR) = c.class LEFT JOIN named n ON n.node = c.doc_id
"""

#: Plain forms of the proposals, without look-around: the engine of DuckDB has none and needs none.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
}
DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
LUHN = f"""list_sum(list_transform(range(length({DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN reverse({DIGITS})[i + 1]::INTEGER
  WHEN reverse({DIGITS})[i + 1]::INTEGER > 4 THEN reverse({DIGITS})[i + 1]::INTEGER * 2 - 9 ELSE reverse({DIGITS})[i + 1]::INTEGER * 2 END)) % 10 = 0"""
MOD97 = """list_reduce(list_prepend(0::BIGINT, list_transform(string_split(replace(hit, ' ', '')[5:] || replace(hit, ' ', '')[1:4], ''),
  lambda c: CASE WHEN c >= 'A' THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END)),
  lambda rest, v: CASE WHEN v >= 1000 THEN (rest * 100 + v - 1000) % 97 ELSE (rest * 10 + v) % 97 END) = 1"""
PASSES = {
    "email": "true",
    "ip": rf"regexp_full_match(hit, '{OCTET}(?:\.{OCTET}){{3}}')",
    "card": f"length({DIGITS}) BETWEEN 14 AND 19 AND {LUHN}",
    "phone": f"length({DIGITS}) BETWEEN 10 AND 15",
    "iban": MOD97,
}


def _spans(kind: str, rank: int) -> str:
    low, high = SCORES[kind]
    words = "|".join(CONTEXT[kind])
    near = f"translate(text[greatest(pos - {BEFORE}, 0) + 1 : pos] || ' ' || text[pos + length(hit) + 1 : pos + length(hit) + {AFTER}], '{UPPER}', '{LOWER}')"
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, pos AS start, pos + length(hit) AS "end",
    CASE WHEN regexp_matches({near}, '(?:^|[^a-z])(?:{words})(?:$|[^a-z])') THEN '{high}' ELSE '{low}' END AS score
  FROM (
    SELECT doc_id, text, hit, sum(length(piece)) OVER w + sum(length(hit)) OVER w - length(hit) AS pos
    FROM (
      SELECT doc_id, text, unnest(hits) AS hit, unnest(pieces[1:len(hits)]) AS piece, generate_subscripts(hits, 1) AS n
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{PLAIN[kind]}') AS hits, string_split_regex(text, '{PLAIN[kind]}') AS pieces FROM texts))
    WINDOW w AS (PARTITION BY doc_id ORDER BY n))
  WHERE {PASSES[kind]}"""


_JOINED = """string_agg(kind || ':' || start::BIGINT || ':' || \"end\"::BIGINT, ',' ORDER BY start, rank)"""

PII_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans(k, r) for r, k in enumerate(PLAIN))})
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in PLAIN)},
  sha256(coalesce({_JOINED} FILTER (rank < {len(BASE)}), '')) AS base_sha256,
  coalesce({_JOINED}, '') AS spans, coalesce(string_agg(score, ',' ORDER BY start, rank), '') AS scores
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""

AUDIT_SQL = r"""
WITH judged AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
rows AS (
  SELECT part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS f
  FROM judged LEFT JOIN known USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM orders),
kinds AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rows GROUP BY part, f),
placed AS (
  SELECT part, filter_order, step, filter_order[step] AS filter, n, good, toxic, f,
    f[ascii(filter_order[step]) - 64] AS fails,
    len(list_filter(range(1, step), lambda i: f[ascii(filter_order[i]) - 64])) > 0 AS gone,
    len(list_filter(f, lambda x: x)) = 1 AS once
  FROM kinds, steps),
counted AS (
  SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails AND once), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, filter)
SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM counted
"""

SEARCH_SQL = r"""
WITH terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, corpus GROUP BY term),
asked AS (
  SELECT DISTINCT item_row, item_id, term FROM (
    SELECT item_row, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item_row, item_id, coalesce(text, '') AS text FROM benchmark))),
scored AS (
  SELECT item_row, item_id, tf.row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes ON sizes.row = tf.row, corpus GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
