"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, url FROM pages),
d AS (SELECT page_id, url, strlen(body) AS n, sha256(body) AS h FROM p),
f AS (SELECT h, min(page_id) AS of FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN of IS NULL OR of = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN of <> page_id THEN of END AS refers_to, url
FROM d LEFT JOIN f USING (h)"""

OP3 = f"""
WITH n AS (SELECT doc_id, sha256({_NORM}) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h)"""

OP4 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
r AS (SELECT conv_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
             string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '') OVER (w ROWS UNBOUNDED PRECEDING) AS s
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
full_ AS (SELECT s, min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS n_copies FROM r WHERE k = n GROUP BY s)
SELECT conv_id, n_turns, n_copies, s AS rendered FROM full_ WHERE s NOT IN (SELECT s FROM r WHERE k < n)"""

# CRC-32: the table follows from the polynomial; a text's bytes are folded over it
OP5 = """
WITH tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) x(i)),
b AS (SELECT doc_id, coalesce(source, NULL) AS source, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, source, strlen(text) + 1 AS size,
             xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
                 lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS crc
      FROM b, tab),
s AS (SELECT *, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS shuffle FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY shuffle, doc_id NULLS FIRST, crc, size) - 1 AS k, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM s),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * k + 1)::DOUBLE / (2 * n), shuffle, doc_id NULLS FIRST, crc, size, source) - 1 AS pos FROM r)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, (pos * 8 // total)::INT AS shard,
       (pos - (pos * 8 // total * total + 7) // 8)::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM p"""

OP10 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[k : k + least(len(ws), 10) - 1], ' ') AS gram
      FROM i, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) u(k) WHERE len(ws) > 0),
lengths AS (SELECT DISTINCT n FROM g),
d AS (SELECT doc_id, k, n, array_to_string(ws[k : k + n - 1], ' ') AS gram FROM w, lengths, unnest(range(1, len(ws) - n + 2)) u(k)),
hits AS (SELECT doc_id, k, d.n AS n, item_id FROM d JOIN g ON d.gram = g.gram AND d.n = g.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + n)) u(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hits GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


# every kept term of a language against every group of it, without leaving out those of count 0
OP11 = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT lang, source, r, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS in_lang FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS in_source FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (in_source + v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (total + 1)) // (in_lang + v)::HUGEINT AS q
      FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT g.lang, g.source, o.source AS item, coalesce(f, 0)::BIGINT AS value FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
         LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = o.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pair
      UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM term)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200"""


OP12 = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, a.label = b.label AS same, b.id AS id, list_dot_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor, id AS positive, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
r AS (SELECT p.anchor, p.positive, p.score AS positive_score, s.id, s.score, row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INT AS rank, id AS negative_id, positive_score, score AS negative_score FROM r WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2, "op3_exact_dedup": OP3, "op4_chat_format": OP4, "op5_sharding": OP5, "op10_decontamination": OP10, "op11_source_divergence": OP11, "op12_hard_negatives": OP12}
