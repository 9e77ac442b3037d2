"""The same results in DuckDB SQL, where SQL can express them."""

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_bundles"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
m AS (SELECT *, strlen(payload) AS n, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM m
"""

ORACLE["warc_contents"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
m AS (SELECT *, strlen(payload) AS n, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, url, n::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM m
WHERE n < 100 OR page_id IS NOT DISTINCT FROM first OR first IS NULL
"""

ORACLE["op4_host_reputation"] = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
             AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
outcomes AS (
  SELECT doc_id AS page_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)),
counted AS (
  SELECT p.host, count(o.page_id)::DOUBLE AS n, coalesce(sum(o.bad), 0)::DOUBLE AS bad
  FROM parts p LEFT JOIN outcomes o USING (page_id) GROUP BY p.host),
bare AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS b, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS s
         FROM counted),
named AS (
  SELECT *, CASE WHEN regexp_full_match(b, '[0-9.]+') OR contains(b, '[') THEN b
                 WHEN len(s[-1]) = 2 AND len(s) > 1 AND s[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')
                 THEN s[-2] || '.' || s[-1] ELSE s[-1] END AS suffix
  FROM bare),
hosts AS (
  SELECT *, CASE WHEN len(b) > len(suffix) + 1
                 THEN string_split(substr(b, 1, len(b) - len(suffix) - 1), '.')[-1] || '.' || suffix ELSE b END AS domain
  FROM named),
whole AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS m FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT m FROM whole) AS m FROM hosts GROUP BY suffix),
sm AS (SELECT sum((bad - n * m) * (bad - n * m)) AS spread, sum(n * m * (1 - m)) AS chance,
              sum(n * (n - 1) * m * (1 - m)) AS pairs FROM s0),
sk AS (SELECT CASE WHEN coalesce(pairs, 0) = 0 OR (spread - chance) / pairs <= 1 / 1001.0 THEN 1000.0
                   ELSE greatest(2.0, 1 / least((spread - chance) / pairs, 1.0) - 1) END AS k FROM sm),
s1 AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM s0, sk),
d0 AS (SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(s1.m) AS m
       FROM hosts h JOIN s1 USING (suffix) GROUP BY h.domain, h.suffix),
dm AS (SELECT sum((bad - n * m) * (bad - n * m)) AS spread, sum(n * m * (1 - m)) AS chance,
              sum(n * (n - 1) * m * (1 - m)) AS pairs FROM d0),
dk AS (SELECT CASE WHEN coalesce(pairs, 0) = 0 OR (spread - chance) / pairs <= 1 / 1001.0 THEN 1000.0
                   ELSE greatest(2.0, 1 / least((spread - chance) / pairs, 1.0) - 1) END AS k FROM dm),
d1 AS (SELECT domain, (bad + k * m) / (n + k) AS m FROM d0, dk),
h0 AS (SELECT h.host, h.n, h.bad, d1.m FROM hosts h JOIN d1 USING (domain)),
hm AS (SELECT sum((bad - n * m) * (bad - n * m)) AS spread, sum(n * m * (1 - m)) AS chance,
              sum(n * (n - 1) * m * (1 - m)) AS pairs FROM h0),
hk AS (SELECT CASE WHEN coalesce(pairs, 0) = 0 OR (spread - chance) / pairs <= 1 / 1001.0 THEN 1000.0
                   ELSE greatest(2.0, 1 / least((spread - chance) / pairs, 1.0) - 1) END AS k FROM hm),
h1 AS (SELECT host, (bad + k * m) / (n + k) AS share, n + k AS total FROM h0, hk),
judged AS (SELECT host, share - 1.645 * sqrt(share * (1 - share) / (total + 1)) > 0.3 AS blocked FROM h1),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY len(h || p) DESC LIMIT 1) AS rule,
       coalesce((SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                 ORDER BY len(h || p) DESC LIMIT 1), CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parts JOIN judged USING (host)
"""

ORACLE["op9_sorted_list_search"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON len(q.v) = len(c.v) AND q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE["op2_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS size, words[i : i + least(len(words), 13) - 1] AS win
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM w),
pos AS (
  SELECT row_no, size, i AS start, words[i : i + size - 1] AS win
  FROM d, sizes, LATERAL (SELECT unnest(range(1, greatest(len(words) - size + 2, 1))) AS i)),
held AS (SELECT pos.row_no, pos.start, pos.size, w.item_id FROM pos JOIN w ON pos.size = w.size AND pos.win = w.win),
hit AS (
  SELECT row_no, count(DISTINCT word) AS n_hit
  FROM (SELECT row_no, unnest(range(start, start + size)) AS word FROM (SELECT DISTINCT row_no, start, size FROM held))
  GROUP BY row_no),
items AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item FROM held WHERE item_id IS NOT NULL) GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (row_no) LEFT JOIN items USING (row_no)
"""

ORACLE["op12_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT conv_id,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h
  FROM turns),
lent AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h),
own AS (SELECT t.conv_id, t.pos + 1000000000 AS pos, t.role, t.text FROM turns t JOIN convs c USING (conv_id) WHERE t.pos > c.h),
rebuilt AS (SELECT * FROM lent UNION ALL SELECT * FROM own),
paths AS (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT depth, path[:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends
  FROM prefixes GROUP BY 1, 2),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[:n.depth] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND n.depth > 0 AND n.prefix[:n.depth - 1] = p.prefix),
below AS (
  SELECT a.depth, a.conv_id, sum((b.n_children = 0)::INT) AS n_leaves,
         sum((b.n_convs - 1) * CASE WHEN b.depth = 0 THEN 0 ELSE strlen(b.prefix[-1].text) END) AS saved
  FROM linked a JOIN linked b ON b.depth >= a.depth AND b.prefix[:a.depth] = a.prefix GROUP BY 1, 2)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs, l.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN below b USING (depth, conv_id)
"""

ORACLE["op13_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
         list_sum([x[1] * x[2] FOR x IN list_zip(a.v, b.v)])::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS n FROM pairs WHERE same QUALIFY n <= 5),
met AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 5
"""
