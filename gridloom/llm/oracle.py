"""DuckDB SQL for the queries of this package that SQL can express."""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM f
"""

OP9 = """
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
             THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule FROM b)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM c
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT r.doc_id, e.b FROM reach r JOIN near e ON e.a = r.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
              FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN win ON win.n = dw.n AND win.win = dw.win),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

OP11 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(lang, '') AS part,
                  coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS words FROM t),
m AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                 + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) THEN 4 ELSE 0 END
                 + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN again THEN 16 ELSE 0 END AS mask,
                 count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
          FROM w LEFT JOIN m ON m.doc_id = w.doc_id GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT p.c || q.c || r.c || s.c || u.c AS filter_order FROM l p, l q, l r, l s, l u
      WHERE len(list_distinct([p.c, q.c, r.c, s.c, u.c])) = 5),
st AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
              1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
              CAST(list_sum([0] || [1 << (ascii(substr(filter_order, CAST(i AS INT), 1)) - 65) FOR i IN range(1, step)]) AS INT) AS before
       FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (SELECT part, filter_order, step, letter,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM cells, st GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""

# crc32 of the decimal id, bit by bit, as DuckDB has no such function
_CRC = """xor(list_reduce(CAST([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)) AS BIGINT[]),
       lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP13 = f"""
WITH t AS (SELECT conv_id, turn, CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '') AS k,
                  length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, CAST({_CRC} % 6 AS INT) AS h, list({{'k': md5(k), 'n': chars}} ORDER BY turn NULLS FIRST, md5(k)) AS ts
      FROM t GROUP BY conv_id),
r AS (SELECT a.conv_id, coalesce(b.ts[1:a.h], []) || a.ts[a.h + 1:] AS ts
      FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (SELECT conv_id, d, len(ts) AS total, CASE WHEN d > 0 THEN ts[d].n ELSE 0 END AS chars,
             md5(array_to_string([x.k FOR x IN ts[1:d]], ',')) AS node,
             CASE WHEN d > 0 THEN md5(array_to_string([x.k FOR x IN ts[1:d - 1]], ',')) END AS up
      FROM (SELECT conv_id, ts, CAST(unnest(range(0, len(ts) + 1)) AS INT) AS d FROM r)),
n AS (SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
             max(total) = d AS leaf, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = d), '') AS ends
      FROM p GROUP BY node, d),
k AS (SELECT up, count(*) AS n_children FROM n GROUP BY up),
below AS (SELECT p.node, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
          FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.node)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       below.n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN below ON below.node = n.node LEFT JOIN k ON k.up = n.node LEFT JOIN n u ON u.node = n.up
"""

ORACLE: dict[str, str] = {"op2_ngram_join": OP2, "op8_decontamination": OP8,
                          "op7_warc": OP7, "op9_url_filter": OP9, "op11_filter_audit": OP11,
                          "op13_prefix_trie": OP13}
