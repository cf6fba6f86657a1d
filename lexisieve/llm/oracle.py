"""DuckDB SQL for the operators that SQL can express."""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = "regexp_extract_all(" + _LOWER + r", '[^\x{{0}}-\x{{2F}}\x{{3A}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')"

_OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_ALNUM.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (SELECT DISTINCT item_id, list_slice(w, i, i + 12) AS win
         FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
places AS (SELECT r, i, n, list_slice(w, i, i + n - 1) AS win
           FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT p.r, p.i, p.n, s.item_id FROM places p JOIN wins s ON p.win = s.win),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

_WORDS = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x{20}\x{09}-\x{0D}]+')"
_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
             ELSE list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4)) END) AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents
          UNION SELECT r.u, p.v FROM reach r JOIN both_ways p ON r.v = p.u)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(v) AS component_id
FROM s JOIN reach ON reach.u = s.doc_id GROUP BY s.doc_id, len(sh)
"""

_OP5 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT hex, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT), 1)), '')
        AS payload_digest, max(page_id) AS holder FROM p GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM p JOIN d USING (hex)
"""

_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x{20}\x{09}-\x{0D}]+') AS w
           FROM documents),
wins AS (SELECT r, doc_id, i, list_slice(w, i, i + 12) AS x
         FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT x, min(doc_id) AS least FROM wins GROUP BY x),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS k FROM wins JOIN firsts USING (x) WHERE doc_id > least),
left_over AS (SELECT p.r, string_agg(p.word, ' ' ORDER BY p.k) AS kept
              FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) p
              LEFT JOIN gone g ON p.r = g.r AND p.k = g.k WHERE g.k IS NULL GROUP BY p.r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r) LEFT JOIN cut USING (r)
"""

#: crc32 by its polynomial, byte by byte, over the distinct runs of a document; then the near words by equal deletions.
_OP12 = r"""
WITH RECURSIVE bits AS (SELECT 0 AS k, i AS x, i FROM range(256) t(i)
  UNION ALL SELECT k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i FROM bits WHERE k < 8),
tab AS (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS id, run, count(*) AS c
         FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) WHERE length(run) >= 6
         GROUP BY ALL),
sums AS (SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295],
           list_transform(range(0, strlen(id)), lambda i: CAST('0x' || substr(hex(encode(id)), CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
           lambda a, b: xor(a >> 8, t[1 + CAST(xor(a, b) & 255 AS INT)]))) AS h FROM runs, tab),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT))
                 || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, c FROM sums),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS x
         FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.x = b.x AND a.word <> b.word
         UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN v b ON a.x = b.word
         UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN v b ON a.x = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
g AS (SELECT f.*, (SELECT min(other) FROM near WHERE near.word = f.word AND near.m = f.form_n) AS form FROM f),
chain AS (SELECT word, word AS last_one, form AS next FROM g UNION ALL SELECT c.word, g.word, g.form FROM chain c JOIN g ON g.word = c.next)
SELECT g.word, form, last_one AS root, n, n_near, form_n FROM g JOIN chain ON chain.word = g.word AND chain.next IS NULL
"""

_OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x{20}\x{09}]+') AS w
      FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x{0A}-\x{0D}]')) AS piece FROM d)),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
grams AS (SELECT lang, m, list_slice(w, i, i + m - 1) AS g
          FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, 6) s(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, g, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, m, g, a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (SELECT c.lang, c.m, c.g, c.a, k, x.a AS l, y.a AS r, n, (1000 * c.a * n) // (x.a * y.a) AS score
           FROM cuts c JOIN totals USING (lang)
           JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
           JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, c.m)),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ones AS (SELECT DISTINCT lang, list_slice(g, i, i + q - 1) AS g, a
               FROM (SELECT lang, g, a, m, q, unnest(range(1, m - q + 2)) AS i FROM f, range(2, 5) t(q) WHERE q < m)),
kept AS (SELECT * FROM worst w WHERE NOT EXISTS (SELECT 1 FROM inner_ones o WHERE o.lang = w.lang AND o.g = w.g AND 100 * o.a >= 100 * w.a)),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

SQL = {"op5_warc_convert": _OP5, "op6_ngram_join": _OP6, "op7_decontamination": _OP7, "op11_substring_dedup": _OP11,
       "op12_spelling_groups": _OP12, "op13_collocations": _OP13}
