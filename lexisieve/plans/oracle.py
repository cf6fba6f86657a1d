"""Reference answers in DuckDB SQL, one per registered query.

Written independently of the Spark plans, and where it helps in another
form: relational division with NOT EXISTS for AND, correlated look-ups of
the next row instead of ``lead`` for the change log, global ``row_number``
instead of distributed ordinals. Tables are the pre-registered views.
"""

from __future__ import annotations

UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LO = "abcdefghijklmnopqrstuvwxyz"
WORD = "'[A-Za-z0-9]+'"

D = "D AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) AS path, doc_id AS seq, text FROM documents)"
P = "P AS (SELECT url AS path, page_id AS seq, html AS text FROM pages)"


def postings(name: str, src: str) -> str:
    return (f"{name} AS (SELECT DISTINCT path, lower(w) AS word "
            f"FROM {src}, unnest(regexp_extract_all({src}.text, {WORD})) AS t(w))")


DW = postings("DW", "D")
PW = postings("PW", "P")
TOXIC = "TOX AS (SELECT D.path FROM D JOIN labels l ON l.doc_id = D.seq WHERE l.toxic = 1)"

REQ = f"""RQ AS (SELECT item_id AS req_id,
        (CASE item_id % 4 WHEN 0 THEN 'SEARCH_ONE' WHEN 1 THEN 'SEARCH_ALL'
                          WHEN 2 THEN 'SEARCH_ANY' ELSE 'FIND' END)
        || ' ' || regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g') AS request FROM benchmark),
RT AS (SELECT req_id, list_filter(string_split_regex(request, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS toks FROM RQ),
PR AS (SELECT req_id,
        CASE WHEN toks[1] IN ('SEARCH_ONE', 'SEARCH_ALL', 'SEARCH_ANY') THEN toks[1] END AS cmd,
        list_transform(CASE WHEN toks[1] = 'SEARCH_ONE' THEN toks[2:2]
                            WHEN toks[1] IN ('SEARCH_ALL', 'SEARCH_ANY') THEN toks[2:] END,
                       lambda x: translate(x, '{UP}', '{LO}')) AS words,
        CASE WHEN toks[1] IS NULL OR toks[1] NOT IN ('SEARCH_ONE', 'SEARCH_ALL', 'SEARCH_ANY')
               THEN 'ERROR Unknown command'
             WHEN len(toks) < 2 AND toks[1] = 'SEARCH_ONE' THEN 'ERROR Missing word for SEARCH_ONE'
             WHEN len(toks) < 2 THEN 'ERROR No words provided' END AS error
      FROM RT),
QW AS (SELECT DISTINCT req_id, cmd, unnest(words) AS word FROM PR WHERE error IS NULL),
QV AS (SELECT DISTINCT word FROM QW)"""


_LINE = "' ' || regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')"
REQ_PASSAGES = REQ.replace(_LINE, "CASE WHEN item_id % 8 < 2 THEN '' ELSE ' ' || text END")


# What differs between the documents and their later state.
FOLDER = """FC AS (
  SELECT path, 'REMOVE' AS op, NULL AS text FROM D WHERE path IN (SELECT path FROM TOX)
  UNION ALL SELECT path, 'REINDEX', '*' || text || '*' FROM D WHERE path NOT IN (SELECT path FROM TOX) AND seq % 7 = 0
  UNION ALL SELECT path, 'ADD', min(text) FROM P GROUP BY path)"""


def hits(name: str, post: str) -> str:
    """Relational division for AND, plain join for OR."""
    return f"""{name} AS (
  SELECT DISTINCT q.req_id, p.path FROM QW q JOIN {post} p ON p.word = q.word
  WHERE q.cmd = 'SEARCH_ANY'
     OR NOT EXISTS (SELECT 1 FROM QW q2 WHERE q2.req_id = q.req_id
                    AND NOT EXISTS (SELECT 1 FROM {post} p2 WHERE p2.path = p.path AND p2.word = q2.word)))"""


def lines(name: str, hit: str) -> str:
    return f"""{name} AS (
  SELECT PR.req_id, CAST(0 AS BIGINT) AS part,
         COALESCE(error, 'OK ' || CAST((SELECT count(*) FROM {hit} h WHERE h.req_id = PR.req_id) AS VARCHAR)) AS line
  FROM PR
  UNION ALL SELECT req_id, CAST(1 AS BIGINT), path FROM {hit}
  UNION ALL SELECT req_id, CAST(2 AS BIGINT), 'END' FROM PR WHERE error IS NULL)"""


# First sightings (seq, position in the full token list) and dense ids.
def first_seen(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT word, seq, pos FROM (
    SELECT word, seq, pos, row_number() OVER (PARTITION BY word ORDER BY seq, pos) AS rn FROM (
      SELECT seq, lower(unnest(l)) AS word, generate_subscripts(l, 1) AS pos
      FROM (SELECT seq, regexp_extract_all(text, {WORD}) AS l FROM {src} WHERE text IS NOT NULL)))
  WHERE rn = 1)"""


WT = first_seen("FS", "D") + ",\nWT AS (SELECT CAST(row_number() OVER (ORDER BY seq, pos) AS BIGINT) AS word_id, word FROM FS)"
DT = "DT AS (SELECT CAST(row_number() OVER (ORDER BY seq, path) AS BIGINT) AS doc_id, path FROM (SELECT path, min(seq) AS seq FROM D GROUP BY path))"

CONV_OP = ("CASE WHEN (conv_id + turn) % 5 = 4 THEN 'REMOVE' WHEN role = 'assistant' THEN 'REINDEX' "
           "ELSE 'ADD' END")
CONV = (f"M AS (SELECT conv_id * 1000 + turn AS seq, {CONV_OP} AS op, "
        f"'conv/' || CAST(conv_id AS VARCHAR) AS path, text FROM conversations)")


def conv_log(mode: str) -> str:
    if mode == "mixed":
        return CONV + ",\nL AS (SELECT * FROM M)"
    if mode == "add":
        return CONV + ",\nL AS (SELECT seq, 'ADD' AS op, path, text FROM M)"
    if mode == "reindex":
        return CONV + ",\nL AS (SELECT seq, 'REINDEX' AS op, path, text FROM M)"
    if mode == "clear":
        return CONV + (",\nL AS (SELECT seq, CASE WHEN seq = (SELECT quantile_disc(seq, 0.5) FROM M) "
                       "THEN 'CLEAR' ELSE op END AS op, path, text FROM M)")
    raise ValueError(mode)


ADD_REMOVE_LOG = f"""{D}, {TOXIC},
L AS (SELECT seq * 2 AS seq, 'ADD' AS op, path, text FROM D
      UNION ALL SELECT seq * 2 + 1, 'REMOVE', path, NULL FROM D WHERE path IN (SELECT path FROM TOX))"""

# Rows after the last CLEAR that act, and each path's last REMOVE.
EFFECTIVE = """E AS (SELECT * FROM L
      WHERE ((SELECT max(seq) FROM L WHERE op = 'CLEAR') IS NULL OR seq > (SELECT max(seq) FROM L WHERE op = 'CLEAR'))
        AND path IS NOT NULL AND (op = 'REMOVE' OR (op IN ('ADD', 'REINDEX') AND text IS NOT NULL))),
LR AS (SELECT path, max(seq) FILTER (WHERE op = 'REMOVE') AS lr FROM E GROUP BY path),
LIFE AS (SELECT E.* FROM E JOIN LR USING (path) WHERE (lr IS NULL OR E.seq > lr) AND op <> 'REMOVE')"""

LIVE_POSTINGS = f"""{EFFECTIVE},
LW AS (SELECT DISTINCT path, seq, lower(w) AS word FROM LIFE, unnest(regexp_extract_all(LIFE.text, {WORD})) AS t(w)),
LAST AS (SELECT path, word, max(seq) AS s FROM LW GROUP BY path, word),
LP AS (SELECT x.path, x.word FROM LAST x
  WHERE NOT EXISTS (SELECT 1 FROM LIFE r WHERE r.path = x.path AND r.op = 'REINDEX'
                    AND r.seq = (SELECT min(r2.seq) FROM LIFE r2 WHERE r2.path = x.path AND r2.seq > x.s)))"""

APPLY = LIVE_POSTINGS + "\nSELECT path, word FROM LP"

COMPACT = LIVE_POSTINGS + f""",
ENDS AS (SELECT path, min(seq) AS first_seq, max(seq) AS last_seq FROM LIFE GROUP BY path),
LASTR AS (SELECT LIFE.path, ENDS.first_seq, LIFE.seq, LIFE.text FROM LIFE JOIN ENDS
          ON LIFE.path = ENDS.path AND LIFE.seq = ENDS.last_seq),
CUR AS (SELECT DISTINCT path, lower(w) AS word FROM LASTR, unnest(regexp_extract_all(LASTR.text, {WORD})) AS t(w)),
LEFTOVER AS (SELECT LP.path, string_agg(LP.word, ' ' ORDER BY LP.word) AS text FROM LP
             WHERE NOT EXISTS (SELECT 1 FROM CUR c WHERE c.path = LP.path AND c.word = LP.word) GROUP BY LP.path)
SELECT ENDS.first_seq AS seq, 'ADD' AS op, LEFTOVER.path, LEFTOVER.text FROM LEFTOVER JOIN ENDS USING (path)
UNION ALL
SELECT seq, 'ADD', path, text FROM LASTR"""

LIVE = f"""{EFFECTIVE},
ST AS (SELECT e.path, e.seq FROM E e WHERE e.op <> 'REMOVE'
       AND COALESCE((SELECT arg_max(e2.op, e2.seq) FROM E e2 WHERE e2.path = e.path AND e2.seq < e.seq), 'REMOVE') = 'REMOVE'),
SN AS (SELECT CAST(row_number() OVER (ORDER BY seq) AS BIGINT) AS doc_id, path, seq FROM ST),
LIVE AS (SELECT SN.doc_id, SN.path FROM SN JOIN LR USING (path) WHERE lr IS NULL OR SN.seq > lr)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {
    # 2.1
    "scan_corpus": _w(D, P) + "SELECT path, seq, text FROM D UNION ALL SELECT path, seq, text FROM P",
    "scan_files": _w(D, DW) + "SELECT path, word FROM DW",
    "folder_changes": _w(D, P, TOXIC, FOLDER) + """SELECT row_number() OVER (ORDER BY path) AS seq, op, path,
CASE WHEN op <> 'REMOVE' THEN text END AS text FROM FC""",
    "folder_rescan": _w(D, P, TOXIC, FOLDER, """FX AS (SELECT path, text FROM D WHERE path NOT IN (SELECT path FROM FC)
  UNION ALL SELECT path, text FROM FC WHERE op <> 'REMOVE')""") + """SELECT DISTINCT path, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS word FROM FX""",
    "parse_requests": _w(REQ) + ("SELECT req_id, cmd, array_to_string(words, ' ') AS words, "
                                 "CAST(len(words) AS BIGINT) AS n_words, error FROM PR"),
    "render_responses": _w(P, PW, REQ, hits("H", "PW"), lines("LN", "H")) + "SELECT req_id, part, line FROM LN",
    "run_requests": _w(D, DW, REQ, hits("H", "DW"), lines("LN", "H")) + "SELECT req_id, part, line FROM LN",
    "run_passages": _w(D, DW, REQ_PASSAGES, hits("H", "DW"), lines("LN", "H")) + "SELECT req_id, part, line FROM LN",
    "parse_responses": _w(D, DW, REQ, hits("H", "DW"), lines("LN", "H")) + """,
R AS (SELECT req_id AS resp_id, part, s AS line,
             row_number() OVER (PARTITION BY req_id ORDER BY part, s) AS rn
      FROM (SELECT req_id, part, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS s FROM LN) WHERE s <> ''),
F AS (SELECT resp_id, bool_or(rn = 1 AND starts_with(line, 'OK')) AS ok,
             min(rn) FILTER (WHERE line = 'END') AS end_rn FROM R GROUP BY resp_id)
SELECT resp_id, ok, CAST(NULL AS VARCHAR) AS path FROM F
UNION ALL
SELECT R.resp_id, true, R.line FROM R JOIN F USING (resp_id)
WHERE F.ok AND R.rn > 1 AND (F.end_rn IS NULL OR R.rn < F.end_rn)""",
    # 2.2
    "lower_ascii": _w(D) + f"SELECT path, translate(text, '{UP}', '{LO}') AS text FROM D",
    "alnum_chars": _w(D) + ("SELECT path, CAST(length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS BIGINT) "
                            "AS n_alnum FROM D"),
    "tokenize": _w(D) + (f"SELECT path, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, lower(unnest(l)) AS word "
                         f"FROM (SELECT path, regexp_extract_all(text, {WORD}) AS l FROM D)"),
    "doc_words": _w(D, DW) + "SELECT path, word FROM DW",
    # 2.3
    "word_table": _w(D, WT) + "SELECT word_id, word FROM WT",
    "doc_table": _w(D, DT) + "SELECT doc_id, path FROM DT",
    "word_table_extend": _w(D, P, WT, first_seen("FP", "P")) + """SELECT word_id, word FROM WT
UNION ALL
SELECT CAST((SELECT max(word_id) FROM WT) + row_number() OVER (ORDER BY seq, pos) AS BIGINT), word
FROM FP WHERE word NOT IN (SELECT word FROM WT)""",
    "lookup_ids": _w(D, WT, REQ) + "SELECT QV.word, WT.word_id FROM QV JOIN WT ON WT.word = QV.word",
    "lookup_values": _w(D, DW, WT, DT) + ("SELECT DT.doc_id, WT.word_id, DW.path, DW.word FROM DW "
                                          "JOIN WT ON WT.word = DW.word JOIN DT ON DT.path = DW.path"),
    "has_id": _w(D, DT, TOXIC) + ("SELECT doc_id, path NOT IN (SELECT path FROM TOX) AS has_id FROM DT"),
    "has_value": _w(D, WT, REQ) + "SELECT word, word IN (SELECT word FROM WT) AS has_value FROM QV",
    "remove_by_id": _w(D, DT, TOXIC) + "SELECT doc_id, path FROM DT WHERE path NOT IN (SELECT path FROM TOX)",
    "remove_by_value": _w(D, WT, REQ) + "SELECT word_id, word FROM WT WHERE word NOT IN (SELECT word FROM QV)",
    "dictionary_size": _w(D, WT, DT) + ("SELECT 'word_table' AS name, count(*) AS size FROM WT "
                                        "UNION ALL SELECT 'doc_table', count(*) FROM DT"),
    "dictionary_store": _w(D, P, TOXIC) + """, U AS (SELECT path, min(seq) AS seq FROM P GROUP BY path),
N AS (SELECT (SELECT count(*) FROM D) AS d, (SELECT count(*) FROM U) AS u),
I AS (SELECT path, row_number() OVER (ORDER BY seq) AS id FROM D)
SELECT id, path FROM I WHERE path NOT IN (SELECT path FROM TOX)
UNION ALL SELECT d + row_number() OVER (ORDER BY seq), path FROM U, N
UNION ALL SELECT d + u + row_number() OVER (ORDER BY id), path FROM I, N WHERE path IN (SELECT path FROM TOX)""",
    # 2.4
    "forward_index": _w(D, DW) + ("SELECT path, count(*) AS n_words, string_agg(word, ' ' ORDER BY word) AS words "
                                  "FROM DW GROUP BY path"),
    "forward_add": _w(D, P, DW, PW) + "SELECT path, word FROM DW UNION SELECT path, word FROM PW",
    "forward_replace": _w(D, DW, TOXIC, REQ) + ("SELECT path, word FROM DW WHERE path NOT IN (SELECT path FROM TOX) "
                                                "OR word IN (SELECT word FROM QV)"),
    "forward_lookup": _w(D, DW) + ("SELECT path, word FROM DW WHERE path IN "
                                   "(SELECT D.path FROM D JOIN labels l ON l.doc_id = D.seq WHERE l.quality = 1)"),
    "forward_remove": _w(D, DW, TOXIC) + "SELECT path, word FROM DW WHERE path NOT IN (SELECT path FROM TOX)",
    "index_stats": _w(D, DW) + ("SELECT (SELECT count(DISTINCT path) FROM D) AS n_documents, "
                                "count(DISTINCT word) AS n_words, count(*) AS n_postings FROM DW"),
    # 2.5
    "inverted_index": _w(D, DW) + "SELECT word, path FROM DW",
    "term_statistics": _w(D, DW) + "SELECT word, count(*) AS n_docs FROM DW GROUP BY word",
    "postings_merge": _w(D, P, DW, PW) + "SELECT path, word FROM DW UNION SELECT path, word FROM PW",
    "postings_lookup": _w(D, DW, REQ) + "SELECT DW.word, DW.path FROM DW WHERE DW.word IN (SELECT word FROM QV)",
    "postings_remove": _w(D, DW, TOXIC, REQ) + ("SELECT path, word FROM DW WHERE NOT "
                                                "(path IN (SELECT path FROM TOX) AND word IN (SELECT word FROM QV))"),
    "has_word": _w(D, DW, TOXIC, REQ) + ("SELECT word, word IN (SELECT word FROM DW WHERE path NOT IN "
                                         "(SELECT path FROM TOX)) AS has_word FROM QV"),
    # 2.6
    "has_file": _w(conv_log("mixed"), LIVE) + ("SELECT p.path, LIVE.doc_id IS NOT NULL AS has_file, LIVE.doc_id "
                                               "FROM (SELECT DISTINCT path FROM L) p LEFT JOIN LIVE USING (path)"),
    "changes_add": _w(conv_log("add"), APPLY),
    "changes_reindex": _w(conv_log("reindex"), APPLY),
    "changes_remove": _w(ADD_REMOVE_LOG, APPLY),
    "changes_clear": _w(conv_log("clear"), APPLY),
    "apply_changes": _w(conv_log("mixed"), APPLY),
    "compact_log": _w(conv_log("clear"), COMPACT),
    "live_documents": _w(conv_log("mixed"), LIVE) + "SELECT doc_id, path FROM LIVE",
    "change_outcomes": _w(conv_log("clear")) + """,
EP AS (SELECT l.*, (SELECT count(*) FROM L c WHERE c.op = 'CLEAR' AND c.seq < l.seq) AS epoch FROM L l),
AC AS (SELECT * FROM EP WHERE path IS NOT NULL
       AND (op = 'REMOVE' OR (op IN ('ADD', 'REINDEX') AND text IS NOT NULL)))
SELECT x.seq, x.op, x.path,
  CASE WHEN x.op IN ('ADD', 'REINDEX') THEN x.text IS NOT NULL AND x.path IS NOT NULL
       WHEN x.op = 'REMOVE' THEN COALESCE((SELECT arg_max(a.op, a.seq) FROM AC a WHERE a.path = x.path
                                           AND a.epoch = x.epoch AND a.seq < x.seq) IN ('ADD', 'REINDEX'), false)
  END AS outcome
FROM EP x""",
    # 2.7
    "search_one": _w(D, DW) + "SELECT path FROM DW WHERE word = 'license'",
    "search_all": _w(D, DW) + ("SELECT path FROM DW WHERE word IN ('the', 'nicht', 'zu') GROUP BY path "
                               "HAVING count(*) = 3"),
    "search_any": _w(D, DW) + "SELECT DISTINCT path FROM DW WHERE word IN ('schst', 'ouen', 'trash', 'café')",
    "postings_intersect": _w(D, DW) + ("SELECT path FROM DW WHERE word = 'nicht' INTERSECT "
                                       "SELECT path FROM DW WHERE word = 'zu'"),
    "postings_union": _w(D, DW) + ("SELECT path FROM DW WHERE word = 'license' UNION "
                                   "SELECT path FROM DW WHERE word = 'trash'"),
    "resolve_sorted": _w(D, DW, DT, TOXIC) + ("SELECT DT.doc_id, DT.path FROM DW JOIN DT USING (path) "
                                              "WHERE DW.word = 'license' AND DT.path NOT IN (SELECT path FROM TOX)"),
    "search_one_ids": _w(D, DW) + "SELECT path FROM DW WHERE word = 'license'",
    "search_all_ids": _w(D, DW) + ("SELECT path FROM DW WHERE word IN ('the', 'nicht', 'zu') GROUP BY path "
                               "HAVING count(*) = 3"),
    "search_any_ids": _w(D, DW) + "SELECT DISTINCT path FROM DW WHERE word IN ('schst', 'ouen', 'trash', 'café')",
    "batch_search": _w(D, DW, REQ, hits("H", "DW")) + "SELECT req_id, path FROM H",
    # 2.8
    "merge_producers": _w(CONV, D) + ("SELECT CAST(1 AS BIGINT) AS producer, seq, op, path, text FROM M "
                                      "UNION ALL SELECT CAST(2 AS BIGINT), seq, 'ADD', path, text FROM D"),
    "stream_merge": _w(CONV, D) + ("SELECT CAST(1 AS BIGINT) AS producer, seq, op, path, text FROM M "
                                   "UNION ALL SELECT CAST(2 AS BIGINT), seq, 'ADD', path, text FROM D"),
    "stream_ingest": _w(conv_log("mixed"), APPLY),
    "stream_index": _w(conv_log("mixed"), APPLY),
    "stream_search": f"""WITH I AS ({_w(conv_log("mixed"), APPLY)}),
V AS (SELECT word, row_number() OVER (ORDER BY word) AS n FROM ({_w(REQ)} SELECT word FROM QV)),
A AS (SELECT a.n, a.word AS x, b.word AS y FROM V a JOIN V b ON b.n = a.n + 1)
SELECT 2 * n AS req_id, i.path FROM A JOIN I i ON i.word = x JOIN I j ON j.word = y AND j.path = i.path
UNION ALL SELECT DISTINCT 2 * n + 1, path FROM A JOIN I ON word IN (x, y)""",
}
SQL["stream_outcomes"] = SQL["change_outcomes"]
