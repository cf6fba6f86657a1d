"""Request lines in, response lines out, for a whole table of requests.

Response text (fixed format): ``OK n``, the n paths one per line in byte
order, ``END``; no hit gives ``OK 0`` / ``END``. Errors are one line:
``ERROR Missing word for SEARCH_ONE``, ``ERROR No words provided``,
``ERROR Unknown command``. Commands are case-sensitive.

Responses are produced as line rows (req_id, part, line), part 0 = status,
1 = a path, 2 = END; ordering by (req_id, part, line) gives the exact text.
No response is ever gathered into one value, so one request matching a
large share of the corpus still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.text import lower_ascii, query_tokens
from lexisieve.operators.search import SEARCH_ALL, SEARCH_ANY, SEARCH_ONE, batch_search
from lexisieve.session import materialize

# Response texts.
ERR_MISSING_WORD = "ERROR Missing word for SEARCH_ONE"
ERR_NO_WORDS = "ERROR No words provided"
ERR_UNKNOWN = "ERROR Unknown command"
END = "END"


def parse_requests(requests: DataFrame, line_col: str = "request") -> DataFrame:
    """(req_id, request) -> (req_id, cmd, words ARRAY<STRING>, error).

    SEARCH_ONE keeps only its first word (R6); words are lower-cased A-Z
    only and otherwise left as typed (R5).
    """
    toks = query_tokens(line_col)
    cmd = F.get(toks, 0)
    # Lower-casing A-Z never touches white space, so the lowered line splits
    # into the same pieces; the command is taken from the raw line.
    low = query_tokens(lower_ascii(line_col))
    rest = F.slice(low, 2, F.greatest(F.size(low) - 1, F.lit(1)))
    rest = F.when(F.size(low) > 1, rest).otherwise(F.array().cast("array<string>"))
    words = F.when(cmd == SEARCH_ONE, F.slice(rest, 1, 1)).otherwise(rest)
    known = cmd.isin(SEARCH_ONE, SEARCH_ALL, SEARCH_ANY)
    error = (F.when(~known | cmd.isNull(), F.lit(ERR_UNKNOWN))
             .when((cmd == SEARCH_ONE) & (F.size(rest) == 0), F.lit(ERR_MISSING_WORD))
             .when(F.size(rest) == 0, F.lit(ERR_NO_WORDS)))
    return requests.select("req_id", F.when(known, cmd).alias("cmd"),
                           F.when(known, words).alias("words"), error.alias("error"))


def render_responses(parsed: DataFrame, hits: DataFrame) -> DataFrame:
    """Parsed requests + (req_id, path) hits -> response lines.

    ``hits`` feeds both the status counts and the path lines. The join is
    null-safe: a request without an id keeps its hits, and the two sub-plans
    stay identical, so the search runs once and its exchange is reused."""
    counts = hits.groupBy("req_id").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("req_id", "_req")
    heads = parsed.join(counts, F.col("req_id").eqNullSafe(F.col("_req")), "left").select(
        "req_id", F.lit(0).cast("bigint").alias("part"),
        F.coalesce(F.col("error"), F.concat(F.lit("OK "), F.coalesce("_n", F.lit(0)).cast("string"))).alias("line"))
    body = hits.select("req_id", F.lit(1).cast("bigint").alias("part"), F.col("path").alias("line"))
    ends = parsed.where(F.col("error").isNull()).select(
        "req_id", F.lit(2).cast("bigint").alias("part"), F.lit(END).alias("line"))
    return heads.unionByName(body).unionByName(ends)


def run_requests(postings: DataFrame, requests: DataFrame, line_col: str = "request",
                 terms: DataFrame | None = None) -> DataFrame:
    """Request lines to response lines; ``terms`` as for ``batch_search``. The
    hits are written once and read for the counts and for the lines."""
    parsed = parse_requests(requests, line_col)
    return render_responses(parsed, materialize(batch_search(postings, parsed, terms=terms), "hits"))


def write_responses(lines: DataFrame, location: str) -> None:
    """Write the concatenated response text (a distributed sort, then text)."""
    lines.orderBy("req_id", "part", "line").select("line").write.mode("errorifexists").text(location)


# Fixed value: the characters Python's str.strip() removes (str.isspace).
_PY_SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_PY_SPACE}+|{_PY_SPACE}+$", "")


def number_lines(lines: DataFrame) -> DataFrame:
    """Line numbers of the response text as written: a distributed ordinal
    over (req_id, part, line), i.e. the order ``write_responses`` writes."""
    from lexisieve.operators.ordinal import dense_ordinal

    return dense_ordinal(lines, ["req_id", "part", "line"], "line_no")


def parse_responses(lines: DataFrame, resp_col: str = "req_id", order_col: str = "line_no",
                    line_col: str = "line") -> DataFrame:
    """Client-side reading of response lines -> (resp_id, ok, path).

    Per response: blank lines are dropped and lines stripped; it is ok when
    its first line starts with ``OK``; its paths are the lines after the
    first one up to the first ``END`` (or to the end). Each response gives
    one status row (path null) and one row per path.

    ``order_col`` is a numeric line order (line numbers of the stream). The
    per-response facts are fixed-width hash aggregates (first line number,
    first END line number); the first line is fetched by an equi-join on the
    unique (response, line number); the body join on the response id is left
    to AQE's skew handling when one response holds most lines.
    """
    every = lines.select(F.col(resp_col).alias("resp_id"), F.col(order_col).alias("_no"),
                         _strip(F.col(line_col)).alias("_line"))
    rows = every.where(F.col("_line") != "")
    facts = rows.groupBy("resp_id").agg(
        F.min("_no").alias("_first_no"),
        F.min(F.when(F.col("_line") == END, F.col("_no"))).alias("_end"))
    firsts = rows.join(facts.withColumnRenamed("_first_no", "_no"), ["resp_id", "_no"], "inner").select(
        "resp_id", F.col("_no").alias("_first_no"), "_end", F.col("_line").startswith("OK").alias("ok"))
    body = rows.join(firsts.where("ok"), "resp_id", "inner").where(
        (F.col("_no") > F.col("_first_no")) & (F.col("_end").isNull() | (F.col("_no") < F.col("_end"))))
    paths = body.select("resp_id", F.lit(True).alias("ok"), F.col("_line").alias("path"))
    # One status for every response, also for one of blank lines only (not ok).
    known = firsts.select(F.col("resp_id").alias("_id"), F.col("ok").alias("_ok"))
    status = every.select("resp_id").distinct().join(known, F.col("resp_id").eqNullSafe(F.col("_id")), "left").select(
        "resp_id", F.coalesce("_ok", F.lit(False)).alias("ok"), F.lit(None).cast("string").alias("path"))
    return status.unionByName(paths)


def parse_response_text(c: Column | str) -> Column:
    """The same reading for a response held as one string (per row):
    struct(ok BOOLEAN, paths ARRAY<STRING>)."""
    col = F.col(c) if isinstance(c, str) else c
    lines = F.split(col, "\\r\\n|[\\n\\r\\x0B\\f\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]")
    lines = F.filter(F.transform(lines, lambda x: _strip(x)), lambda x: x != "")
    ok = F.coalesce(F.get(lines, 0).startswith("OK"), F.lit(False))
    tail = F.when(F.size(lines) > 1, F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1)))) \
        .otherwise(F.array().cast("array<string>"))
    stop = F.array_position(tail, END)
    paths = F.when(stop > 0, F.slice(tail, 1, (stop - 1).cast("int"))).otherwise(tail)
    paths = F.when(stop == 1, F.array().cast("array<string>")).otherwise(paths)
    return F.struct(ok.alias("ok"), F.when(ok, paths).otherwise(F.array().cast("array<string>")).alias("paths"))
