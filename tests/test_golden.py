"""Golden edge cases, one or more per rule R1-R20 (FIXTURES.md section 3)."""

from __future__ import annotations

from helpers import corpus, log, pairs, paths, requests, responses
from lexisieve.functions.text import tokens
from lexisieve.operators import changes as chg
from lexisieve.operators import index as idx
from lexisieve.operators import search as srch
from lexisieve.plans import requests as rq

KELVIN = "\u212a"  # Kelvin sign: lower() would fold it to k


def _words(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(tokens("text").alias("w")).first()["w"]


def _run(spark, docs, lines):
    post = idx.doc_words(corpus(spark, docs))
    return responses(rq.run_requests(post, requests(spark, lines)))


def test_r1_words_are_ascii_alnum_runs(spark):
    assert _words(spark, "café2x, A_b-9") == ["caf", "2x", "a", "b", "9"]
    assert _words(spark, "...") == []


def test_r2_only_ascii_letters_are_lowered(spark):
    assert _words(spark, KELVIN) == []
    out = _run(spark, [("d", "k")], [f"SEARCH_ONE {KELVIN}"])
    assert out[1] == "OK 0\nEND\n"


def test_r4_postings_are_sets(spark):
    post = idx.doc_words(corpus(spark, [("p", "a a A")]))
    assert pairs(post) == [("p", "a")]


def test_r5_query_words_are_not_tokenised(spark):
    assert _run(spark, [("d", "re do")], ["SEARCH_ONE re-do"])[1] == "OK 0\nEND\n"
    assert _run(spark, [("d", "hello")], ["SEARCH_ONE HELLO"])[1] == "OK 1\nd\nEND\n"


def test_r6_search_one_uses_first_word(spark):
    assert _run(spark, [("d", "a")], ["SEARCH_ONE a b"])[1] == "OK 1\nd\nEND\n"


def test_r7_and(spark):
    docs = [("d", "a")]
    out = _run(spark, docs, ["SEARCH_ALL a zzz", "SEARCH_ALL a a"])
    assert out[1] == "OK 0\nEND\n"
    assert out[2] == "OK 1\nd\nEND\n"


def test_r8_or_skips_unknown(spark):
    assert _run(spark, [("d", "a")], ["SEARCH_ANY zzz a"])[1] == "OK 1\nd\nEND\n"


def test_r10_byte_order(spark):
    docs = [("b", "x"), ("B", "x"), ("é", "x"), ("z", "x")]
    post = idx.doc_words(corpus(spark, docs))
    assert paths(srch.search_one(post, "x")) == ["B", "b", "z", "é"]
    assert _run(spark, docs, ["SEARCH_ONE x"])[1] == "OK 4\nB\nb\nz\né\nEND\n"


def _found(spark, rows, word):
    return paths(srch.search_one(chg.apply_changes(log(spark, rows)), word))


def test_r11_add_twice_keeps_old_words(spark):
    rows = [("ADD", "p", "a"), ("ADD", "p", "b")]
    assert _found(spark, rows, "a") == ["p"]
    assert _found(spark, rows, "b") == ["p"]


def test_r12_reindex_drops_current_set_only(spark):
    rows = [("ADD", "p", "a"), ("REINDEX", "p", "b")]
    assert pairs(chg.apply_changes(log(spark, rows))) == [("p", "b")]
    rows = [("ADD", "p", "a"), ("ADD", "p", "b"), ("REINDEX", "p", "c")]
    assert pairs(chg.apply_changes(log(spark, rows))) == [("p", "a"), ("p", "c")]


def test_r13_reindex_unknown_is_add(spark):
    assert _found(spark, [("REINDEX", "p", "a")], "a") == ["p"]


def test_r14_unreadable_changes_nothing(spark):
    lg = log(spark, [("ADD", "p", "a"), ("REINDEX", "p", None)])
    assert pairs(chg.apply_changes(lg)) == [("p", "a")]
    out = {r["seq"]: r["outcome"] for r in chg.change_outcomes(lg).collect()}
    assert out == {10: True, 20: False}


def test_r15_remove_unknown_is_false(spark):
    out = chg.change_outcomes(log(spark, [("REMOVE", "p", None)])).collect()
    assert [r["outcome"] for r in out] == [False]


def test_r16_empty_document_is_registered(spark):
    lg = log(spark, [("ADD", "p", "")])
    probe = spark.createDataFrame([("p",)], "path string")
    r = chg.has_file(probe, lg).first()
    assert r["has_file"] is True and r["doc_id"] == 1
    assert pairs(chg.apply_changes(lg)) == []


def _ids(spark, rows):
    return {r["path"]: r["doc_id"] for r in chg.live_documents(log(spark, rows)).collect()}


def test_r17_ids_never_recycle_until_clear(spark):
    rows = [("ADD", "p", "x"), ("ADD", "q", "x"), ("REMOVE", "p", None), ("ADD", "p", "x")]
    assert _ids(spark, rows) == {"q": 2, "p": 3}
    rows = [("ADD", "p", "x"), ("CLEAR", None, None), ("ADD", "q", "x")]
    assert _ids(spark, rows) == {"q": 1}


def test_r18_removed_words_keep_ids(spark):
    lg = log(spark, [("ADD", "p", "a"), ("REMOVE", "p", None)])
    assert {r["word"]: r["word_id"] for r in chg.log_word_table(lg).collect()} == {"a": 1}
    assert pairs(chg.apply_changes(lg)) == []


def test_r19_word_ids_first_seen(spark):
    lg = log(spark, [("ADD", "p", "b a"), ("ADD", "q", "c a")])
    assert {r["word"]: r["word_id"] for r in chg.log_word_table(lg).collect()} == {"b": 1, "a": 2, "c": 3}


def test_r20_paths_are_exact(spark):
    lg = log(spark, [("ADD", "x/p", "a")])
    probe = spark.createDataFrame([("x/../x/p",), ("x/p",)], "path string")
    got = {r["path"]: r["has_file"] for r in chg.has_file(probe, lg).collect()}
    assert got == {"x/../x/p": False, "x/p": True}


def test_error_lines(spark):
    out = _run(spark, [("d", "a")], ["SEARCH_ONE", "SEARCH_ALL", "search_one a", "HAS_FILE p", "", "SEARCH_ANY  \t "])
    assert out[1] == "ERROR Missing word for SEARCH_ONE\n"
    assert out[2] == "ERROR No words provided\n"
    assert out[3] == out[4] == out[5] == "ERROR Unknown command\n"
    assert out[6] == "ERROR No words provided\n"


def test_parse_responses_rows_and_text(spark):
    docs = [("d1", "a b"), ("d2", "a")]
    post = idx.doc_words(corpus(spark, docs))
    lines = rq.run_requests(post, requests(spark, ["SEARCH_ONE a", "SEARCH_ALL zzz", "NOPE"]))
    got = sorted((r["resp_id"], r["ok"], r["path"] or "")
                 for r in rq.parse_responses(rq.number_lines(lines)).collect())
    assert got == [(1, True, ""), (1, True, "d1"), (1, True, "d2"), (2, True, ""), (3, False, "")]
    texts = spark.createDataFrame(
        [("OK 2\nx\n  y \nEND\nz\n",), ("\n\nOK\n",), ("ERROR Unknown command\n",), ("OK 1\r\nq",)], "t string")
    parsed = [r["r"] for r in texts.select(rq.parse_response_text("t").alias("r")).collect()]
    assert [(p["ok"], p["paths"]) for p in parsed] == [
        (True, ["x", "y"]), (True, []), (False, []), (True, ["q"])]


def test_binary_files_as_corpus(spark, scratch):
    import os

    from lexisieve.sources.corpus import binary_corpus

    with open(os.path.join(scratch, "a.txt"), "wb") as f:
        f.write(b"H\xffI Caf\xc3\xa9")
    with open(os.path.join(scratch, "b.txt"), "wb") as f:
        f.write("AB".encode("utf-16-le"))
    c = binary_corpus(spark, scratch)
    got = {os.path.basename(r["path"]): r["w"] for r in c.select("path", tokens("text").alias("w")).collect()}
    assert got == {"a.txt": ["h", "i", "caf"], "b.txt": ["a", "b"]}
    assert sorted(r["seq"] for r in c.collect()) == [1, 2]


def test_bucketed_postings_prune(spark, scratch):
    post = idx.doc_words(corpus(spark, [("d1", "alpha beta"), ("d2", "beta gamma"), ("d3", "gamma")]))
    loc = scratch + "/postings"
    idx.write_postings(post, loc, buckets=8)
    stored = idx.read_postings(spark, loc)
    q = srch.search_one(stored, "Gamma", buckets=8)
    assert paths(q) == ["d2", "d3"]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan
    assert paths(srch.search_all(stored, ["beta", "gamma"], buckets=8)) == ["d2"]
    # the stored bucket count is used even when the caller passes another one
    assert idx.stored_buckets(stored) == 8
    assert paths(srch.search_one(stored, "alpha", buckets=64)) == ["d1"]
    assert idx.suggest_buckets(10 * 1024 ** 4) == 65536 and idx.suggest_buckets(1) == 16
    parsed = rq.parse_requests(requests(spark, ["SEARCH_ANY alpha gamma", "SEARCH_ALL beta alpha"]))
    got = sorted((r["req_id"], r["path"]) for r in srch.batch_search(stored, parsed, buckets=8).collect())
    assert got == [(1, "d1"), (1, "d2"), (1, "d3"), (2, "d1")]


def test_response_sink_writes_reference_text(spark, scratch):
    post = idx.doc_words(corpus(spark, [("d2", "a b"), ("d1", "a")]))
    lines = rq.run_requests(post, requests(spark, ["SEARCH_ANY a", "SEARCH_ALL b zzz", "SEARCH_ONE"]))
    rq.write_responses(lines, scratch + "/out")
    import glob

    parts = sorted(glob.glob(scratch + "/out/part-*"))
    text = "".join(open(p).read() for p in parts)
    assert text == "OK 2\nd1\nd2\nEND\nOK 0\nEND\nERROR Missing word for SEARCH_ONE\n"


def test_logs_have_unique_seq(spark):
    from lexisieve.sources.corpus import conversation_changes

    assert chg.duplicate_seqs(conversation_changes(spark, "/root/testdata/sf0.01")).count() == 0
    dup = log(spark, [("ADD", "p", "a")]).unionByName(log(spark, [("ADD", "q", "b")]))
    assert chg.duplicate_seqs(dup).count() == 2


def test_forward_replace_sets_word_sets(spark):
    post = idx.doc_words(corpus(spark, [("p", "a b"), ("q", "b c")]))
    new = idx.doc_words(corpus(spark, [("p", "d")]))
    assert pairs(idx.forward_replace(post, new)) == [("p", "d"), ("q", "b"), ("q", "c")]
    empty_q = spark.createDataFrame([("q",)], "path string")
    assert pairs(idx.forward_replace(post, new.where("false"), empty_q)) == [("p", "a"), ("p", "b")]


def test_parse_response_lines_client_rules(spark):
    """Blank lines, stripping, no END, a first line that is not OK."""
    rows = [(1, 1, "  "), (1, 2, " OK 2 "), (1, 3, "x"), (1, 4, ""), (1, 5, "y "), (1, 6, "END"), (1, 7, "z"),
            (2, 1, "OK"), (2, 2, "a"), (2, 3, "b"),
            (3, 1, "ERROR Unknown command"), (3, 2, "p"),
            (4, 1, "END"), (4, 2, "OK 1")]
    df = spark.createDataFrame(rows, "req_id bigint, line_no bigint, line string")
    got = sorted((r["resp_id"], r["ok"], r["path"] or "") for r in rq.parse_responses(df).collect())
    assert got == [(1, True, ""), (1, True, "x"), (1, True, "y"), (2, True, ""), (2, True, "a"),
                   (2, True, "b"), (3, False, ""), (4, False, "")]


def test_batch_search_large_request_tables(spark, monkeypatch):
    """The same hits when the request words cannot be broadcast (vocabulary
    semi join, then shuffle join) and when neither can (plain shuffle join)."""
    docs = [("d1", "a b c"), ("d2", "b c"), ("d3", "c d"), ("d4", "")]
    post = idx.doc_words(corpus(spark, docs))
    lines = ["SEARCH_ALL b c", "SEARCH_ANY a d zzz", "SEARCH_ONE c a", "SEARCH_ALL c zzz", "NOPE x"]
    parsed = rq.parse_requests(requests(spark, lines))

    def hits():
        return sorted((r["req_id"], r["path"]) for r in srch.batch_search(post, parsed).collect())

    want = [(1, "d1"), (1, "d2"), (2, "d1"), (2, "d3"), (3, "d1"), (3, "d2"), (3, "d3")]
    assert hits() == want
    monkeypatch.setattr(srch, "REQUEST_WORDS_BROADCAST_ROWS", 0)
    assert hits() == want
    monkeypatch.setattr(srch, "VOCABULARY_BROADCAST_ROWS", 0)
    assert hits() == want


def test_doc_table_skips_unreadable_and_keeps_empty(spark):
    from lexisieve.operators import dictionary as dic

    c = corpus(spark, [("p", "a"), ("bad", None), ("e", ""), ("p", "b")])
    assert sorted((r["doc_id"], r["path"]) for r in dic.doc_table(c).collect()) == [(1, "p"), (2, "e")]
    stats = idx.index_stats(idx.doc_words(c), c).first()
    assert (stats["n_documents"], stats["n_words"], stats["n_postings"]) == (2, 2, 2)


def test_empty_inputs(spark):
    from lexisieve.operators import dictionary as dic
    from lexisieve.schemas import CHANGE_LOG, CORPUS, REQUESTS

    empty_corpus = spark.createDataFrame([], CORPUS)
    empty_log = spark.createDataFrame([], CHANGE_LOG)
    assert dic.word_table(empty_corpus).count() == 0
    assert dic.doc_table(empty_corpus).count() == 0
    assert chg.apply_changes(empty_log).count() == 0
    assert chg.live_documents(empty_log).count() == 0
    assert chg.change_outcomes(empty_log).count() == 0
    assert chg.compact_log(empty_log).count() == 0
    post = idx.doc_words(corpus(spark, [("d", "a")]))
    parsed = rq.parse_requests(spark.createDataFrame([], REQUESTS))
    assert srch.batch_search(post, parsed).count() == 0
    assert rq.run_requests(post, spark.createDataFrame([], REQUESTS)).count() == 0
    only_clear = log(spark, [("CLEAR", None, None)])
    assert chg.apply_changes(only_clear).count() == 0
    assert [r["outcome"] for r in chg.change_outcomes(only_clear).collect()] == [None]
