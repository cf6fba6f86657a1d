"""What must not grow faster than the input: writes, moves and hash tables."""

from pyspark.sql import functions as F

from helpers import corpus
from lexisieve import session
from lexisieve.operators import changes as chg
from lexisieve.operators import dictionary as dic
from lexisieve.operators import index as idx
from lexisieve.operators import search as srch
from lexisieve.plans import catalog
from lexisieve.schemas import CHANGE_LOG
from lexisieve.sources import snapshots as S


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _documents(spark, folder):
    rows = [(1, "trash a", "s"), (2, "B c", "s"), (3, None, "s"), (4, "ouen", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(2, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "u", "x y"), (2, "u", "w z")], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


def test_id_searches_write_no_path_index(spark, scratch):
    catalog._stored.clear()
    folder = _documents(spark, scratch)
    assert [r["path"] for r in catalog.q_search_any_ids(spark, folder).collect()] == ["s/1", "t/4"]
    assert not catalog._stored


def test_lookups_in_small_tables_do_not_move_the_probe(spark):
    c = corpus(spark, [("p", "a b"), ("q", "b c"), ("none", None)])
    rows = dic.tokenized(c)
    words, docs = dic.word_table(rows), dic.doc_table(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dic.lookup_values(dic.lookup_values(dic.id_postings(rows, words, docs), words, "word_id"), docs, "doc_id")
        assert "SortMergeJoin" not in _plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ids = dic.id_postings(rows, words, docs).select("word_id", "doc_id")
    got = dic.lookup_values(dic.lookup_values(ids, words, "word_id"), docs, "doc_id")
    assert sorted((r["path"], r["word"]) for r in got.collect()) == [("p", "a"), ("p", "b"), ("q", "b"), ("q", "c")]


def test_rescan_writes_its_texts_once(spark, scratch, monkeypatch):
    written = []
    monkeypatch.setattr(catalog, "materialize", lambda df, name: written.append(name) or session.materialize(df, name))
    got = sorted(map(tuple, catalog.q_folder_rescan(spark, _documents(spark, scratch)).collect()))
    assert got == [("s/1", "a"), ("s/1", "trash"), ("t/4", "ouen"), ("u", "w"), ("u", "z")]
    assert written == ["folder-changes"]


def test_small_changes_do_not_move_the_contents(spark):
    manifest = "path string, length long, modified timestamp, hash string"
    files = spark.createDataFrame([("a", 1, None, bytearray(b"x")), ("b", 1, None, bytearray(b"y")), (None, 1, None, bytearray(b"z"))],
                                  "path string, length long, modified timestamp, content binary")
    before = S.snapshot(files.where("path = 'b'")).unionByName(spark.createDataFrame([("c", 1, None, "h")], manifest))
    got = [tuple(r) for r in S.folder_changes(before, files).orderBy("seq").collect()]
    assert got == [(1, "ADD", None, None), (2, "ADD", "a", "x"), (3, "REMOVE", "c", None)]


def test_lone_rows_skip_the_shuffle_of_words(spark):
    log = spark.createDataFrame([(1, "ADD", "one", "a b a"), (2, "ADD", "two", "a"), (3, "REINDEX", "two", "c"), (4, "ADD", "x", "d"),
                                 (5, "REMOVE", "x", None), (6, "ADD", "x", "e"), (7, "REMOVE", "y", None)], CHANGE_LOG)
    live = chg.apply_changes(log, lone=True)
    assert sorted(map(tuple, chg.apply_changes(log).collect())) == sorted(map(tuple, live.collect()))
    assert sorted(map(tuple, live.collect())) == [("one", "a"), ("one", "b"), ("two", "c"), ("x", "e")]
    assert live._jdf.queryExecution().optimizedPlan().toString().splitlines()[0].startswith("Union")


def test_hash_tables_of_a_batch_hold_a_dealt_part(spark, monkeypatch):
    seen, post = [], idx.doc_words(corpus(spark, [(f"d{i}", "a b") for i in range(40)]), unique_paths=True)
    queries = spark.createDataFrame([(i, srch.SEARCH_ANY, ["a", "b", "no"], None) for i in range(3)],
                                    "req_id long, cmd string, words array<string>, error string")
    monkeypatch.setattr(session, "TASK_ROWS", 8)

    def deal(df, rows, *keys):
        seen.append((rows, session.deal(df, rows, *keys)))
        return seen[-1][1]
    monkeypatch.setattr(srch, "deal", deal)
    assert srch.batch_search(post, queries).count() == 120
    (rows, dealt), = seen
    assert rows == 240 and dealt.rdd.getNumPartitions() == 30


def test_repeated_paths_are_dealt_before_they_are_made_distinct(spark):
    words = idx.doc_words(corpus(spark, [("p", "a b"), ("p", "b c"), ("q", "a")]))
    assert sorted(map(tuple, words.collect())) == [("p", "a"), ("p", "b"), ("p", "c"), ("q", "a")]
    tree = words._jdf.queryExecution().sparkPlan().toString() + _plan(words)
    assert "REPARTITION_BY_NUM" in tree and "ENSURE_REQUIREMENTS" not in tree
