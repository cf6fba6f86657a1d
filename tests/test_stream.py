"""Stream ingest equals batch apply_changes, over several micro-batches and a restart."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lexisieve.operators.changes import apply_changes
from lexisieve.sources.corpus import conversation_changes, document_corpus
from lexisieve.streaming import merge_producers, read_log, stream_changes, stream_ingest


def _pairs(df):
    return {(r["path"], r["word"]) for r in df.collect()}


def _write_parts(log, folder, k):
    """The log cut into k files by seq rank (files land in one folder)."""
    parts = log.withColumn("_part", F.pmod(F.xxhash64("seq"), F.lit(k)))
    for i in range(k):
        parts.where(F.col("_part") == i).drop("_part").write.parquet(f"{folder}/part{i}")


def test_stream_equals_batch(spark, scratch):
    log = conversation_changes(spark, SF_SMALL)
    expected = _pairs(apply_changes(log))
    src = f"{scratch}/src"
    _write_parts(log, src, 4)
    for k in (1, 2):
        out = f"{scratch}/run{k}"
        changes = stream_changes(spark, f"{src}/*", max_files_per_trigger=k)
        q = stream_ingest(changes, f"{out}/log", f"{out}/ckpt")
        q.awaitTermination()
        assert len(list(q.recentProgress)) >= 4 // k
        assert _pairs(apply_changes(read_log(spark, f"{out}/log"))) == expected


def test_stream_restart_resumes(spark, scratch):
    log = conversation_changes(spark, SF_SMALL)
    expected = _pairs(apply_changes(log))
    staged = f"{scratch}/staged"
    _write_parts(log, staged, 4)
    src, out = f"{scratch}/src", f"{scratch}/out"
    first = spark.read.parquet(f"{staged}/part0", f"{staged}/part1")
    first.write.parquet(f"{src}/a")
    q = stream_ingest(stream_changes(spark, f"{src}/*"), f"{out}/log", f"{out}/ckpt")
    q.awaitTermination()
    rest = spark.read.parquet(f"{staged}/part2", f"{staged}/part3")
    rest.write.parquet(f"{src}/b")
    q = stream_ingest(stream_changes(spark, f"{src}/*"), f"{out}/log", f"{out}/ckpt")
    q.awaitTermination()
    assert read_log(spark, f"{out}/log").count() == log.count()
    assert _pairs(apply_changes(read_log(spark, f"{out}/log"))) == expected


def test_merge_producers_keeps_every_row(spark):
    a = spark.range(0, 50).select(F.col("id").alias("value"))
    b = spark.range(100, 150).select(F.col("id").alias("value"))
    m = merge_producers(a, b)
    got = sorted((r["producer"], r["value"]) for r in m.collect())
    assert got == [(1, v) for v in range(50)] + [(2, v) for v in range(100, 150)]
    assert document_corpus(spark, SF_SMALL).count() > 0


def test_incremental_index_equals_batch(spark, scratch):
    from lexisieve.streaming import latest_postings, stream_index

    for mode in ("mixed", "clear"):
        log = conversation_changes(spark, SF_SMALL, mode)
        expected = _pairs(apply_changes(log))
        src = f"{scratch}/{mode}/src"
        _write_parts(log, src, 3)  # rows of one path land in different, out-of-order batches
        out = f"{scratch}/{mode}/out"
        q = stream_index(stream_changes(spark, f"{src}/*", max_files_per_trigger=1), out, f"{out}/ckpt", compact_every=2)
        q.awaitTermination()
        assert len(list(q.recentProgress)) >= 3
        got = latest_postings(spark, out)
        assert "bucket" in got.columns
        assert _pairs(got) == expected


def test_merge_producers_as_streams(spark, scratch):
    """Two producers' file streams, one consumer: the log holds every row of
    both, each tagged with its producer."""
    log = conversation_changes(spark, SF_SMALL)
    docs = document_corpus(spark, SF_SMALL).select("seq", F.lit("ADD").alias("op"), "path", "text")
    log.write.parquet(f"{scratch}/p1/a")
    docs.write.parquet(f"{scratch}/p2/a")
    merged = merge_producers(stream_changes(spark, f"{scratch}/p1/*"), stream_changes(spark, f"{scratch}/p2/*"))
    q = (merged.writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out")
    got = sorted((r["producer"], r["seq"], r["path"]) for r in out.collect())
    want = sorted([(1, r["seq"], r["path"]) for r in log.collect()] + [(2, r["seq"], r["path"]) for r in docs.collect()])
    assert got == want


def _run_batches(spark, tmp_path, batches, compact_every=32):
    """Each list of rows as one file and one micro-batch; (stream, batch) postings."""
    from lexisieve.operators.changes import apply_changes
    from lexisieve.schemas import CHANGE_LOG
    from lexisieve.streaming import latest_postings, stream_changes, stream_index

    src, out = str(tmp_path / "in"), str(tmp_path / "index")
    for rows in batches:
        spark.createDataFrame(rows, CHANGE_LOG).coalesce(1).write.mode("append").parquet(src)
        stream_index(stream_changes(spark, src), out, f"{out}/ckpt", compact_every=compact_every).awaitTermination()
    log = spark.createDataFrame([r for rows in batches for r in rows], CHANGE_LOG)
    got = sorted((r["path"], r["word"]) for r in latest_postings(spark, out).collect())
    return got, sorted((r["path"], r["word"]) for r in apply_changes(log).select("path", "word").collect())


def test_clear_with_a_path_reaches_later_batches(spark, tmp_path):
    first = [(1, "ADD", "p", "a"), (2, "ADD", "q", "b"), (4, "CLEAR", "x", None), (5, "ADD", "z", "z")]
    got, want = _run_batches(spark, tmp_path, [first, [(6, "ADD", "p", "c")], [(3, "ADD", "q", "late")],
                                               [(7, "REMOVE", "z", None)]])
    assert got == want == [("p", "c")]


def test_empty_batches_and_an_empty_index(spark, tmp_path):
    got, want = _run_batches(spark, tmp_path, [[(1, "ADD", "p", "...")], [], [(2, "ADD", "p", "a")],
                                               [(3, "REMOVE", "p", None)], [(4, "CLEAR", None, None)]])
    assert got == want == []


def test_compaction_keeps_the_index(spark, tmp_path):
    batches = [[(10 * k + i, "ADD", f"d{i % 3}", f"w{k}{i}") for i in range(4)] for k in range(4)]
    got, want = _run_batches(spark, tmp_path, batches, compact_every=2)
    assert got == want and got


def test_rows_without_op_request_id_or_text_stay(spark):
    from lexisieve.operators.changes import change_outcomes
    from lexisieve.plans.requests import parse_responses, render_responses
    from lexisieve.schemas import CHANGE_LOG

    log = spark.createDataFrame([(1, "ADD", "p", "a"), (2, None, "p", "b"), (3, "REMOVE", "p", None)], CHANGE_LOG)
    assert sorted(r["seq"] for r in change_outcomes(log).collect()) == [1, 2, 3]
    parsed = spark.createDataFrame([(None, "SEARCH_ONE", ["a"], None)], "req_id long, cmd string, words array<string>, error string")
    hits = spark.createDataFrame([(None, "p")], "req_id long, path string")
    assert sorted(r["line"] for r in render_responses(parsed, hits).collect()) == ["END", "OK 1", "p"]
    lines = spark.createDataFrame([(1, 1, "  "), (2, 2, "OK 1"), (2, 3, "p"), (2, 4, "END")], "req_id long, line_no long, line string")
    got = {(r["resp_id"], r["ok"], r["path"]) for r in parse_responses(lines).collect()}
    assert got == {(1, False, None), (2, True, None), (2, True, "p")}


def test_and_requests_make_no_rows_for_common_words(spark):
    from lexisieve.operators.search import batch_search

    rows = [(f"d{i}", "common") for i in range(2000)] + [("d7", "rare"), ("d9", "rare"), ("d9", "other")]
    postings = spark.createDataFrame(rows + [("d9", "other")], "path string, word string")
    asked = [(1, "SEARCH_ALL", ["common", "rare"], None), (2, "SEARCH_ALL", ["common", "unknown"], None),
             (3, "SEARCH_ANY", ["rare", "other"], None), (4, "SEARCH_ALL", ["rare", "other", "common"], None),
             (5, "SEARCH_ALL", ["other", "unknown"], None)]
    queries = spark.createDataFrame(asked, "req_id long, cmd string, words array<string>, error string")
    got = sorted((r["req_id"], r["path"]) for r in batch_search(postings, queries).collect())
    assert got == [(1, "d7"), (1, "d9"), (3, "d7"), (3, "d9"), (4, "d9")]


def test_search_on_the_streamed_index_prunes(spark, scratch):
    """Filters on bucket and word reach every segment; no join is in the plan;
    the term statistics agree with the postings."""
    from lexisieve.operators.search import search_all, search_one
    from lexisieve.streaming import latest_postings, latest_terms, stream_index

    log = conversation_changes(spark, SF_SMALL)
    src, out = f"{scratch}/src", f"{scratch}/out"
    for i in range(5):
        log.where(F.pmod(F.xxhash64("seq"), F.lit(5)) == i).coalesce(1).write.parquet(f"{src}/part{i}")
    stream_index(stream_changes(spark, f"{src}/*", max_files_per_trigger=1), out, f"{out}/ckpt", compact_every=4,
                 buckets=8).awaitTermination()
    expected = _pairs(apply_changes(log))
    word = max(sorted({w for _, w in expected}), key=lambda x: sum(w == x for _, w in expected))
    live = latest_postings(spark, out)
    found = search_one(live, word)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [In(word" in plan or "EqualTo(word" in plan or "word IN" in plan
    assert "Join" not in plan
    assert [r["path"] for r in found.collect()] == sorted(p for p, w in expected if w == word)
    assert search_all(live, [word, "nosuchword"]).count() == 0
    counts = {}
    for _, w in expected:
        counts[w] = counts.get(w, 0) + 1
    assert {r["word"]: r["n_docs"] for r in latest_terms(spark, out).collect()} == counts


def test_levels_stay_few_and_deltas_small(spark, tmp_path):
    """Six batches at fan-out 2 leave one segment a level; reading writes
    nothing."""
    import os

    from lexisieve.schemas import CHANGE_LOG
    from lexisieve.streaming import latest_postings, stream_index
    from lexisieve.streaming.levels import manifest

    src, out = str(tmp_path / "in"), str(tmp_path / "index")
    rows = [[(100 * k + i, "REINDEX" if k % 2 else "ADD", f"d{(k * 7 + i) % 40}", f"w{k} w{i} common") for i in range(10)]
            for k in range(6)]
    for k, batch in enumerate(rows):
        spark.createDataFrame(batch, CHANGE_LOG).coalesce(1).write.parquet(f"{src}/b{k}")
    q = stream_index(stream_changes(spark, f"{src}/*", max_files_per_trigger=1), out, f"{out}/ckpt", compact_every=2, buckets=2)
    q.awaitTermination()
    buckets, segments = manifest(spark, out)
    levels = [n for _, n in segments]
    assert buckets == 2 and sorted(levels) == [1, 2]
    before = sorted(os.listdir(f"{out}/versions"))
    want = _pairs(apply_changes(spark.createDataFrame([r for b in rows for r in b], CHANGE_LOG)))
    assert _pairs(latest_postings(spark, out)) == want
    assert sorted(os.listdir(f"{out}/versions")) == before


def test_replayed_producers_leave_each_row_once(spark, scratch):
    """A producer that starts anew sends its rows again, some twice in one
    batch; another goes on. A batch that is run again changes nothing."""
    from lexisieve.streaming import read_merged, stream_merge
    from lexisieve.streaming.ingest import _append_once

    def feed(i, seqs):
        spark.createDataFrame([(s, "ADD", f"p{i}", str(s)) for s in seqs], log_schema).coalesce(1) \
            .write.mode("append").parquet(f"{scratch}/in{i}")

    def run():
        producers = [stream_changes(spark, f"{scratch}/in{i}") for i in (1, 2)]
        stream_merge(merge_producers(*producers), f"{scratch}/m", f"{scratch}/ckpt").awaitTermination()
        return sorted((r["producer"], r["seq"]) for r in read_merged(spark, f"{scratch}/m").collect())

    log_schema = "seq long, op string, path string, text string"
    feed(1, range(5))
    feed(2, [7, 9])
    assert run() == [(1, s) for s in range(5)] + [(2, 7), (2, 9)]
    feed(1, [*range(8), *range(8)])
    feed(2, [10])
    want = [(1, s) for s in range(8)] + [(2, 7), (2, 9), (2, 10)]
    assert run() == want
    again = spark.createDataFrame([(1, s, "ADD", "p1", str(s)) for s in range(8)] + [(2, 10, "ADD", "p2", "10")],
                                  "producer long, " + log_schema)
    _append_once(f"{scratch}/m")(again, 1)
    assert sorted((r["producer"], r["seq"]) for r in read_merged(spark, f"{scratch}/m").collect()) == want


def test_streamed_outcomes_equal_batch(spark, scratch):
    """Late rows and a late CLEAR change outcomes that were written before."""
    from lexisieve.operators.changes import change_outcomes
    from lexisieve.schemas import CHANGE_LOG
    from lexisieve.streaming import emitted_outcomes, latest_outcomes, stream_outcomes

    batches = [[(10, "ADD", "p", "a"), (30, "REMOVE", "p", None), (31, "REMOVE", "q", None), (32, "ADD", None, "x")],
               [(20, "REMOVE", "p", None), (25, "REINDEX", "q", "b"), (40, "ADD", "p", None)],
               [(33, "ADD", "r", "c"), (35, "REMOVE", "r", None)],
               [(34, "CLEAR", None, None)]]
    rows, seen = [], {}
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, CHANGE_LOG).coalesce(1).write.parquet(f"{scratch}/in/{k}")
        stream_outcomes(stream_changes(spark, f"{scratch}/in/*"), f"{scratch}/o", f"{scratch}/ckpt").awaitTermination()
        rows += batch
        got = sorted(map(tuple, latest_outcomes(spark, f"{scratch}/o").collect()))
        assert got == sorted(map(tuple, change_outcomes(spark.createDataFrame(rows, CHANGE_LOG)).collect()))
        seen[k] = {r["seq"]: r["outcome"] for r in emitted_outcomes(spark, f"{scratch}/o").where(F.col("batch_id") == k).collect()}
    assert seen[1] == {20: True, 25: True, 30: False, 31: True, 40: False}  # 30 and 31 again
    assert seen[3] == {34: None, 35: False}
