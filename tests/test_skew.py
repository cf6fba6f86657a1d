"""A hot path holding a third of the change log: results still match the
closed form in DuckDB, and the hot path is spread over bounded blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from lexisieve.operators import changes as chg
from lexisieve.plans import oracle
from lexisieve.sources.corpus import conversation_changes
from tools.check_oracle import duck

HOT = "(CASE WHEN conv_id % 3 = 0 THEN 'conv/hot' ELSE 'conv/' || CAST(conv_id AS VARCHAR) END)"


def _hot_log(spark, mode):
    log = conversation_changes(spark, SF_ORACLE, mode)
    conv = (F.col("seq") / 1000).cast("bigint")
    return log.withColumn("path", F.when(conv % 3 == 0, F.lit("conv/hot")).otherwise(F.col("path")))


def _sql(mode: str, body: str) -> str:
    cte = oracle.conv_log(mode).replace("'conv/' || CAST(conv_id AS VARCHAR)", HOT)
    return "WITH " + cte + ",\n" + body


def test_hot_path_matches_closed_form(spark, monkeypatch):
    monkeypatch.setattr(chg, "BLOCK_ROWS", 16)
    con = duck(SF_ORACLE)
    for mode in ("mixed", "clear"):
        log = _hot_log(spark, mode)
        hot_rows = log.where(F.col("path") == "conv/hot").count()
        assert hot_rows * 4 > log.count()  # about a third of the log
        got = {(r["path"], r["word"]) for r in chg.apply_changes(log).collect()}
        want = set(con.sql(_sql(mode, oracle.APPLY)).fetchall())
        assert got == want and any(p == "conv/hot" for p, _ in got)
        docs = {(r["doc_id"], r["path"]) for r in chg.live_documents(log).collect()}
        assert docs == set(con.sql(_sql(mode, oracle.LIVE + "\nSELECT doc_id, path FROM LIVE")).fetchall())
    # the hot path is cut into many bounded blocks
    rows = _hot_log(spark, "mixed").select("path", "seq", "op")
    blocks = chg._with_blocks(rows, ["path"], None)
    per_block = blocks.groupBy("path", "_blk").count()
    hot = per_block.where(F.col("path") == "conv/hot")
    assert hot.count() > 4
    assert per_block.agg(F.max("count")).first()[0] <= 8 * 16


def test_hot_word_in_a_large_batch(spark, monkeypatch):
    """One word in all requests and a third of all documents, with a request
    side too large to broadcast: the salted join deals it evenly."""
    from pyspark.sql import functions as F

    from lexisieve.operators import search as srch

    n = 3000
    rows = spark.range(n).select(F.concat(F.lit("d"), "id").alias("path"), F.explode(F.array(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("cold"), F.col("id") % 50)),
        F.concat(F.lit("own"), F.col("id") % 400))).alias("word"))
    queries = spark.range(60).select(
        F.col("id").alias("req_id"), F.when(F.col("id") % 2 == 0, F.lit("SEARCH_ANY")).otherwise(F.lit("SEARCH_ALL")).alias("cmd"),
        F.array(F.lit("hot"), F.concat(F.lit("own"), F.col("id"))).alias("words"), F.lit(None).cast("string").alias("error"))
    want = sorted(map(tuple, srch.batch_search(rows, queries).collect()))
    monkeypatch.setattr(srch, "HOT_DOCS", 20)
    for name in ("REQUEST_WORDS_BROADCAST_ROWS", "VOCABULARY_BROADCAST_ROWS"):
        monkeypatch.setattr(srch, name, 0)
    assert sorted(map(tuple, srch.batch_search(rows, queries).collect())) == want
    by_id = {}
    for r, p in want:
        by_id.setdefault(r, set()).add(p)
    assert all(len(by_id[r]) > n // 3 for r in by_id if r % 2 == 0)

    known = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))
    probe = queries.select("req_id", F.explode("words").alias("word"))
    for side in srch.salted(rows, probe, known):
        tasks = side.groupBy(F.pmod(F.hash("word", "_salt"), F.lit(24)).alias("task")).count().collect()
        sizes = sorted(r["count"] for r in tasks)
        assert len(sizes) >= 20 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
