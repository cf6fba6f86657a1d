"""The id form equals the path form, reads fewer bytes, and prunes."""

import os
import random

from pyspark.sql import functions as F

from helpers import corpus, paths
from lexisieve.operators import id_index as idi
from lexisieve.operators import index as idx
from lexisieve.operators import search as srch


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_id_form_equals_path_form(spark, scratch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    docs = [(f"some/long/folder/name/{i:05d}", " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(400)]
    docs += [("twice", "w1 w2"), ("twice", "w3"), ("gone", None), ("empty", "")]
    c = corpus(spark, docs)
    idx.write_index(idx.doc_words(c), f"{scratch}/path", buckets=4)
    idi.write_id_index(c, f"{scratch}/id", buckets=4)
    postings, terms = idx.read_index(spark, f"{scratch}/path")
    ids = idi.read_id_index(spark, f"{scratch}/id")
    assert ids.postings.count() == postings.count() and ids.documents.count() == 402
    assert _bytes(f"{scratch}/id/postings") < _bytes(f"{scratch}/path/postings")
    assert dict(map(tuple, ids.words.select("word", "n_docs").collect())) == dict(map(tuple, terms.select("word", "n_docs").collect()))
    assert idi.word_ids(ids, ["W3", "nosuch", ""]).keys() == {"w3"}
    for ws in (["w1"], ["W1", "w2"], ["w1", "w2", "w3"], ["w1", "nosuch"], ["nosuch"], []):
        assert paths(idi.search_all_ids(ids, ws)) == paths(srch.search_all(postings, ws))
        assert paths(idi.search_any_ids(ids, ws)) == paths(srch.search_any(postings, ws))
    assert paths(idi.search_one_ids(ids, "w7")) == paths(srch.search_one(postings, "w7"))
    assert paths(idi.search_one_ids(ids, "re-do")) == []


def test_id_search_prunes_and_reads_numbers(spark, scratch):
    idi.write_id_index(corpus(spark, [("p", "a b"), ("q", "b c")]), scratch + "/ix", buckets=4)
    plan = idi.search_one_ids(idi.read_id_index(spark, scratch + "/ix"), "b")._jdf.queryExecution().executedPlan().toString()
    part = [line for line in plan.splitlines() if "word_id" in line and "FileScan" in line]
    assert part and "PartitionFilters: [" in part[0] and "bucket" in part[0].split("PartitionFilters")[1]
    assert "path" not in part[0].split("ReadSchema")[-1]


def test_unions_do_not_move_the_base(spark, scratch):
    base = [(f"d{i}", f"w{i % 7}") for i in range(50)]
    idx.write_postings(spark.createDataFrame(base, "path string, word string"), f"{scratch}/base", buckets=2)
    stored = idx.read_postings(spark, f"{scratch}/base")
    more = spark.createDataFrame([("d1", "w1"), ("d1", "new"), ("d1", "new"), ("n", "w0")], "path string, word string")
    merged = idx.postings_merge(stored, more)
    assert sorted(map(tuple, merged.collect())) == sorted({*base, ("d1", "new"), ("n", "w0")})
    tree = merged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in tree and "SortMergeJoin" not in tree
    assert stored.select(F.col("path")).count() == 50
