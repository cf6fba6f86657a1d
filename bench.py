"""Headline timings on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]. Prints one JSON line.

Each query runs once untimed (JIT warm-up), then three timed runs; the
median is reported. Results are fully materialised: small ones collected,
large ones written to the ``noop`` sink. Queries:
  index_build     documents -> postings -> bucketed Parquet (new folder)
  search_one/all/any  on the stored postings (bucket + row-group pruning)
  batch_search    every benchmark row as a request, one job, stored postings
  run_requests    same, rendered as response lines
  apply_changes   conversations change log -> live postings
  live_documents  same log -> live documents with ids
  word_table      first-seen dense word ids of the documents
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexisieve.operators import changes as chg  # noqa: E402
from lexisieve.operators import dictionary as dic  # noqa: E402
from lexisieve.operators import index as idx  # noqa: E402
from lexisieve.operators import search as srch  # noqa: E402
from lexisieve.plans import requests as rq  # noqa: E402
from lexisieve.plans.catalog import ALL_WORDS, ANY_WORDS, ONE_WORD  # noqa: E402
from lexisieve.session import get_session, scratch_path  # noqa: E402
from lexisieve.sources import benchmark_requests, conversation_changes, document_corpus  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, repeat=3):
    fn()
    times = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus)

    corpus = document_corpus(spark, sf_dir)
    _noop(idx.doc_words(corpus, unique_paths=True))  # warm-up: JVM, codegen, file cache

    q: dict[str, float] = {}
    loc = scratch_path(spark, "bench-postings")
    q["index_build"] = _timed(lambda: idx.write_index(idx.doc_words(corpus, unique_paths=True),
                                                      scratch_path(spark, "bench-postings")))
    idx.write_index(idx.doc_words(corpus, unique_paths=True), loc)
    stored, terms = idx.read_index(spark, loc)

    q["search_one"] = _timed(lambda: srch.search_one(stored, ONE_WORD).collect())
    q["search_all"] = _timed(lambda: srch.search_all(stored, ALL_WORDS).collect())
    q["search_any"] = _timed(lambda: srch.search_any(stored, ANY_WORDS).collect())

    reqs = benchmark_requests(spark, sf_dir)
    q["batch_search"] = _timed(lambda: _noop(srch.batch_search(stored, rq.parse_requests(reqs), terms=terms)))
    q["run_requests"] = _timed(lambda: _noop(rq.run_requests(stored, reqs, terms=terms)))

    log = conversation_changes(spark, sf_dir)
    q["apply_changes"] = _timed(lambda: _noop(chg.apply_changes(log)))
    q["live_documents"] = _timed(lambda: _noop(chg.live_documents(log)))
    q["word_table"] = _timed(lambda: _noop(dic.word_table(corpus)))

    q = {k: round(v, 3) for k, v in q.items()}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(q.values()), 3), "unit": "sec",
                      "queries": q, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "runs": "median of 3 warm runs"}))
    spark.stop()


if __name__ == "__main__":
    main()
