"""Print ``explain("formatted")`` of the headline plans.

Usage: python tools/show_plans.py [sf_dir]
Searches run against postings stored in the bucketed layout (a fresh folder
under the checkpoint directory), as they would in production.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from lexisieve.operators import changes as chg
    from lexisieve.operators import dictionary as dic
    from lexisieve.operators import index as idx
    from lexisieve.operators import search as srch
    from lexisieve.plans import requests as rq
    from lexisieve.plans.catalog import ALL_WORDS
    from lexisieve.session import get_session, scratch_path
    from lexisieve.sources import benchmark_requests, conversation_changes, document_corpus

    spark = get_session("local[8]", 8)
    corpus = document_corpus(spark, sf_dir)
    loc = scratch_path(spark, "plans-postings")
    idx.write_postings(idx.doc_words(corpus, unique_paths=True), loc)
    stored = idx.read_postings(spark, loc)
    plans = {
        "search_all (stored postings)": srch.search_all(stored, ALL_WORDS),
        "batch_search (stored postings)": srch.batch_search(stored, rq.parse_requests(benchmark_requests(spark, sf_dir))),
        "apply_changes": chg.apply_changes(conversation_changes(spark, sf_dir)),
        "word_table": dic.word_table(corpus),
    }
    for title, df in plans.items():
        print(f"===== {title}")
        df.explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main())
