"""Bigram counts in packed blocks, and the arc filter, against plain counts."""

from collections import Counter

import numpy as np
import pytest

from lexisieve.llm import backoff_lm as L
from lexisieve.llm.words import mix


@pytest.mark.parametrize("buckets, most", [(1, 1 << 20), (7, 1 << 20), (300, 1 << 20), (7, 8)])
def test_packed_blocks_keep_every_count(monkeypatch, buckets, most):
    monkeypatch.setattr(L, "BUCKET_PAIRS", most)
    rng = np.random.default_rng(3)
    want, rows = Counter(), []
    for _ in range(5):  # five tasks' blocks
        u, v = (mix(rng.zipf(1.6, 400).astype(np.uint64)) for _ in range(2))
        want.update(zip(u.tolist(), v.tolist()))
        rows += L._packed_pairs([(L._pair(u, v), u)], buckets)
    rows.sort(key=lambda b: b.column("bucket")[0].as_py())
    got = {}
    for b in L._sum_pairs(iter(rows)):
        key, u = (b.column(c).to_numpy().view(np.uint64) for c in ("key", "u"))
        for pair, n in zip(zip(u.tolist(), L._second(key, u).tolist()), b.column("n").to_pylist()):
            assert pair not in got
            got[pair] = n
    assert got == {p: n for p, n in want.items() if n >= L.MIN_ARC}


def test_no_rows_no_pairs():
    assert list(L._sum_pairs(iter([]))) == [] and list(L._count_pairs(3)(iter([]))) == []


def test_filter_holds_every_arc(spark):
    keys = mix(np.arange(1, 3000, dtype=np.uint64))
    df = spark.createDataFrame([(int(k),) for k in keys[:2000].view(np.int64)], "key long")
    bits = L._arc_filter(df)
    assert L._may_be_arc(bits, keys[:2000]).all() and L._may_be_arc(bits, keys[2000:]).mean() < .01
    assert not L._may_be_arc(L._arc_filter(df.limit(0)), keys).any()
