"""Phrases by tile counting against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lexisieve.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n int, phrase string, id long, key string"


def _plain(rows, least, longest, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        frequent = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        for g, a in frequent.items():
            if any(len(x) > len(g) and b >= a and any(x[i:i + len(g)] == g for i in range(len(x) - len(g) + 1))
                   for x, b in frequent.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                                 for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(1, t, g, 2, "p", 3, "k") for t, g in rows], SCHEMA)


def _rows(rng, n):
    words = ["of", "The", "new", "york", "é", "ß中", "x-y", "a\x1cb", "times"]
    def text():
        return "".join(rng.choice(words[:rng.randint(1, 9)]) + rng.choice([" ", " ", " ", "  \t", ", ", ".", "\n", "?!"])
                       for _ in range(rng.randint(0, 60)))
    return [(text(), rng.choice(["en", "en", "en", "de", None, "und", ""])) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, monkeypatch, small):
    """``small``: many slices, tiles, blocks and drains."""
    if small:
        for name, value in (("SLICE", 12), ("BLOCK", 50), ("PENDING", 20), ("TILE", 2), ("DENSE", 2), ("DENSE_TILES", 2)):
            monkeypatch.setattr(C, name, value)
    rng = random.Random(5)
    rows = _rows(rng, 120) + [(None, "en"), ("", "de"), (" \n.", "en"), ("New York Times " * 400, "en")] + _rows(rng, 3) * 2
    df = _frame(spark, rows).repartition(3)
    for least, longest, top in (((3, 4, 40),) if small else ((3, 5, 2000), (30, 3, 5), (10**6, 5, 9))):
        out = C.collocations(df, least, longest, top)
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        got = sorted(tuple(r) for r in out.collect())
        assert got == _plain(rows, least, longest, top) and bool(got) == (least < 10**6)


def test_tile_counter_is_exact():
    rng = np.random.default_rng(2)
    counter = C.TileCounter(5000)
    codes = [rng.integers(0, 300, 200_000) * 5000 + rng.integers(0, 40, 200_000), rng.integers(0, 5000 * 5000, 1000)]
    for c in (*codes, codes[0]):
        counter.add(c)
    assert counter.tiles
    got = Counter()
    for found, counts in counter.drain():
        assert (np.diff(found) > 0).all()
        got.update(dict(zip(found.tolist(), counts.tolist())))
    assert not counter.size and got == Counter(np.concatenate([*codes, codes[0]]).tolist())
    assert (C._unplanes(C._planes(np.array([0, 7, 1 << 60]))) == [0, 7, 1 << 60]).all()


def test_scores_pass_64_bits(spark):
    from pyspark.sql import functions as F
    big = 10**13
    row = spark.range(1).select(F.lit("en").alias("lang"), F.lit("a b").alias("phrase"), F.lit(big - 1).alias("n"),
                                F.array(F.lit(big)).alias("first"), F.array(F.lit(big + 7)).alias("rest"))
    totals = spark.range(1).select(F.lit("en").alias("lang"), F.lit(10**17).alias("n_words"))
    assert C._scored(row, totals, 2).first()["cut"]["score"] == 1000 * (big - 1) * 10**17 // (big * (big + 7))


def test_empty_table(spark):
    assert C.collocations(_frame(spark, [])).count() == 0
