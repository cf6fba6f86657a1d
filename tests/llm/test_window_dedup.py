"""Passage removal by rolling hashes against a plain version."""

import random
import re

import numpy as np
import pytest

from lexisieve.llm import window_dedup as D

SCHEMA = "doc_id long, text string, id long, h int, starts string, _hash long"


def _plain(rows, size):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - size + 1) if i is not None else ():
            x = tuple(w[k:k + size])
            least[x] = min(least.get(x, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1) if i is not None else ():
            if least[tuple(w[k:k + size])] < i:
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 7, "x", 7) for i, t in rows], SCHEMA)


def _sorted(rows):
    return sorted(rows, key=repr)


def test_rolling_hashes_are_the_same_anywhere(monkeypatch):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    whole = D.rolling(h, 13)
    assert len(whole) == 4988 and len(set(whole.tolist())) == 4988
    assert (D.rolling(h[1000:1013], 13) == whole[1000]).all()
    monkeypatch.setattr(D, "_ROLL", 100)  # blocks with overlaps
    assert (D.rolling(h, 13) == whole).all()
    assert len(D.rolling(h[:12], 13)) == 0
    assert (D.rolling(h, 13, 1) != whole).all()


def test_packing_round_trip():
    ids = np.array([5, 5, 5, -2, -2, 5, 5], np.int64)
    h = np.array([1, 1, 1, 9, 9, 1, 1], np.int64)
    place = np.array([0, 3, 70000, 4, 4, 1, 2], np.int64)
    got = D._unpack(*D._pack(ids, h, place))
    assert all((a == b).all() for a, b in zip(got, (ids, h, place)))


@pytest.mark.parametrize("size,block,seed", [(13, 1 << 21, 1), (3, 40, 2), (1, 7, 3)])
def test_random_documents(spark, monkeypatch, size, block, seed):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", block)
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("ab cé 中 Ab x \x1cq".split(" ")) for _ in range(rng.randint(1, 30))) for _ in range(12)]
    rows = [(rng.choice([None, *range(-3, 40)]), rng.choice([" ", "\n", "\t\x0b"]).join(rng.choices(passages, k=rng.randint(0, 6))))
            for _ in range(80)]
    rows += [(41, None), (42, ""), (43, " \r\n"), (44, rows[0][1]), (44, rows[0][1])]
    df = _frame(spark, rows).repartition(3)
    out = D.remove_repeats(df, size)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept", "starts", "ends"]
    got = out.collect()
    assert _sorted(tuple(r)[:4] for r in got) == _sorted(_plain(rows, size))
    for r in got:
        if r["starts"]:  # maximal: apart, in order
            assert all(e < s for e, s in zip(r["ends"], r["starts"][1:])) and sum(r["ends"]) - sum(r["starts"]) == r["n_removed"]


def test_a_hot_passage_and_a_long_text(spark):
    hot = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"own{i} {hot} end{i}" if i % 3 == 0 else f"own{i}") for i in range(3000)]
    rows += [(5000, "alpha beta gamma " * 100_000)]
    got = {r["doc_id"]: r for r in D.remove_repeats(_frame(spark, rows).repartition(8)).collect()}
    assert got[0]["n_removed"] == 0 and got[5000]["n_removed"] == 0 and got[5000]["n_words"] == 300_000
    assert all(got[i]["n_removed"] == 20 and got[i]["kept"] == f"own{i} end{i}" for i in range(3, 3000, 3))


def test_empty_table(spark):
    assert D.remove_repeats(_frame(spark, [])).count() == 0


def test_words_are_not_lowered(spark):
    text = " ".join(f"W{i}" for i in range(13))
    assert [r["n_removed"] for r in D.remove_repeats(_frame(spark, [(1, text), (2, text.lower())])).collect()] == [0, 0]
