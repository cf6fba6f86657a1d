"""Spelling variants by index searches against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lexisieve.llm import spelling_groups as S

SCHEMA = "doc_id long, text string, word string, n int, near string, run string"


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain(rows, min_count=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    out, forms = {}, {}
    for w, n in counts.items():
        near = [(-m, x) for x, m in counts.items() if _near(w, x)]
        m, x = min(near, default=(0, None))
        forms[w] = x if x and -m >= 5 * n else None
        out[w] = (n, len(near), -m if forms[w] else None)
    result = []
    for w, (n, near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, forms[w], root, n, near, form_n))
    return sorted(result, key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "x", "y") for i, t in rows], SCHEMA)


def _words(rng, n, letters, least=6, most=9):
    out = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)}
    for w in list(out)[:n // 2]:  # variants of them
        k = rng.randrange(len(w))
        out |= {w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:], w[:k] + w[k + 1:]}
    return sorted(w for w in out if len(w) >= least)


@pytest.mark.parametrize("letters", ["ab", "aé", "abcdeßÿÀ÷"])
def test_index_finds_all_words_within_one_error(letters):
    rng = random.Random(letters)
    words = [w.encode("latin-1") for w in _words(rng, 300, letters)]
    index = S.WordIndex(words)
    for exact in (3, 4):
        q, t = index.near(words, np.full(len(words), exact), np.ones(len(words), bool))
        # the error lies before the last ``exact`` letters, or at their edge
        want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words)
                if _near(a, b) and a[-exact:] == b[-exact:] and (len(b) > exact or len(a) > exact)}
        assert set(zip(q.tolist(), t.tolist())) == want
    strange = [b"zzzzzz", words[0] + b"q", words[0]]
    q, t = index.near(strange, np.array([3, 3, 3]), np.array([False, False, True]))
    assert not (set(q.tolist()) & {0, 1})


@pytest.mark.parametrize("block", [1 << 16, 9])
def test_random_vocabularies(spark, monkeypatch, block):
    """A block of 9 words cuts every shard into many blocks and slices."""
    rng = random.Random(block)
    monkeypatch.setattr(S, "QUERIES_AT_ONCE", 5)
    words = _words(rng, 60, "abÉ") + _words(rng, 40, "aaab") + ["con" + w for w in _words(rng, 40, "xyß", 3, 5)]
    pool = [w for w in words for _ in range(rng.choice([1, 5, 6, 30, 200]))]
    rng.shuffle(pool)
    rows = [(i, " ".join(w.upper() if rng.random() < .1 else w for w in pool[i::40])) for i in range(40)]
    rows += [(None, " ".join(pool[:50])), (90, None), (91, ""), (92, "1 2, short"), (93, rows[0][1]), (93, rows[0][1]),
             (94, "a" * 20_000)]
    out = S.spelling_groups(_frame(spark, rows), block=block)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == _plain(rows) and any(r[1] for r in got)


def test_chains_end_at_their_root(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("a", "w0"), ("b", "w13")]
    got = dict(map(tuple, S.roots(spark.createDataFrame(links, "word string, form string")).collect()))
    assert set(got.values()) == {"w13"} and len(got) == 15


def test_empty_table(spark):
    assert S.spelling_groups(_frame(spark, [])).count() == 0
