"""Random change logs against a plain Python model of the index mutators."""

from __future__ import annotations

import random
import re

from lexisieve.operators import changes as chg
from lexisieve.schemas import CHANGE_LOG

WORDS = ["a", "b", "c", "d", "E", "f1"]


class Model:
    """Dictionaries, forward and inverted index, mutated call by call."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.words, self.next_w = {}, 1
        self.docs, self.next_d = {}, 1
        self.fwd, self.inv = {}, {}

    def _set_words(self, did, text):
        ids = set()
        for t in re.findall(r"[a-z0-9]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                                          "abcdefghijklmnopqrstuvwxyz"))):
            if t not in self.words:
                self.words[t], self.next_w = self.next_w, self.next_w + 1
            ids.add(self.words[t])
        self.fwd[did] = ids
        for w in ids:
            self.inv.setdefault(w, set()).add(did)

    def add(self, path, text):
        if text is None:
            return False
        if path not in self.docs:
            self.docs[path], self.next_d = self.next_d, self.next_d + 1
        self._set_words(self.docs[path], text)
        return True

    def reindex(self, path, text):
        if text is None:
            return False
        if path not in self.docs:
            return self.add(path, text)
        did = self.docs[path]
        for w in self.fwd.pop(did, set()):
            self.inv[w].discard(did)
        self._set_words(did, text)
        return True

    def remove(self, path):
        if path not in self.docs:
            return False
        did = self.docs.pop(path)
        for w in self.fwd.pop(did, set()):
            self.inv[w].discard(did)
        return True

    def postings(self):
        by_id = {v: k for k, v in self.words.items()}
        return {(p, by_id[w]) for p, d in self.docs.items() for w, ds in self.inv.items() if d in ds}


def _random_log(rng, n, paths, with_clear):
    rows = []
    for i in range(n):
        r = rng.random()
        if with_clear and r < 0.06:
            rows.append(("CLEAR", None, None))
            continue
        op = rng.choice(["ADD", "ADD", "REINDEX", "REINDEX", "REMOVE"])
        path = rng.choice(paths)
        if op == "REMOVE":
            rows.append((op, path, None))
        else:
            text = None if rng.random() < 0.1 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 3)))
            rows.append((op, path, text))
    return rows


def _replay(rows):
    m, outcomes = Model(), []
    for op, path, text in rows:
        if op == "CLEAR":
            m.clear()
            outcomes.append(None)
        elif op == "ADD":
            outcomes.append(m.add(path, text))
        elif op == "REINDEX":
            outcomes.append(m.reindex(path, text))
        else:
            outcomes.append(m.remove(path))
    return m, outcomes


def _check(spark, logs):
    """logs: list of row lists; each gets its own path namespace and seq
    range, so one Spark job checks them all (logs without CLEAR only, or a
    single log with CLEAR)."""
    data, expect_post, expect_docs, expect_out = [], set(), {}, {}
    for k, rows in enumerate(logs):
        m, outs = _replay(rows)
        for i, ((op, path, text), o) in enumerate(zip(rows, outs)):
            p = None if path is None else f"L{k}/{path}"
            seq = k * 10_000 + i * 7 + 3
            data.append((seq, op, p, text))
            expect_out[seq] = o
        expect_post |= {(f"L{k}/{p}", w) for p, w in m.postings()}
        expect_docs[k] = {f"L{k}/{p}": d for p, d in m.docs.items()}
    lg = spark.createDataFrame(data, CHANGE_LOG)
    got = {(r["path"], r["word"]) for r in chg.apply_changes(lg).collect()}
    assert got == expect_post
    outs = {r["seq"]: r["outcome"] for r in chg.change_outcomes(lg).collect()}
    assert outs == expect_out
    return lg, expect_docs


def test_random_logs_without_clear(spark):
    rng = random.Random(7)
    logs = [_random_log(rng, rng.randint(1, 14), ["p", "q", "r"], False) for _ in range(60)]
    lg, _ = _check(spark, logs)


def test_random_logs_with_clear_and_ids(spark):
    rng = random.Random(11)
    for _ in range(4):
        rows = _random_log(rng, 25, ["p", "q", "r", "s"], True)
        lg, docs = _check(spark, [rows])
        got = {r["path"]: r["doc_id"] for r in chg.live_documents(lg).collect()}
        assert got == docs[0]
        m, _ = _replay(rows)
        words = {r["word"]: r["word_id"] for r in chg.log_word_table(lg).collect()}
        assert words == m.words


def test_rank_blocks_for_clustered_seqs(spark, monkeypatch):
    """A block swelling past the bound switches to rank blocks (forced here by
    a tiny target), and the results stay exact."""
    monkeypatch.setattr(chg, "BLOCK_ROWS", 1)
    calls = []
    real = chg.dense_ordinal
    monkeypatch.setattr(chg, "dense_ordinal", lambda *a, **k: calls.append(a[1]) or real(*a, **k))
    rng = random.Random(8)
    logs = [_random_log(rng, rng.randint(10, 16), ["p"], False) for _ in range(12)]
    _check(spark, logs)
    assert ["seq"] in calls  # the rank blocks were used


def test_small_blocks_bridge_block_borders(spark, monkeypatch):
    """Blocks narrower than the seq step: every row is alone in its block, so
    every neighbour is found through the block-level table."""
    real, widths = chg._with_blocks, []

    def narrow(rows, keys, width):
        out = real(rows, keys, 5)
        widths.append(out.groupBy(*keys, "_blk").count().where("count > 1").count())
        return out
    monkeypatch.setattr(chg, "_with_blocks", narrow)
    rng = random.Random(3)
    logs = [_random_log(rng, rng.randint(2, 12), ["p", "q"], False) for _ in range(30)]
    _check(spark, logs)
    rows = _random_log(rng, 30, ["p", "q", "r"], True)
    lg, docs = _check(spark, [rows])
    assert {r["path"]: r["doc_id"] for r in chg.live_documents(lg).collect()} == docs[0]
    assert widths and not any(widths)  # no block ever held two rows of a path


def test_compacted_log_is_equivalent(spark):
    """apply(compact(L) + L') == apply(L + L') for random L and later L'."""
    rng = random.Random(21)
    logs, tails = [], []
    for _ in range(25):
        logs.append(_random_log(rng, rng.randint(1, 12), ["p", "q", "r"], False))
        tails.append(_random_log(rng, rng.randint(0, 6), ["p", "q", "r"], False))
    head_rows, tail_rows = [], []
    for k, (rows, tail) in enumerate(zip(logs, tails)):
        for i, (op, path, text) in enumerate(rows):
            head_rows.append((k * 10_000 + i * 7 + 3, op, f"L{k}/{path}", text))
        for i, (op, path, text) in enumerate(tail):
            tail_rows.append((k * 10_000 + 5_000 + i * 7, op, f"L{k}/{path}", text))
    head = spark.createDataFrame(head_rows, CHANGE_LOG)
    tail = spark.createDataFrame(tail_rows, CHANGE_LOG)
    compacted = chg.compact_log(head)
    assert compacted.count() <= head.count()
    want = {(r["path"], r["word"]) for r in chg.apply_changes(head.unionByName(tail)).collect()}
    got = {(r["path"], r["word"]) for r in chg.apply_changes(compacted.unionByName(tail)).collect()}
    assert got == want
    # compacting alone keeps the live postings and the live documents
    assert {(r["path"], r["word"]) for r in chg.apply_changes(compacted).collect()} == \
        {(r["path"], r["word"]) for r in chg.apply_changes(head).collect()}
    assert {r["path"] for r in chg.live_documents(compacted).collect()} == \
        {r["path"] for r in chg.live_documents(head).collect()}


def test_compacted_log_after_clear(spark):
    rng = random.Random(4)
    rows = _random_log(rng, 30, ["p", "q", "r", "s"], True)
    tail = _random_log(rng, 8, ["p", "q", "r", "s"], False)
    head = spark.createDataFrame([(10 * i + 10, op, p, t) for i, (op, p, t) in enumerate(rows)], CHANGE_LOG)
    later = spark.createDataFrame([(1000 + 10 * i, op, p, t) for i, (op, p, t) in enumerate(tail)], CHANGE_LOG)
    m, _ = _replay(rows + tail)
    got = {(r["path"], r["word"]) for r in chg.apply_changes(chg.compact_log(head).unionByName(later)).collect()}
    assert got == m.postings()
