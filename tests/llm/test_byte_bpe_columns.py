"""op8's encoding by whole columns: what is encoded once, and what a task leaves behind."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from lexisieve.llm import byte_bpe as B


@pytest.fixture(scope="module")
def raw():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def codec(raw):
    return B.Codec(B.read_ranks(raw), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(raw):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(raw), special_tokens={})


def _texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "é", ".", "'s", "中", "\xa0", "　", "7", "\r\n", "😀", "thing", "Anblewh"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]


def test_column_gives_the_ids_of_each_text(reference, codec):
    texts = ["", " ", "a ", " a", "a\n \nb", "a \n", "a   b", *_texts(1)]
    want = [reference.encode_ordinary(x) for x in texts]
    assert codec.encode_column(pa.array(texts)).to_pylist() == want
    assert codec.encode_column(pa.array(["x", *texts])[1:]).to_pylist() == want
    assert codec.encode_column(pa.array([], pa.string())).to_pylist() == []


def test_each_piece_of_a_run_is_encoded_once(raw):
    codec = B.Codec(B.read_ranks(raw), public_tokenizers.PATTERN)
    met, plain = [], codec.machine.encode_piece
    codec.machine.encode_piece = lambda piece: met.append(piece) or plain(piece)
    codec.encode_column(pa.array(["thing thing, thinga", "a thing.\nthinga  thing"] * 50))
    assert len(met) == len(set(met)) and b" thing" in met


def _made_up(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["th", "ing", "er", "ò", "ent", "sch", "a", "ou", "ble", "tion", "ß", "he", "qu", "中文"]
    return [" " + "".join(rng.choice(parts) for _ in range(rng.randint(1, 7))) for _ in range(n)]


def test_pieces_of_an_earlier_run_are_not_encoded_again(raw, reference):
    codec = B.Codec(B.read_ranks(raw), public_tokenizers.PATTERN)
    texts = ["".join(_made_up(k, 200)) for k in range(10)]
    want = [reference.encode_ordinary(x) for x in texts]
    met, together, alone = [], codec.machine.encode_together, codec.machine.encode_piece
    codec.machine.encode_together = lambda pieces: met.extend(pieces) or together(pieces)
    codec.machine.encode_piece = lambda piece: met.append(piece) or alone(piece)
    assert codec.encode_column(pa.array(texts[:6])).to_pylist() == want[:6]
    assert codec.encode_column(pa.array(texts[3:])).to_pylist() == want[3:]
    assert len(met) == len(set(met)) > 500
    codec.clear()
    assert codec.encode_column(pa.array(texts[:6])).to_pylist() == want[:6]
    assert len(met) > len(set(met))


def test_pieces_together_have_the_ids_of_pieces_alone(raw, reference, monkeypatch):
    words = [*_made_up(5, 3000), " " + "thing" * 40, " the", " " + "ò" * 30, "\n" * 70]
    want = [reference.encode_ordinary(x) for x in words]
    for bounds in ({}, {"MAX_STATES": 50, "BLOCK_PIECES": 100, "LOCKSTEP_PIECES": 2},
                   {"MAX_PAIRS": 10, "LOCKSTEP_BYTES": 9}, {"MAX_PIECES": 100, "LOCKSTEP_BYTES": 10**6}, {"MAX_ARCS": 5, "LOCKSTEP_PIECES": 10**6},
                   {"GATHER_LISTS": 7}):
        with monkeypatch.context() as m:
            for name, size in bounds.items():
                m.setattr(B, name, size)
            codec = B.Codec(B.read_ranks(raw), public_tokenizers.PATTERN)
            for _ in range(2):
                assert codec.encode_column(pa.array(words)).to_pylist() == want


def test_words_with_other_settled_beginnings_share_states(raw):
    machine, arcs = B.Transducer(B.read_ranks(raw)), []
    step = machine._step
    machine._step = lambda *x: arcs.append(x) or step(*x)
    words = sorted({x.encode() for x in _made_up(6, 4000)})
    for word in words:
        machine.encode_piece(word)
    assert len(machine._names) <= 5000 and len(arcs) == len(set(arcs))


def test_a_task_leaves_no_tables_and_small_bounds_change_nothing(raw, reference, monkeypatch):
    texts = [None, *_texts(2)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    want = [reference.encode_ordinary(x or "") for x in texts]
    for name, size in (("MAX_STATES", 20), ("TEXT_BYTES", 100), ("OUT_BYTES", 40), ("DECODE_IDS", 3)):
        monkeypatch.setattr(B, name, size)
    out = pa.Table.from_batches(B._transcoder(SimpleNamespace(value=raw), public_tokenizers.PATTERN, True)(iter([batch])))
    assert out["doc_id"].to_pylist() == list(range(len(texts)))
    assert out["ids"].to_pylist() == want
    assert out["decoded"].to_pylist() == [(x or "").encode() for x in texts]
    machine = B._codec(raw, public_tokenizers.PATTERN).machine
    assert len(machine._names) == 1 and not machine._arcs and not machine._pairs and not machine._ends and not machine._outs


def test_boundaries_hold_as_the_merges_say(codec):
    machine, rng = codec.machine, random.Random(4)
    tokens = sorted(machine._alone)
    assert machine._rising
    for k in range(20000):
        s, t = rng.choice(tokens), rng.choice(tokens)
        if k % 2:  # the rest of a token follows its beginning
            whole = machine.token_bytes[s]
            cut = rng.randrange(len(whole)) or len(whole)
            s, t = machine.ranks.get(whole[:cut], s), machine.ranks.get(whole[cut:], t)
        a, b = machine.token_bytes[s], machine.token_bytes[t]
        assert machine._apart(s, t) == (B.merge_plainly(machine.ranks, a + b) == [a, b])


def test_falling_ranks_and_dead_tokens_go_by_the_plain_merges():
    letters = {bytes([c]): i for i, c in enumerate(b"abc")}
    for k in range(300):
        rng = random.Random(k)
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 8))}
        ranks = dict(letters)
        for word in sorted(words, key=lambda w: rng.random()):
            ranks[word] = len(ranks)
        machine = B.Transducer(ranks)
        for _ in range(20):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9)))
            if piece not in ranks:
                assert machine.encode_piece(piece) == [ranks[x] for x in B.merge_plainly(ranks, piece)]


def test_unknown_ids_raise(codec):
    for wrong in ([-1], [0, 10**6]):
        with pytest.raises(KeyError):
            codec.decode(np.array(wrong, np.int64))
