"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges (a table of token bytes and ranks) are never run over a text.
Instead every prefix of a piece has exactly one last token that is consistent
with the merges: token ``t`` may follow token ``s`` when merging ``s + t``
leaves the two apart. The transducer's state is the last token that has become
certain and the bytes after it; reading a byte extends the tokenisation of the
pending bytes, and as soon as every way on shares a boundary, the tokens up to
it are emitted. A boundary is pending only while some vocabulary token may
still cover it, so lookahead is bounded by the longest token. States and arcs
are made when first met and kept in a table that is emptied when full and at
a task's end. A run of texts goes through it by its distinct pieces, of which
all that a task has not met before take a byte at a time together; the ids of
each text are gathered from theirs.

Decoding joins token bytes and turns them into text with an incremental UTF-8
state machine that holds back an unfinished character between feeds.

Defined results: a null or empty text has no ids; any text is encoded without
special tokens; unknown ids raise; invalid UTF-8 decodes to U+FFFD. Rows are
handled one by one, so repeated ids or rows stay as they are; other columns
are dropped. A missing single byte in the table raises when it is met.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.llm.tasks import map_arrow
from lexisieve.llm.words import text_bytes

MAX_STATES = 60_000
MAX_ARCS = 60_000
MAX_PAIRS = 200_000
#: Pieces that go through the transducer together, the longest of them, and the fewest worth it.
BLOCK_PIECES, LOCKSTEP_BYTES, LOCKSTEP_PIECES = 1 << 14, 48, 64
#: Pieces whose ids a task keeps for its next run of texts.
MAX_PIECES = 1 << 19
GATHER_LISTS = 1 << 17
TEXT_BYTES = 12 << 20
OUT_BYTES = 4 << 20
FEED_BYTES = 1 << 16
DECODE_IDS = 1 << 18
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A space after white space and before more of it or the end: a pattern may take both in one piece.
_ODD_SPACE = f"{_SPACE} (?:{_SPACE}|$)"


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and number per line)."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


def merge_plainly(ranks: dict[bytes, int], piece: bytes) -> list[bytes]:
    """The merges run directly: lowest rank first, leftmost of equals."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    cost = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while cost:
        best = min(cost)
        if best == none:
            break
        i = cost.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del cost[i]
        if i < len(cost):
            cost[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            cost[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return parts


def last_merge(ranks: dict[bytes, int], token: bytes) -> tuple[int, bool] | None:
    """(length of the left half, whether ranks never fell on the way) of the
    last merge that makes ``token`` of its bytes; None if they make something else."""
    ends, low, rising = list(range(1, len(token) + 1)), -1, True
    while len(ends) > 1:
        starts = [0, *ends[:-2]]
        best, i = min((ranks.get(token[a:b], len(ranks) + 1), i) for i, (a, b) in enumerate(zip(starts, ends[1:])))
        if best > len(ranks):
            return None
        rising, low, left = rising and best >= low, best, ends.pop(i)
    return (left if len(token) > 1 else 0), rising


class Transducer:
    """Encodes one piece at a time; all tables are made lazily.

    A state is (last certain token, pending bytes, detail); its detail is the
    start of the last token of each pending prefix (``back``) and the prefixes
    that a longer token may still start at (``live``). Only the chains of live
    prefixes are kept in ``back``, and the last token only while a longer one
    may still follow it, so that texts before that do not matter share states.
    An arc is stored under ``state << 8 | byte`` as the next state, or as (next
    state, tokens emitted); those of pieces encoded together in sorted arrays.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {v: k for k, v in ranks.items()}
        # Made before the tables that are emptied, so that emptying these gives whole blocks of memory back.
        made = {v: last_merge(ranks, k) for k, v in ranks.items()}
        self._alone = {v for v, x in made.items() if x}
        # Of each beginning of a token: its rank if its bytes merge to it (else -1), and whether a longer token goes on.
        self._begins = {t[:i]: (-1, True) for t in ranks for i in range(len(t))}
        self._begins |= {t: (v, t in self._begins) for t, v in ranks.items() if v in self._alone}
        self._rising = all(x is None or x[1] for x in made.values())
        self._halves = {v: (ranks.get(k[:x[0]], -1), ranks.get(k[x[0]:], -1)) if x[0] else None
                        for v, k in self.token_bytes.items() if (x := made[v])}
        self.clear()

    def clear(self) -> None:
        self._outs: dict[tuple, int] = {}
        self._pairs: dict[int, bool] = {}
        self._names: list[tuple[int, bytes, bytes | tuple]] = [(-1, b"", bytes(2))]
        self._numbers: dict[tuple, int] = {self._names[0]: 0}
        self._arcs: dict[int, int | tuple] = {}
        self._ends: dict[int, tuple] = {}
        # Arcs of pieces encoded together: keys (the last one is none) and ``next state << 32 | number in _outs``.
        self._keys, self._values = np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int64)

    def _may_follow(self, s: int, t: int) -> bool:
        key = s << 32 | t
        got = self._pairs.get(key)
        if got is None:
            a, b = self.token_bytes[s], self.token_bytes[t]
            got = self._pairs[key] = self._apart(s, t) if self._rising else merge_plainly(self.ranks, a + b) == [a, b]
        return got

    def _apart(self, s: int, t: int) -> bool:
        """Whether no merge crosses the boundary of ``s + t``, where ranks
        only rise while a token is made: its merges are undone, the later
        first, and the two that then meet must not merge before (of equals the
        left one merges first)."""
        of, limit = self.token_bytes, len(self.ranks) + 1
        while True:
            crossing = self.ranks.get(of[s] + of[t])
            if crossing is not None and crossing < limit:
                return False
            left, right = self._halves[s], self._halves[t]
            if left and (s > t or not right):
                s, limit = left[1], s
            elif right:
                t, limit = right[0], t + 1
            else:
                return True

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        """(next state, tokens emitted). A prefix whose own chain does not pass
        the certain boundary is not live."""
        last, pending, detail = self._names[state]
        n = len(pending) + 1
        back, pending = [*detail[:n], 0], pending + bytes((byte,))
        begins, live = self._begins.get, []
        start = -1
        for j in detail[n:]:
            t = pending[j:]
            found = begins(t)
            if found is not None:
                rank, goes_on = found
                if start < 0 <= rank:
                    before = self.ranks[pending[back[j]:j]] if j else last
                    if before < 0 or self._may_follow(before, rank):
                        start = back[n] = j
                if goes_on:
                    live.append(j)
        if start >= 0:
            live.append(n)
        if not live:
            raise ValueError(f"no token for byte {byte}")
        # The last boundary in the chains of all live prefixes.
        sure = live[0]
        for j in live:
            while j != sure:
                if j > sure:
                    j = back[j]
                else:
                    sure = back[sure]
        out: tuple[int, ...] = ()
        if sure:
            out = self._chain(pending, back, sure)
            last, pending = out[-1], pending[sure:]
        # Chains that pass no live prefix, or not the boundary, are never looked at again.
        kept = [0] * (n + 1 - sure)
        for j in live:
            while j > sure and not kept[j - sure]:
                to = back[j]
                kept[j - sure] = to - sure
                j = to
        if live[0] > sure:
            last = -1
        kept += [j - sure for j in live] if sure else live
        name = (last, pending, bytes(kept) if n < 256 else tuple(kept))
        number = self._numbers.get(name)
        if number is None:
            number = self._numbers[name] = len(self._names)
            self._names.append(name)
        return number, out

    def _chain(self, pending: bytes, back: Sequence[int], end: int) -> tuple[int, ...]:
        found = []
        while end:
            found.append(self.ranks[pending[back[end]:end]])
            end = back[end]
        return tuple(reversed(found))

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        self._bound()
        out: list[int] = []
        state, arcs = 0, self._arcs
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                arc = self._step(state, byte)
                arc = arcs[state << 8 | byte] = arc if arc[1] else arc[0]
            if arc.__class__ is int:
                state = arc
            else:
                state, emitted = arc
                out += emitted
        rest = self._ends.get(state)
        if rest is None:
            rest = self._ends[state] = self._end(state)
        out += rest
        return out

    def _end(self, state: int) -> tuple[int, ...]:
        _, pending, detail = self._names[state]
        return self._chain(pending, detail, len(pending))

    def _bound(self) -> None:
        """Empties what is full, between pieces."""
        if len(self._names) > MAX_STATES:
            self.clear()
        if len(self._arcs) > MAX_ARCS:
            self._arcs, self._ends = {}, {}
        if len(self._pairs) > MAX_PAIRS:
            self._pairs = {}

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        """Values of arcs; each that is not known is made once."""
        at = np.searchsorted(self._keys, keys)
        values, missing = self._values[at], np.flatnonzero(self._keys[at] != keys)
        if len(missing):
            new, which = np.unique(keys[missing], return_inverse=True)
            made, outs = np.empty(len(new), np.int64), self._outs
            for k, key in enumerate(new.tolist()):
                state, out = self._step(key >> 8, key & 255)
                made[k] = state << 32 | (outs.setdefault(out, len(outs) + 1) if out else 0)
            where = np.searchsorted(self._keys, new)
            self._keys, self._values = np.insert(self._keys, where, new), np.insert(self._values, where, made)
            values[missing] = made[which]
        return values

    def encode_together(self, pieces: list[bytes]) -> pa.ListArray:
        """Ids of pieces that are no tokens. All take a byte at a time, so that
        arcs are looked up and followed as arrays; sorted pieces meet fewer."""
        self._bound()
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data, at = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size
        state, left, met = np.zeros(len(pieces), np.int64), np.arange(len(pieces)), []
        for k in range(size.max(initial=0)):
            left = left[size[left] > k]
            keys = state[left] << 8 | data[at[left] + k]
            first = np.diff(keys, prepend=-1) != 0  # neighbours with equal beginnings take the same arc
            values = self._follow(keys[first])[np.cumsum(first) - 1]
            state[left] = values >> 32
            some = np.flatnonzero(values & 0xFFFFFFFF)
            met.append((left[some], values[some] & 0xFFFFFFFF))
        ends, which = np.unique(state, return_inverse=True)
        rest = np.array([self._outs.setdefault(self._end(x), len(self._outs) + 1) for x in ends.tolist()], np.int64)
        met.append((np.arange(len(pieces)), rest[which]))
        piece, out = (np.concatenate(x) for x in zip(*met))
        order = np.argsort(piece, kind="stable")
        outs = pa.array(list(self._outs), pa.list_(pa.int32()))
        return _regroup(outs.take(pa.array(out[order] - 1)), _offsets(np.bincount(piece, minlength=len(pieces))))


def _regroup(lists: pa.ListArray, ends: np.ndarray) -> pa.ListArray:
    """Runs of lists, by their offsets, joined to one list each."""
    return pa.ListArray.from_arrays(pa.array(lists.offsets.to_numpy()[ends].astype(np.int32)), lists.flatten())


def _gathered(lists: pa.ListArray, index: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Lists by their indices, runs of them joined to one list each. Taken in
    slices into their place, as a take of all of them grows by doubling."""
    at = np.zeros(len(index) + 1, np.int32)
    np.cumsum(np.diff(lists.offsets.to_numpy())[index], out=at[1:])
    flat = np.empty(at[-1], np.int32)
    for i in range(0, len(index), GATHER_LISTS):
        part = lists.take(pa.array(index[i:i + GATHER_LISTS])).flatten().to_numpy()
        flat[at[i]:at[i] + len(part)] = part
    return pa.ListArray.from_arrays(pa.array(at[ends]), pa.array(flat))


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


class Codec:
    """Whole texts: splits into pieces, encodes each, and decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        # Token bytes end to end: token t is _bytes[_at[t]:_at[t] + _size[t]].
        n = max(ranks.values(), default=-1) + 1
        found = [self.machine.token_bytes.get(t, b"") for t in range(n)]
        self._bytes = np.frombuffer(b"".join(found), np.uint8)
        self._size = np.fromiter(map(len, found), np.int64, n)
        self._at = np.cumsum(self._size) - self._size
        self.clear()

    def clear(self) -> None:
        """Drops what was made of texts."""
        self.machine.clear()
        self._pieces, self._ids = pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))

    def _table(self, chunks: pa.StringArray) -> pa.ListArray:
        """Ids of every chunk. Each distinct piece is encoded once, in the
        order of the strings, so that equal prefixes meet the same states."""
        counts, parts = [], []
        for i in range(0, len(chunks), BLOCK_PIECES):
            flat: list[str] = []
            for x in chunks[i:i + BLOCK_PIECES].to_pylist():
                found = self.pattern.findall(x)
                counts.append(len(found))
                flat += found
            parts.append(pa.array(flat, pa.string()))
        coded = pa.concat_arrays([pa.array([], pa.string()), *parts]).dictionary_encode()
        del parts
        place = self._known(coded.dictionary)
        return _regroup(self._ids.take(pa.array(place[coded.indices.to_numpy()])), _offsets(np.array(counts, np.int64)))

    def _known(self, pieces: pa.StringArray) -> np.ndarray:
        """Places of distinct pieces in ``_pieces``, where their ids are in
        ``_ids``; those not met before are encoded and added."""
        if len(self._pieces) > MAX_PIECES:
            self._pieces, self._ids = self._pieces[:0], self._ids[:0]
        found = pc.index_in(pieces, value_set=self._pieces)
        place = found.fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(place < 0)
        new = pieces.take(pa.array(missing))
        order = pc.sort_indices(new).to_numpy()
        new = new.take(pa.array(order))
        place[missing[order]] = np.arange(len(new)) + len(self._pieces)
        self._pieces, self._ids = pa.concat_arrays([self._pieces, new]), pa.concat_arrays([self._ids, *self._encoded(new)])
        return place

    def _encoded(self, pieces: pa.StringArray) -> Iterator[pa.ListArray]:
        """Ids of distinct sorted pieces. Tokens, long pieces and few go one by one."""
        machine = self.machine
        for i in range(0, len(pieces), BLOCK_PIECES):
            block = [x.encode("utf-8") for x in pieces[i:i + BLOCK_PIECES].to_pylist()]
            many = [x for x in block if len(x) <= LOCKSTEP_BYTES and x not in machine.ranks]
            if len(many) < LOCKSTEP_PIECES:
                many = []
            together = set(many)
            alone = [k for k, x in enumerate(block) if x not in together]
            one = pa.array([machine.encode_piece(block[k]) for k in alone], pa.list_(pa.int32()))
            if not many:
                yield one
                continue
            rest = np.ones(len(block), bool)
            rest[alone] = False
            place = np.empty(len(block), np.int64)
            place[rest], place[alone] = np.arange(len(many)), np.arange(len(alone)) + len(many)
            yield pa.concat_arrays([machine.encode_together(many), one]).take(pa.array(place))

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text of a string column without nulls. A text is cut
        at each space, which begins the chunk after it; where a space stands
        between other white space (or ends it) the pattern may cut otherwise,
        so such texts are cut by the pattern itself. Each distinct chunk is
        encoded once, and the ids are gathered."""
        names, index, ends, order = self._chunks(texts)
        pa.default_memory_pool().release_unused()  # what the cuts took, before the pieces are made
        out = _gathered(self._table(names), index, ends)
        return out if order is None else out.take(pa.array(order))

    def _chunks(self, texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray | None]:
        """The distinct chunks, the chunks of all texts as indices of these,
        where each text's begin and end, and the texts' places if they moved."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        plain, other = np.flatnonzero(~odd), np.flatnonzero(odd)
        cut = pc.split_pattern(texts.take(pa.array(plain)) if len(other) else texts, " ")
        by_pattern = [self.pattern.findall(x) for x in texts.take(pa.array(other)).to_pylist()]
        begins = cut.offsets.to_numpy()[:-1]
        parts = [pc.list_flatten(cut), pc.list_flatten(cut).take(pa.array(begins)),
                 pa.array([x for row in by_pattern for x in row], pa.string())]
        names, codes, at = [], [], 0
        for part, before in zip(parts, (" ", "", "")):
            coded = part.dictionary_encode()
            names.append(pc.binary_join_element_wise(before, coded.dictionary, ""))
            codes.append(coded.indices.to_numpy() + np.int32(at))
            at += len(names[-1])
        rest = codes[0].copy()
        rest[begins] = codes[1]
        index = np.concatenate([rest, codes[2]])
        ends = np.concatenate([cut.offsets.to_numpy(), len(rest) + np.cumsum([len(x) for x in by_pattern], dtype=np.int64)])
        return pa.concat_arrays(names), index, ends, np.argsort(np.concatenate([plain, other])) if len(other) else None

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text."""
        return self.encode_column(pa.array([text or ""], pa.string())).flatten().to_numpy().astype(np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for i in range(0, len(ids), DECODE_IDS):
            part = ids[i:i + DECODE_IDS].astype(np.int64)
            if part.min() < 0 or part.max() >= len(self._size) or not (size := self._size[part]).all():
                raise KeyError("an id without a token")
            ends = np.cumsum(size)
            out.append(self._bytes[np.arange(ends[-1]) + np.repeat(self._at[part] - ends + size, size)].tobytes())
        return b"".join(out)


class Utf8Stream:
    """Incremental UTF-8 decoder: ``feed`` gives the text complete so far. Its
    state is the unfinished character's bytes (three at most)."""

    #: Bytes that follow a first byte, by its upper five bits (fixed by UTF-8).
    FOLLOW = [0] * 16 + [-1] * 8 + [1] * 4 + [2] * 2 + [3] + [-1]

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            follow = self.FOLLOW[data[-back] >> 3]
            if follow >= 0:
                if follow >= back:
                    cut = len(data) - back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")

    def close(self) -> str:
        rest, self.held = self.held.decode("utf-8", errors="replace"), b""
        return rest


def stream_text(data: bytes) -> str:
    """The text of some bytes, fed to the incremental decoder in blocks."""
    stream = Utf8Stream()
    return "".join(stream.feed(data[i:i + FEED_BYTES]) for i in range(0, len(data), FEED_BYTES)) + stream.close()


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    key = (hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(data), pattern)
    return _codecs[key]


def load_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file (a vocabulary of fixed size), read by the driver."""
    with open(path, "rb") as f:
        return f.read()


def _runs(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows up to ``most`` bytes or ids, by their offsets; a larger row is a run of its own."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1))
        yield at, to
        at = to


def _transcoded(codec: Codec, batch: pa.RecordBatch, decode: bool) -> Iterator[pa.RecordBatch]:
    keys, texts = batch.column("doc_id"), batch.column("text").fill_null("")
    for a, b in _runs(text_bytes(texts)[1], TEXT_BYTES):
        ids = codec.encode_column(texts.slice(a, b - a))
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        for i, j in _runs(ends, OUT_BYTES // 4):
            decoded = [stream_text(codec.decode(flat[ends[k]:ends[k + 1]])).encode("utf-8") if decode else None
                       for k in range(i, j)]
            yield pa.RecordBatch.from_arrays([keys.slice(a + i, j - i), ids.slice(i, j - i), pa.array(decoded, pa.binary())],
                                             ["doc_id", "ids", "decoded"])
        del ids, ends, flat
        pa.default_memory_pool().release_unused()  # before the next run is cut


def _transcoder(ranks_cast, pattern: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_cast.value, pattern)
        gc.disable()  # the tables hold millions of small objects and no cycles
        try:
            for batch in batches:
                yield from _transcoded(codec, batch, decode)
        finally:
            codec.clear()
            gc.enable()
    return run


def encode(docs: DataFrame, ranks: bytes, pattern: str, decode: bool = False) -> DataFrame:
    """(doc_id, ids, decoded) of every document row; ``decoded`` are the bytes
    of the text that the incremental decoder makes of the ids (null unless asked
    for). Python workers keep the vocabulary for their next task; the tables
    made of the texts end with the task, so that later steps have the memory."""
    cast = docs.sparkSession.sparkContext.broadcast(ranks)
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _transcoder(cast, pattern, decode),
                     "doc_id long, ids array<int>, decoded binary")


def _decoder(ranks_cast, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_cast.value, pattern)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                stream, found = Utf8Stream(), ids.as_py() or []
                texts.append("".join(stream.feed(codec.decode(np.array(found[i:i + 4096], np.int64)))
                                     for i in range(0, len(found), 4096)) + stream.close())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return run


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    cast = encoded.sparkSession.sparkContext.broadcast(ranks)
    return map_arrow(encoded.select(F.col("doc_id").cast("long"), "ids"), _decoder(cast, pattern),
                     "doc_id long, text string")
