"""Removal of repeated passages by rolling hashes of every word window.

Every window of ``size`` consecutive words of every text gets a Rabin-Karp
hash. The windows are dealt over buckets by a second, independent rolling
hash; in its bucket a window learns the smallest doc_id it starts in, and the
documents with larger ids lose it. Lost windows that overlap or touch are
merged into maximal removal intervals.

Windows travel packed: one row holds the windows of many documents for one
bucket. Before the shuffle a task settles what it can: of a window that it has
seen in several documents only the smallest document's goes on, so a window
that a third of all documents share is one entry per block of
``BLOCK_WINDOWS`` windows. The number of buckets follows the bytes of the
texts, so memory in a task does not grow with the table. Windows are equal
when two hashes agree, 64 bits and the bucket number.

Defined results: a null text has no words; texts shorter than a window lose
nothing; rows without a doc_id neither remove words nor lose any; rows with
one doc_id are one document, which never removes its own repeats; equal rows
come out equally often; the result has the columns named here, whatever other
columns the input has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.tasks import map_arrow
from lexisieve.session import broadcast_if_small, materialize

SIZE = 13
BUCKET_BYTES = 24 << 20
BLOCK_WINDOWS = 1 << 21
_ROLL = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)

_PACKED = "bucket int, final boolean, runs binary, places binary, hashes binary"
_SPANS = "id long, h long, starts array<int>, ends array<int>"
_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("final", pa.bool_()), ("runs", pa.binary()), ("places", pa.binary()),
                           ("hashes", pa.binary())])
_SPANS_ARROW = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("starts", pa.list_(pa.int32())),
                          ("ends", pa.list_(pa.int32()))])
_RUN = np.dtype([("id", "<i8"), ("h", "<i8"), ("n", "<u4")])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = [_powers(b, _ROLL + 1) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64), _ROLL + 1) for b in _BASES]


def rolling(h: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hashes of all windows of ``size`` word hashes: differences of prefix
    sums of the polynomial, scaled back by the inverse power (mod 2^64)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = _ROLL - size + 1
    if step < 1:
        raise ValueError("window too long")
    for a in range(0, n, step):
        b = min(n, a + step)
        sums = np.zeros(b - a + size, np.uint64)
        np.cumsum(h[a:b + size - 1] * _UP[which][:b - a + size - 1], out=sums[1:])
        out[a:b] = (sums[size:] - sums[:b - a]) * _DOWN[which][:b - a]
    return W.mix(out + np.uint64(size))


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers by byte planes: the upper planes compress to nothing."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _pack(ids: np.ndarray, h: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes]:
    """Runs of entries of one document, and their places as differences."""
    edge = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (h[1:] != h[:-1]) | (place[1:] < place[:-1])]))
    runs = np.empty(len(edge), _RUN)
    runs["id"], runs["h"], runs["n"] = ids[edge], h[edge], np.diff(np.append(edge, len(ids)))
    step = np.diff(place, prepend=0)
    step[edge] = place[edge]
    return runs.tobytes(), _planes(step)


def _unpack(runs: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = np.frombuffer(runs, _RUN)
    n = r["n"].astype(np.int64)
    total = np.cumsum(_unplanes(places))
    first = np.cumsum(n) - n
    before = np.where(first > 0, total[first - 1], 0)
    return np.repeat(r["id"], n), np.repeat(r["h"], n), total - np.repeat(before, n)


def _later(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether an equal hash is there with a smaller id."""
    order = np.argsort(hashes, kind="stable")
    sorted_h = hashes[order]
    same = sorted_h[1:] == sorted_h[:-1]
    shared = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    out = np.zeros(len(hashes), bool)
    if len(shared):
        h = hashes[shared]
        edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        least = np.repeat(np.minimum.reduceat(ids[shared], edge), np.diff(np.append(edge, len(h))))
        out[shared] = ids[shared] > least
    return out


def _block(parts: list[tuple], buckets: int) -> Iterator[tuple]:
    ids, h, place, hashes, bucket = (np.concatenate(x) for x in zip(*parts))
    lost = _later(hashes, ids)
    for final, pick in ((True, np.flatnonzero(lost)), (False, np.flatnonzero(~lost))):
        to = (h[pick].view(np.uint64) % np.uint64(buckets)).astype(np.int32) if final else bucket[pick]
        order = pick[np.argsort(to, kind="stable")]
        to = np.sort(to, kind="stable")
        for part in np.split(order, np.flatnonzero(to[1:] != to[:-1]) + 1) if len(to) else ():
            at = int(h[part[0]].view(np.uint64) % np.uint64(buckets)) if final else int(bucket[part[0]])
            yield at, final, *_pack(ids[part], h[part], place[part]), None if final else hashes[part].tobytes()


def _rows(rows, schema: pa.Schema, bytes_each: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= bytes_each:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _deal(size: int, buckets: int):
    def windows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b, h, first in W.word_runs(batch.column(2), "space", lower=False):
            n = np.maximum(np.diff(first) - size + 1, 0)
            if not n.sum():
                continue
            row = np.repeat(np.arange(b - a), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = first[:-1][row] + place
            yield (ids[a:b][row], keys[a:b][row], place, rolling(h, size)[at],
                   (rolling(h, size, 1)[at] % np.uint64(buckets)).astype(np.int32))

    def rows(batches) -> Iterator[tuple]:
        held, n = [], 0
        for batch in batches:
            for part in windows(batch):
                held.append(part)
                n += len(part[0])
                if n >= BLOCK_WINDOWS:
                    yield from _block(held, buckets)
                    held, n = [], 0
        if held:
            yield from _block(held, buckets)

    return lambda batches: _rows(rows(batches), _PACKED_ARROW)


def _judge(buckets: int):
    """One task has all windows of a bucket."""
    def rows(batches) -> Iterator[tuple]:
        held = []
        for batch in batches:
            for bucket, final, runs, places, hashes in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if final:
                    yield bucket, True, runs, places, None
                else:
                    held.append((*_unpack(runs, places), np.frombuffer(hashes, np.uint64)))
        if not held:
            return
        ids, h, place, hashes = (np.concatenate(x) for x in zip(*held))
        del held
        lost = np.flatnonzero(_later(hashes, ids))
        to = (h[lost].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((place[lost], ids[lost], h[lost], to))
        lost, to = lost[order], to[order]
        for part, at in zip(np.split(lost, np.flatnonzero(to[1:] != to[:-1]) + 1) if len(to) else (), np.unique(to)):
            yield int(at), True, *_pack(ids[part], h[part], place[part]), None

    return lambda batches: _rows(rows(batches), _PACKED_ARROW)


def _merge(size: int):
    """One task has all lost windows of its documents."""
    def intervals(batches) -> Iterator[pa.RecordBatch]:
        held = [_unpack(runs, places) for batch in batches
                for runs, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        if not held:
            return
        ids, h, place = (np.concatenate(x) for x in zip(*held))
        del held
        order = np.lexsort((place, h, ids))
        ids, h, place = ids[order], h[order], place[order]
        doc = np.concatenate([[True], (ids[1:] != ids[:-1]) | (h[1:] != h[:-1])])
        new = doc | np.concatenate([[True], place[1:] > place[:-1] + size])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(place)) - 1
        docs = np.flatnonzero(doc)
        offsets = pa.array(np.append(np.searchsorted(begin, docs), len(begin)), pa.int32())
        out = pa.RecordBatch.from_arrays(
            [pa.array(ids[docs]), pa.array(h[docs]),
             pa.ListArray.from_arrays(offsets, pa.array(place[begin], pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(place[last] + size, pa.int32()))], names=_SPANS_ARROW.names)
        for at in range(0, len(out), 10_000):
            yield out.slice(at, 10_000)

    return intervals


def removal_intervals(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, h, starts, ends): for every text that loses words, its doc_id, its
    ``xxhash64`` and the maximal intervals of word places (ends exclusive).
    Equal rows have one."""
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"),
        F.col("text").cast("string").alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("n")).first()["n"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    dealt = map_arrow(texts, _deal(size, buckets), _PACKED).repartitionById(buckets, "bucket")
    lost = map_arrow(dealt, _judge(buckets), _PACKED).repartitionById(buckets, "bucket")
    return map_arrow(lost, _merge(size), _SPANS).dropDuplicates(["id", "h"])


def _cut(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, ends = (batch.column(i) for i in (1, 2, 3))
        n_words, n_removed, kept = [], [], []
        for text, begin, end in zip(texts, starts, ends):
            found = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
            n_words.append(len(found))
            cut = 0
            if begin.is_valid:
                left, at = [], 0
                for a, b in zip(begin.as_py(), end.as_py()):
                    left += found[at:a]
                    at, cut = b, cut + b - a
                found = left + found[at:]
            n_removed.append(cut)
            kept.append(b" ".join(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()), starts, ends],
            names=["doc_id", "n_words", "n_removed", "kept", "starts", "ends"])


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, starts, ends) of every row: the words
    left, joined by single spaces, and the intervals removed (null: none)."""
    found = broadcast_if_small(materialize(removal_intervals(docs, size), "removal-intervals"))
    text, key = F.col("text").cast("string"), F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_hash"))
    rows = rows.join(found, (F.col("doc_id") == F.col("id")) & (F.col("_hash") == F.col("h")), "left") \
        .select("doc_id", "text", "starts", "ends")
    return map_arrow(rows, _cut, "doc_id long, n_words long, n_removed long, kept string, starts array<int>, ends array<int>")
