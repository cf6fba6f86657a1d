"""Token ids in patched frame-of-reference blocks.

File format (little-endian), one file per shard of consecutive documents:

    magic "LXPFOR01"
    blocks: minimum u32, count u16, exceptions u16, width u8, then the packed
            low bits of (id - minimum), exception places u16, exception high
            bits u32
    index:  per block its byte offset u64 and first id number u64
    documents: doc_id i64, has-id u8, number of ids before it u64 (one more
            entry for the end)
    tail:   byte offset of the index u64, blocks u64, documents u64, magic

``width`` is the smallest that holds a chosen percentile of a block's values;
the rest are exceptions, whose high bits are stored aside. The index allows
reading any range of ids without the blocks before it.

Writing range-partitions documents by id, so a shard is one task's sorted
range; a shard is written under another name and renamed, so a repeated task
leaves one whole file. Only one row per shard (path, counts) travels on.

Defined results: a null or empty text has no ids of its own, only the end id;
documents come in ascending id order, null ids first; rows sharing an id are
ordered by a hash of their text; an empty table gives no shards and no rows.
Other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexisieve.llm.tasks import WholeFile, batch_rows, map_arrow, open_file
from lexisieve.session import materialize, scratch_path

MAGIC = b"LXPFOR01"
BLOCK = 2048
PERCENTILE = 90
MAX_CHUNKS = 400_000
LONG_CHUNK = 64
OUT_BYTES = 4 << 20
_HEAD = struct.Struct("<IHHB")
_TAIL = struct.Struct("<QQQ8s")


def pack_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of at most 65,535 ids."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    mark = int(np.partition(rest, k := min(len(rest) - 1, len(rest) * percentile // 100))[k])
    width = max(1, mark.bit_length())
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(rest.view(np.uint8), bitorder="little").reshape(-1, 32)[:, :width]
    return b"".join((_HEAD.pack(low, len(ids), len(over), width), np.packbits(bits, bitorder="little").tobytes(),
                     over.astype(np.uint16).tobytes(), (rest[over] >> np.uint32(width % 32)).astype(np.uint32).tobytes()))


def unpack_block(data: bytes) -> np.ndarray:
    low, count, n_over, width = _HEAD.unpack_from(data)
    at = _HEAD.size
    size = (count * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * width, bitorder="little")
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits.reshape(count, width)
    rest = np.packbits(wide, axis=1, bitorder="little").view(np.uint32).ravel()
    at += size
    over = np.frombuffer(data, np.uint16, n_over, at)
    if n_over:
        rest[over] |= np.frombuffer(data, np.uint32, n_over, at + 2 * n_over) << np.uint32(width)
    return rest + np.uint32(low)


class ShardWriter:
    """Writes one shard; holds at most one block of ids and the two indexes."""

    def __init__(self, location: str, block: int = BLOCK, percentile: int = PERCENTILE):
        self.file, self.block, self.percentile = WholeFile(location), block, percentile
        self.file.write(MAGIC)
        self.at, self.total, self.held, self.n_held = len(MAGIC), 0, [], 0
        self.offsets, self.firsts, self.docs, self.starts = [], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.total)
        self.total += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        upto = len(ids) if last else len(ids) - len(ids) % self.block
        for k in range(0, upto, self.block):
            data = pack_block(ids[k:k + self.block], self.percentile)
            self.offsets.append(self.at)
            self.firsts.append(self.total - len(ids) + k)
            self.file.write(data)
            self.at += len(data)
        self.held, self.n_held = ([ids[upto:]], len(ids) - upto) if upto < len(ids) else ([], 0)

    def close(self) -> None:
        self._flush(True)
        self.file.write(np.array(self.offsets, np.uint64).tobytes() + np.array(self.firsts, np.uint64).tobytes())
        known = np.array([d is not None for d in self.docs], np.uint8)
        self.file.write(np.array([d or 0 for d in self.docs], np.int64).tobytes() + known.tobytes()
                        + np.array([*self.starts, self.total], np.uint64).tobytes())
        self.file.write(_TAIL.pack(self.at, len(self.offsets), len(self.docs), MAGIC))
        self.file.close()


class ShardReader:
    """Random and sequential access to one shard."""

    def __init__(self, location: str):
        self.file = open_file(location)
        size = self.file.size()
        index, blocks, docs, magic = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{location} is not a shard")
        data = self.file.read_at(size - _TAIL.size - index, index)
        self.offsets = np.append(np.frombuffer(data, np.uint64, blocks), np.uint64(index)).astype(np.int64)
        self.firsts = np.frombuffer(data, np.uint64, blocks, 8 * blocks).astype(np.int64)
        ids = np.frombuffer(data, np.int64, docs, 16 * blocks).tolist()
        known = np.frombuffer(data, np.uint8, docs, 16 * blocks + 8 * docs)
        self.docs = [d if k else None for d, k in zip(ids, known)]
        self.starts = np.frombuffer(data, np.uint64, docs + 1, 16 * blocks + 9 * docs).astype(np.int64)

    def read(self, begin: int, end: int) -> np.ndarray:
        """Ids number ``begin`` to ``end`` (exclusive) of the shard."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.firsts, [begin, end - 1], "right") - 1
        data = self.file.read_at(int(self.offsets[b + 1] - self.offsets[a]), int(self.offsets[a]))
        cuts = self.offsets[a:b + 2] - self.offsets[a]
        ids = np.concatenate([unpack_block(data[cuts[i]:cuts[i + 1]]) for i in range(b - a + 1)])
        return ids[begin - self.firsts[a]:end - self.firsts[a]]

    def runs(self, ids: int = OUT_BYTES // 4) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, last + 1, their ids) by runs of about ``ids`` ids."""
        at, n = 0, len(self.docs)
        while at < n:
            to = min(n, max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + ids, "right")) - 1))
            yield at, to, self.read(int(self.starts[at]), int(self.starts[to]))
            at = to


_SPACES = bytes.maketrans(b"\n\t\r", b"   ")
_STOP, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".,")] = True
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = True


def _stops_apart(texts: list[bytes]) -> list[bytes]:
    """The texts with a space before each full stop or comma that ends a
    letter's or digit's chunk; all texts are handled as one byte array."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at = np.flatnonzero(_STOP[raw])
    if not len(at):
        return texts
    ends = np.cumsum([len(x) for x in texts])
    edge = np.zeros(len(raw) + 1, bool)
    edge[0] = edge[ends] = True
    last = edge[at + 1] | (raw[np.minimum(at + 1, len(raw) - 1)] == 32)
    at = at[last & ~edge[at] & _LETTER[raw[at - 1]]]
    data = np.insert(raw, at, 32).tobytes()
    ends += np.searchsorted(at, ends)
    return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class WordEncoder:
    """The tokenizer over whole texts, with a table of known chunks.

    Its pre-tokenizer drops white space, cuts there and between a letter or
    digit and punctuation, and its normaliser lowers letters; so a text's ids
    are those of its chunks in turn. A-Z are lowered beforehand unless the
    text has combining marks (which may join with a small letter only). What
    is used again outlives a full table.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.word_end[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @staticmethod
    def chunks(texts: list[str | None]) -> list[list[bytes]]:
        spaced = []
        for text in texts:
            data = (text or "").encode("utf-8").translate(_SPACES)
            if b"\xcc" not in data and b"\xcd" not in data:  # U+0300 to U+036F
                data = data.lower()
            spaced.append(data)
        return [x.split(b" ") for x in _stops_apart(spaced)]

    def _encode(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of unknown chunks. A chunk of letters is one word to the
        tokenizer and its last id, alone, is a word-end id: such chunks are
        encoded as one text and cut after those ids."""
        texts = [x.decode("utf-8") for x in chunks]
        plain = [i for i, x in enumerate(texts) if x.isalpha()]
        other = [i for i, x in enumerate(texts) if not x.isalpha()]
        for k in range(0, len(plain), 2048):
            part = plain[k:k + 2048]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in part)],
                                                            add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(part):
                other += part
                continue
            data, cuts = ids.tobytes(), (4 * ends).tolist()
            yield from zip((chunks[i] for i in part), (data[a:b] for a, b in zip([0, *cuts], cuts)))
        for k in range(0, len(other), 4096):
            part = other[k:k + 4096]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
                yield chunks[i], array("I", e.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian u32 bytes."""
        chunks = self.chunks(texts)
        if len(self.new) >= MAX_CHUNKS:
            self.old, self.new = self.new, {}
        seen = set().union(*chunks)
        here, missing = {}, []
        for x in seen:
            got = self.new.get(x)
            if got is None:
                got = self.old.get(x)
                if got is None:
                    missing.append(x)
                    continue
                self.new[x] = got
            here[x] = got
        for x, ids in self._encode(missing):
            here[x] = ids
            if len(x) <= LONG_CHUNK:
                self.new[x] = ids
        return [b"".join(map(here.__getitem__, c)) for c in chunks]


_encoders: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    if hash(spec) not in _encoders:
        _encoders.clear()
        _encoders[hash(spec)] = WordEncoder(spec)
    return _encoders[hash(spec)]


_MANIFEST = pa.schema([("shard", pa.int64()), ("location", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _writer(spec_cast, folder: str, end_id: int, block: int, percentile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out = _encoder(spec_cast.value), None
        number = TaskContext.get().partitionId()
        location = f"{folder}/shard-{number:08d}.pfor"
        end = np.array([end_id], np.uint32).tobytes()
        gc.disable()  # the tables hold many small objects and no cycles
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            while at < len(keys):  # about 4 MB of text at a time
                to, size = at, 0
                while to < len(keys) and (to == at or size < 4 << 20):
                    size += len(texts[to].as_buffer() or b"") if texts[to].is_valid else 0
                    to += 1
                for key, ids in zip(keys[at:to], encoder.encode(texts.slice(at, to - at).to_pylist())):
                    out = out or ShardWriter(location, block, percentile)
                    out.add(key, np.frombuffer(ids + end, np.uint32))
                at = to
        if out:
            out.close()
            yield batch_rows(_MANIFEST, [(number, location, len(out.docs), out.total)])
    return run


def write_token_shards(docs: DataFrame, spec: str, folder: str, end_id: int = 1, block: int = BLOCK,
                       percentile: int = PERCENTILE) -> DataFrame:
    """Encode (doc_id, text) and write the shards. Returns the manifest
    (shard, location, n_docs, n_ids, first_id): one row per shard, ``first_id``
    being the ids of all shards before it."""
    cast = docs.sparkSession.sparkContext.broadcast(spec)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    made = map_arrow(rows, _writer(cast, folder, end_id, block, percentile),
                     "shard long, location string, n_docs long, n_ids long")
    manifest = materialize(made, "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = ShardReader(row["location"])
            for a, b, ids in shard.runs():
                cuts = shard.starts[a:b + 1]
                data = pa.Array.from_buffers(
                    pa.binary(), b - a, [None, pa.py_buffer(((cuts - cuts[0]) * 4).astype(np.int32).tobytes()),
                                         pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.docs[a:b], pa.int64()), pa.array(cuts[:-1] + row["first_id"]),
                     pa.array(np.diff(cuts)), data], ["doc_id", "start", "n_ids", "ids"])


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_ids, ids) of every document, ``ids`` being
    little-endian u32 bytes; each task reads whole shards block by block."""
    shards = manifest.count()
    spread = manifest.repartition(max(1, shards))
    return map_arrow(spread, _reader, "doc_id long, start long, n_ids long, ids binary")


def tokenizer_spec(path: str) -> str:
    """The tokenizer's file (a vocabulary of fixed size), read by the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-shards")
