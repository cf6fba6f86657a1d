"""Phrase collocations per language by direct-address counting of id pairs.

Words are numbered by falling frequency. A phrase of k words is the pair of
the number of its first k - 1 words and the number of its last one; pairs are
cut into square tiles. A task counts a full tile with one dense ``bincount``
over its cells and the others as sorted coordinates; both leave it as sorted
codes with counts, dealt evenly over buckets, where they are summed. The
frequent pairs are numbered by falling frequency again, and the next length
counts (pair, word): only places where both the first and the last k - 1 words
are frequent take part.

Texts are read twice, to count the words and to write their numbers; all later
lengths read the numbers, and only the places still in play. Look-up tables go
to the tasks in slices of ``SLICE`` entries, one pass each, so that what is
broadcast is bounded and no entry is left out. Words of a language are looked
up by 64-bit hashes.

Defined results: a null text is empty, a null lang is ``und``; a doc_id is not
needed; repeated rows count as often as they occur; all products are exact
decimals; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.tasks import map_arrow
from lexisieve.operators.ordinal import dense_ordinal
from lexisieve.session import broadcast_if_small, materialize

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
TILE = 1024
DENSE = TILE * TILE // 64
DENSE_TILES = 8
SLICE = 1 << 22
BLOCK = 1 << 18
PENDING = 1 << 19
_BUCKET_ENTRIES = 1 << 22
_WORD = r"[^.,;:!?\x0A-\x0D\x20\x09]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BLOCKS = "words binary, left binary, keys binary"
_BLOCKS_ARROW = pa.schema([("words", pa.binary()), ("left", pa.binary()), ("keys", pa.binary())])
_COUNTS_ARROW = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])
_SUMS_ARROW = pa.schema([("code", pa.int64()), ("n", pa.int64())])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n)"""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(_WORD), F.lit(0))).alias("word")) \
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("lang", F.translate("word", _UPPER, _LOWER).alias("word")).agg(F.sum("n").alias("n"))


def _keys(word_hashes: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return W.mix(word_hashes + W.mix(langs.view(np.uint64)))


def _key_words(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = W.hash_words(batch.column(2).to_pylist())
        keys = _keys(h, batch.column(1).to_numpy(zero_copy_only=False)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys)], names=["id", "key"])


def _slices(table: DataFrame, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted keys, their ids) of ``table`` (id, key) by slices of ids."""
    for at in range(0, max(n, 1), SLICE):
        part = table.where((F.col("id") >= at) & (F.col("id") < at + SLICE)).select("id", "key").toArrow()
        keys = part.column("key").to_numpy().astype(np.int64)
        order = np.argsort(keys, kind="stable")
        yield keys[order], part.column("id").to_numpy().astype(np.int64)[order]


def _look_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of the keys, -1 for those that the table does not have."""
    if not len(table[0]):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], -1)


def _blocks(parts: Iterator[tuple[np.ndarray, ...]], dtype) -> Iterator[pa.RecordBatch]:
    """Record batches of one block: arrays of about BLOCK places."""
    held, n = [], 0

    def batch():
        words, left, keys = (np.concatenate(x) for x in zip(*held))
        row = [words.astype(dtype).tobytes(), left.astype(dtype).tobytes(), keys.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], schema=_BLOCKS_ARROW)

    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= BLOCK:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def _encode(table, last: bool, dtype) -> Callable:
    """Texts to word numbers: -1 ends a piece and stands for a word that is in
    no later slice; -2 for a word still to be looked up, its key in ``keys``."""
    breaks = np.zeros(256, bool)
    breaks[list(b".,;:!?\n\x0b\x0c\r")] = True

    def parts(batches):
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offsets = W.text_bytes(batch.column(1))
            for a, b in W.pieces(offsets):
                off, part = offsets[a:b + 1] - offsets[a], raw[offsets[a]:offsets[b]]
                starts, ends, first = W.spans(part, off, "phrase")
                if not len(starts):
                    continue
                keys = _keys(W.hashes(part, starts, ends), np.repeat(langs[a:b], np.diff(first))).view(np.int64)
                ids = _look_up(keys, table.value)
                if not last:
                    ids[ids < 0] = -2
                marks = np.concatenate([[0], np.cumsum(breaks[part])])
                new = np.ones(len(starts), bool)
                new[1:] = marks[starts[1:]] > marks[ends[:-1]]
                new[first[:-1][np.diff(first) > 0]] = True
                words = np.insert(ids, np.flatnonzero(new), -1)
                yield words, words[:0], keys[ids == -2]

    return lambda batches: _blocks(parts(batches), dtype)


def _resolve_words(table, last: bool, dtype) -> Callable:
    """A further slice of the words."""
    def parts(batches):
        for words, left, keys in _read(batches, dtype):
            words = words.copy()
            keys = keys.view(np.int64)
            at = np.flatnonzero(words == -2)
            found = _look_up(keys, table.value)
            words[at] = found if last else np.where(found < 0, -2, found)
            yield words, left, keys[found < 0] if not last else keys[:0]

    return lambda batches: _blocks(parts(batches), dtype)


def _read(batches, dtype) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(3))):
            yield tuple(np.frombuffer(x.as_buffer(), d).astype(np.int64) if d is not np.uint64 else np.frombuffer(x.as_buffer(), d)
                        for x, d in zip(row, (dtype, dtype, np.uint64)))


def _codes(words: np.ndarray, left: np.ndarray, k: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes) of the phrases of k words whose first and last k - 1
    words have numbers. ``left`` is not kept for single words."""
    left = left if k > 2 else words
    at = np.flatnonzero((left[:-1] >= 0) & (left[1:] >= 0))
    return at, left[at] * n_words + words[at + k - 1]


def _resolve_phrases(table, first: bool, last: bool, k: int, n_words: int, dtype) -> Callable:
    """Places to numbers of phrases of k words. Until the last slice the new
    numbers wait in ``keys``; then places in no phrase go."""
    def parts(batches):
        for words, left, keys in _read(batches, dtype):
            new = np.full(len(words), -1, np.int64) if first else keys.view(np.int64).copy()
            at, codes = _codes(words, left, k, n_words)
            found = _look_up(codes, table.value)
            new[at[found >= 0]] = found[found >= 0]
            if not last:
                yield words, left, new.view(np.uint64)
                continue
            inside = np.zeros(len(words) + k, np.int64)
            at = np.flatnonzero(new >= 0)
            np.add.at(inside, at, 1)
            np.add.at(inside, at + k, -1)
            inside = np.cumsum(inside)[:len(words)] > 0
            keep = inside | np.concatenate([[True], inside[:-1]])  # one place between stays, as an end
            yield np.where(inside, words, -1)[keep], new[keep], keys[:0]

    return lambda batches: _blocks(parts(batches), dtype)


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[edge], np.add.reduceat(counts[order], edge) if len(edge) else counts[:0]


class TileCounter:
    """Counts pairs of ids: full tiles cell by cell, the rest as sorted codes."""

    def __init__(self, n_words: int):
        self.n_words, self.tiles, self.pending, self.size = n_words, {}, [], 0

    def add(self, codes: np.ndarray) -> None:
        row, col = codes // self.n_words, codes % self.n_words
        tile = (row // TILE) * (self.n_words // TILE + 1) + col // TILE
        order = np.argsort(tile, kind="stable")
        tile = tile[order]
        edge = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])) if len(tile) else np.zeros(0, np.int64)
        size = np.diff(np.append(edge, len(tile)))
        sparse = np.ones(len(tile), bool)
        for a, n in zip(edge[size >= DENSE], size[size >= DENSE]):
            at = (int(row[order[a]]) // TILE, int(col[order[a]]) // TILE)
            if at not in self.tiles and len(self.tiles) >= DENSE_TILES:
                continue
            part = order[a:a + n]
            cells = np.bincount((row[part] % TILE) * TILE + col[part] % TILE, minlength=TILE * TILE).astype(np.uint32)
            if at in self.tiles:
                self.tiles[at] += cells
            else:
                self.tiles[at] = cells
            sparse[a:a + n] = False
        rest = codes[order[sparse]]
        self.pending.append(_summed(rest, np.ones(len(rest), np.int64)))
        self.size += len(self.pending[-1][0])

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted codes and their counts so far, in runs of about PENDING; the
        counter is empty then."""
        while self.tiles or self.pending:
            while self.tiles and self.size < PENDING:
                (row, col), cells = self.tiles.popitem()
                at = np.flatnonzero(cells)
                self.pending.append(((row * TILE + at // TILE) * self.n_words + col * TILE + at % TILE, cells[at].astype(np.int64)))
                self.size += len(at)
            found, self.pending, self.size = self.pending, [], 0
            yield _summed(*(np.concatenate(x) for x in zip(*found)))


def _planes(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def _deal(k: int, n_words: int, buckets: int, dtype) -> Callable:
    def rows(codes, counts):
        bucket = (W.mix(codes.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        parts = np.split(order, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1) if len(order) else []
        for a in range(0, len(parts), 256):
            some = parts[a:a + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(bucket)[a:a + 256], pa.int32()),
                 pa.array([_planes(np.diff(codes[p], prepend=0)) for p in some], pa.binary()),
                 pa.array([_planes(counts[p]) for p in some], pa.binary())], schema=_COUNTS_ARROW)

    def count(batches):
        counter = TileCounter(n_words)
        for words, left, _ in _read(batches, dtype):
            counter.add(_codes(words, left, k, n_words)[1])
            if counter.size >= PENDING:
                for run in counter.drain():
                    yield from rows(*run)
        for run in counter.drain():
            yield from rows(*run)

    return count


def _sum(least: int) -> Callable:
    """One task has all counts of its codes."""
    def total(batches):
        held = [(np.cumsum(_unplanes(c)), _unplanes(n)) for batch in batches
                for c, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        if held:
            codes, counts = _summed(*(np.concatenate(x) for x in zip(*held)))
            frequent = counts >= least
            out = pa.RecordBatch.from_arrays([pa.array(codes[frequent]), pa.array(counts[frequent])], schema=_SUMS_ARROW)
            for at in range(0, len(out), 10_000):
                yield out.slice(at, 10_000)

    return total


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """The occurrences of words per language (lang, n_words), and by length,
    from one word, the phrases with ``min_count`` occurrences: (id, lang,
    phrase, n, first: counts of its first 1, 2, ... words, rest: counts of what
    follows those, front and back: ids of all but its last and its first word)."""
    spark = docs.sparkSession
    counts = materialize(word_counts(docs), "word-counts")
    totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("n_words")), "lang-totals")
    size = int(totals.agg(F.sum("n_words")).first()[0] or 0)
    words = dense_ordinal(counts.where(F.col("n") >= min_count).withColumn("_order", -F.col("n")),
                          ["_order", "lang", "word"], "id", 0)
    none = F.array().cast("array<bigint>")
    words = materialize(words.select("id", "lang", F.col("word").alias("phrase"), "n", none.alias("first"), none.alias("rest"),
                                     F.lit(None).cast("long").alias("front"), F.lit(None).cast("long").alias("back")), "words")
    n_words = max(words.count(), 1)
    dtype = np.dtype("<i4" if n_words < 1 << 31 else "<i8")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _BUCKET_ENTRIES))

    keyed = materialize(map_arrow(words.select("id", F.xxhash64("lang"), "phrase"), _key_words, "id long, key long"), "word-keys")
    texts = docs.select(F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit("und"))), F.col("text").cast("string"))
    blocks, held = texts, 0
    for table in _slices(keyed, n_words):
        held += SLICE
        step = _encode if held == SLICE else _resolve_words
        blocks = materialize(map_arrow(blocks, step(spark.sparkContext.broadcast(table), held >= n_words, dtype), _BLOCKS), "blocks-1")

    levels, numbers = [words], words.select("id", F.col("id").alias("key"))
    for k in range(2, longest + 1):
        dealt = map_arrow(blocks, _deal(k, n_words, buckets, dtype), "bucket int, codes binary, counts binary")
        sums = materialize(map_arrow(dealt.repartitionById(buckets, "bucket"), _sum(min_count), "code long, n long"), f"sums-{k}")
        ranked = dense_ordinal(sums.withColumn("_order", -F.col("n")), ["_order", "code"], "id", 0)
        ranked = materialize(ranked.select("id", F.col("code").alias("key"), "n"), f"pairs-{k}")
        levels.append(materialize(_described(ranked, levels, numbers, n_words, k), f"phrases-{k}"))
        n = ranked.count()
        if k == longest or not n:
            break
        if n * n_words >= 1 << 63 or n >= np.iinfo(dtype).max:
            raise ValueError("more phrases than their codes have room for")
        held = 0
        for table in _slices(ranked, n):
            step = _resolve_phrases(spark.sparkContext.broadcast(table), held == 0, held + SLICE >= n, k, n_words, dtype)
            blocks = materialize(map_arrow(blocks, step, _BLOCKS), f"blocks-{k}")
            held += SLICE
        numbers = ranked.select("id", "key")
    return totals, levels


def _described(ranked: DataFrame, levels: list[DataFrame], numbers: DataFrame, n_words: int, k: int) -> DataFrame:
    """The phrases of k words: what they start with is a phrase of k - 1 words,
    and so is what they end with, whose code follows from the former's end."""
    words, shorter = levels[0], levels[-1]
    front, back = F.expr(f"key div {n_words}"), F.col("key") % n_words
    out = ranked.select("id", "n", front.alias("front"), back.alias("last"))
    left = shorter.select(F.col("id").alias("front"), "lang", "phrase", F.col("n").alias("n_front"), F.col("first"),
                          F.col("back").alias("middle"))
    out = out.join(broadcast_if_small(left), "front") \
        .join(broadcast_if_small(words.select(F.col("id").alias("last"), F.col("phrase").alias("word"))), "last")
    end = F.col("last") if k == 2 else F.col("middle") * n_words + F.col("last")
    ending = shorter.select(F.col("id").alias("back"), F.col("n").alias("n_back"), F.col("rest"))
    out = out.withColumn("key", end).join(broadcast_if_small(numbers.select(F.col("id").alias("back"), "key")), "key") \
        .join(broadcast_if_small(ending), "back")
    return out.select("id", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "n",
                      F.concat("first", F.array("n_front")).alias("first"), F.concat(F.array("n_back"), "rest").alias("rest"),
                      "front", "back")


def _scored(phrases: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    wide = "decimal(18,0)"

    def cut(i: int):
        l, r = F.col("first")[i], F.col("rest")[i]
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("n").cast(wide) * F.col("n_words").cast(wide),
                                l.cast(wide) * r.cast(wide))
        return F.struct(score.alias("score"), F.lit(i).alias("k"), l.alias("l"), r.alias("r"))

    worst = F.array_min(F.array(*[cut(i) for i in range(k - 1)]))
    return phrases.join(broadcast_if_small(totals), "lang").select("lang", "phrase", "n", "n_words", worst.alias("cut"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases."""
    totals, levels = frequent_phrases(docs, min_count, longest)
    found = None
    for k in range(2, len(levels) + 1):
        kept = levels[k - 1]
        if k < len(levels):  # inside a longer one that is as frequent
            longer = levels[k]
            held = longer.select(F.col("front").alias("id"), "n").unionByName(longer.select(F.col("back").alias("id"), "n"))
            kept = kept.join(broadcast_if_small(held.distinct()), ["id", "n"], "left_anti")
        part = _scored(kept, totals, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("n").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), F.col("n_words").alias("n"), F.col("cut.score").alias("score"))
