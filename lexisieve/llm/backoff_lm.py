"""Scoring with a weighted backoff automaton.

Unigrams are counted exactly over all training tokens. A state of the
automaton stands for the previous token; its arcs are the bigrams seen at least
``MIN_ARC`` times, each with its interpolated probability (absolute discount),
and its failure arc leads to the root with the weight of the unseen rest. One
left-to-right traversal of a text carries the state and adds log10 weights.

Every training word is a state and every bigram seen ``MIN_ARC`` times an arc,
whatever the size of the corpus: both are distributed tables. The tasks get the
frequent part of them as a cache, at most ``MAX_WORDS`` words and ``MAX_ARCS``
arcs between these (bounds in whole count levels). What the traversal does not
find there it hands on, and a distributed join adds the weights: for a word its
own and that of its failure arc (a text's previous tokens are its tokens, in
another order), for a bigram what its arc has over the failure path. A bitmap of
2^``FILTER_BITS`` bits, broadcast, tells most bigrams that are no arcs, so that
these are not joined. The bounds change the work, not the result. Counting is
aggregated in the task before each shuffle; bigrams are shuffled in packed
blocks by a hash of the bigram, about ``BUCKET_PAIRS`` tokens a bucket, and
added up there bucket by bucket.

Tokens are words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, then one end; a
document's first state is that of the end token. Words and bigrams are 64-bit
hashes.

Defined results: null or empty text: the end token alone; a null id belongs to
no fold (its crc32 is null) and is scored but not learnt from; without
training rows every probability is 1 (score 0); rows sharing an id are scored
one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.tasks import map_arrow
from lexisieve.session import materialize

END = np.uint64(0xE0D0C0B0A0908071)
MAX_WORDS = 1 << 20
MAX_ARCS = 1 << 21
MIN_ARC = 2
DISCOUNT = 0.5
HELD_TOKENS = 4 << 20
ROWS = 1 << 16
TURN = 23
BUCKET_PAIRS = 1 << 20
MAX_PARTITIONS = 1 << 15
FILTER_BITS = 28
LEAST_REST = 1e-12


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last + 1, token hashes, their row number), with end tokens."""
    for a, b, h, first in W.word_runs(batch.column("text"), "space"):
        rows = b - a
        n = np.diff(first) + 1
        out = np.empty(len(h) + rows, np.uint64)
        ends = np.cumsum(n) - 1
        is_end = np.zeros(len(out), bool)
        is_end[ends] = True
        out[is_end], out[~is_end] = END, h
        yield a, b, out, np.repeat(np.arange(rows), n)


def _summed(held: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["key", "n"])


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for _, _, h, _ in _sequences(batch):
            held.append(h)
            size += len(h)
            if size >= HELD_TOKENS:
                yield _summed(held)
                held, size = [], 0
    if held:
        yield _summed(held)


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def _previous(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The token before each token; the end token before a text's first."""
    out = np.empty_like(h)
    out[1:] = h[:-1]
    if len(h):
        out[0] = END
        out[1:][row[1:] != row[:-1]] = END
    return out


def _pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Hash of a bigram; with ``u`` it gives ``v`` back (see ``_second``)."""
    return u ^ ((v << np.uint64(TURN)) | (v >> np.uint64(64 - TURN)))


def _second(key: np.ndarray, u: np.ndarray) -> np.ndarray:
    turned = key ^ u
    return (turned >> np.uint64(TURN)) | (turned << np.uint64(64 - TURN))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _packed_pairs(held: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row a bucket: the bigrams held, counted and in the order of their
    first word, which is written once a run of equals."""
    key, u = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n, key, u = np.diff(first, append=len(key)).astype(np.uint32), key[first], u[order[first]]
    bucket = (W.mix(key) >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((u, bucket))
    n, key, u, bucket = n[order], key[order], u[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64)).tolist()
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            part = u[a:b]
            run = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (
                    part[run], np.diff(run, append=b - a).astype(np.uint32), key[a:b], n[a:b]))],
                ["bucket", "u", "runs", "key", "n"])


def _count_pairs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, h, row in _sequences(batch):
                u = _previous(h, row)
                held.append((_pair(u, h), u))
                size += len(h)
                if size >= HELD_TOKENS:
                    yield from _packed_pairs(held, buckets)
                    held, size = [], 0
        if size:
            yield from _packed_pairs(held, buckets)
    return run


def _added_pairs(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(key, u, n) with one entry a bigram, of several such lists."""
    key, u, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], u[order[first]], np.add.reduceat(n[order], first)


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up each bucket (their rows come together); bigrams seen ``MIN_ARC`` times stay."""
    def arcs() -> Iterator[pa.RecordBatch]:
        key, u, n = _added_pairs(held)
        seen = n >= MIN_ARC
        out = pa.RecordBatch.from_arrays([_long(key[seen]), _long(u[seen]), pa.array(n[seen])], ["key", "u", "n"])
        for at in range(0, len(out), ROWS):
            yield out.slice(at, ROWS)

    held, size, added, at = [], 0, 0, None
    for batch in batches:
        for i, bucket in enumerate(batch.column("bucket").to_pylist()):
            if bucket != at and held:
                yield from arcs()
                held, size, added = [], 0, 0
            at = bucket
            data = {c: batch.column(c)[i].as_buffer() for c in ("u", "runs", "key", "n")}
            u = np.repeat(np.frombuffer(data["u"], np.uint64), np.frombuffer(data["runs"], np.uint32))
            held.append((np.frombuffer(data["key"], np.uint64), u, np.frombuffer(data["n"], np.uint32).astype(np.int64)))
            size += len(u)
            if size > 2 * added + BUCKET_PAIRS:  # bigrams of many tasks are alike
                held = [_added_pairs(held)]
                size = added = len(held[0][0])
    if held:
        yield from arcs()


def _level(c):
    """Count levels, sixteen to a doubling: at most about a thousand."""
    return F.floor(16 * F.log2(c)).cast("int")


def _most_frequent(counts: DataFrame, most: int, least: int = 1) -> DataFrame:
    """The rows (key, n) of the highest count levels that hold at most ``most`` rows."""
    sizes = counts.where(F.col("n") >= least).groupBy(_level(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("k"))
    total, lowest = 0, None
    for r in sorted(sizes.collect(), key=lambda r: -r["level"]):
        total += r["k"]
        if total > most:
            break
        lowest = r["level"]
    return counts.where((F.col("n") >= least) & (_level(F.col("n")) >= F.lit(1 << 20 if lowest is None else lowest)))


def _arrays(df: DataFrame, *more: str) -> tuple[np.ndarray, ...]:
    """(keys, counts, ``more``) sorted by key, of a frame with a bound on its rows."""
    t = df.select("key", "n", *more).toArrow()
    keys = t.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], *(t.column(c).to_numpy()[order] for c in ("n", *more))


class Automaton:
    """States, arcs and weights as sorted arrays. ``rest`` is the unseen rest of
    each context; without it the arcs given are all there are, as with ``whole``."""

    def __init__(self, words, counts, contexts, context_counts, arcs, arc_counts, total: int, distinct: int,
                 rest: np.ndarray | None = None, whole: bool = True):
        self.whole = whole
        self.words, self.contexts, self.arcs = words, contexts, arcs
        self.floor = total + 0.5 * (distinct + 1)
        self.word_weight = np.log10((counts + 0.5) / self.floor)
        context_p = (context_counts + 0.5) / self.floor
        u, v = (arcs >> np.uint64(32)).astype(np.int64), (arcs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        direct = (arc_counts - DISCOUNT) / context_counts[u] if len(arcs) else np.zeros(0)
        if rest is None:
            rest = 1 - np.bincount(u, direct, minlength=len(contexts)) if len(arcs) else np.ones(len(contexts))
        rest = np.maximum(rest, LEAST_REST)
        self.failure = np.log10(rest)
        self.arc_weight = np.log10(direct + rest[u] * context_p[v]) if len(arcs) else np.zeros(0)

    def walk(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(base weight, score weight, in the word table, to be looked up as a
        bigram) of every token. For a word outside the table both lack its own
        weight, and the next token's score lacks its failure weight."""
        at = _find(self.words, h)
        known = at >= 0
        base = np.where(known, self.word_weight[at] if len(self.words) else 0.0, 0.0)
        there = at if self.contexts is self.words else _find(self.contexts, h)
        state = np.empty_like(there)
        if len(h):
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            state[1:] = there[:-1]
            state[starts] = _find(self.contexts, np.array([END]))
        score = base.copy()
        inside = state >= 0
        score[inside] += self.failure[state[inside]]
        both = np.flatnonzero(inside & (there >= 0))
        arc = _find(self.arcs, (state[both].astype(np.uint64) << np.uint64(32)) | there[both].astype(np.uint64))
        score[both[arc >= 0]] = self.arc_weight[arc[arc >= 0]]
        look = np.full(len(h), not self.whole)
        look[both[arc >= 0]] = False
        return base, score, known, look


class Model(NamedTuple):
    cache: Automaton
    words: DataFrame  # (key, n, rest) of every training word
    arcs: DataFrame | None  # (key, gain) of every arc; None if the cache has them all
    bits: np.ndarray | None  # see _arc_filter; None likewise
    total: int
    distinct: int

    @property
    def floor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def _cached_gains(cast, floor: float):
    """The gain of each arc between cached words; of others the two words, and
    what the cache says of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, rest = cast.value
        for batch in batches:
            key, u = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "u"))
            n = batch.column("n").to_numpy()
            v = _second(key, u)
            i, j = _find(words, u), _find(words, v)
            both = (i >= 0) & (j >= 0)
            gain = np.zeros(len(key))
            p, r = (counts[j[both]] + 0.5) / floor, rest[i[both]]
            gain[both] = np.log10((n[both] - DISCOUNT) / counts[i[both]] + r * p) - np.log10(r) - np.log10(p)

            def of(x: np.ndarray, at: np.ndarray) -> pa.Array:
                return pa.array(x[at] if len(x) else np.zeros(len(at), x.dtype), mask=(at < 0) | both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(gain, mask=~both), *(pa.array(x, mask=both) for x in (
                    u.view(np.int64), v.view(np.int64), n)), of(counts, i), of(rest, i), of(counts, j)],
                ["key", "gain", "u", "v", "n", "u_n", "u_rest", "v_n"])
    return run


def _gains(pairs: DataFrame, words: DataFrame, cached: tuple[np.ndarray, ...], floor: float, distinct: int) -> DataFrame:
    """(key, gain) of every arc: its weight over that of the failure path.
    Words outside the cache are rare, so no key of these joins is hot."""
    cast = pairs.sparkSession.sparkContext.broadcast(cached)
    arcs = materialize(map_arrow(pairs, _cached_gains(cast, floor), "key long, gain double, u long, v long, n long, "
                                 "u_n long, u_rest double, v_n long"), "arc-words")
    done = arcs.where("gain is not null").select("key", "gain")
    if len(cached[0]) == distinct:
        return done
    u = words.select(F.col("key").alias("u"), F.col("n").alias("u_n"), F.col("rest").alias("u_rest"))
    v = words.select(F.col("key").alias("v"), F.col("n").alias("v_n"))
    arcs = arcs.where("gain is null").drop("gain")
    arcs = arcs.where("u_n is not null").unionByName(arcs.where("u_n is null").drop("u_n", "u_rest").join(u, "u"))
    arcs = arcs.where("v_n is not null").unionByName(arcs.where("v_n is null").drop("v_n").join(v, "v"))
    p = (F.col("v_n") + 0.5) / F.lit(floor)
    direct = (F.col("n") - DISCOUNT) / F.col("u_n")
    return done.unionByName(arcs.select(
        "key", (F.log10(direct + F.col("u_rest") * p) - F.log10("u_rest") - F.log10(p)).alias("gain")))


def _arc_filter(pairs: DataFrame) -> np.ndarray:
    """A bit for the upper ``FILTER_BITS`` bits of every arc's key, in words of
    64. A bigram whose bit is not set is no arc; the others are looked up."""
    found = pairs.select(F.shiftrightunsigned("key", 70 - FILTER_BITS).alias("at"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 as int))").alias("bits")) \
        .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _may_be_arc(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key >> np.uint64(64 - FILTER_BITS)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def train(docs: DataFrame) -> Model:
    texts = docs.select("text")
    counts = materialize(map_arrow(texts, _count_tokens, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")),
                         "token-counts")
    r = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(r["n"]), int(r["v"])
    buckets = (total >> BUCKET_PAIRS.bit_length() - 1) + 1
    packed = map_arrow(texts, _count_pairs(buckets), "bucket int, u binary, runs binary, key binary, n binary")
    packed = packed.repartition(min(buckets, MAX_PARTITIONS), "bucket").sortWithinPartitions("bucket")
    pairs = materialize(map_arrow(packed, _sum_pairs, "key long, u long, n long"), "pair-counts")
    seen = pairs.groupBy(F.col("u").alias("key")).agg(F.sum(F.col("n") - DISCOUNT).alias("seen"))
    words = materialize(counts.join(seen, "key", "left").select("key", "n", F.greatest(
        1 - F.coalesce("seen", F.lit(0.0)) / F.col("n"), F.lit(LEAST_REST)).alias("rest")), "word-states")
    cached = _arrays(_most_frequent(words, MAX_WORDS), "rest")
    key, arc_counts, u = _arrays(_most_frequent(pairs, MAX_ARCS, MIN_ARC), "u")
    u = u.view(np.uint64)
    i, j = _find(cached[0], u), _find(cached[0], _second(key, u))
    both = (i >= 0) & (j >= 0)
    arcs, arc_counts = (i[both].astype(np.uint64) << np.uint64(32)) | j[both].astype(np.uint64), arc_counts[both]
    order = np.argsort(arcs)
    whole = len(arcs) == pairs.count()
    cache = Automaton(cached[0], cached[1], cached[0], cached[1], arcs[order], arc_counts[order], total, distinct,
                      cached[2], whole)
    if whole:
        return Model(cache, words, None, None, total, distinct)
    return Model(cache, words, _gains(pairs, words, cached, cache.floor, distinct), _arc_filter(pairs), total, distinct)


_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()),
                     ("rest", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64()))])


def _lists(values: np.ndarray, row: np.ndarray, taken: np.ndarray, rows: int) -> pa.ListArray:
    """The taken values of each row."""
    ends = np.cumsum(np.bincount(row[taken], minlength=rows))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), _long(values[taken]))


def _scorer(cast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, bits), number = cast.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b, h, row in _sequences(batch):
                base, score, known, look = model.walk(h, row)
                pair, rows = _pair(_previous(h, row), h), b - a
                if bits is not None:
                    look &= _may_be_arc(bits, pair)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(number, number + rows)), batch.column("doc_id").slice(a, rows),
                    batch.column("held_out").slice(a, rows), pa.array(np.bincount(row, minlength=rows)),
                    pa.array(np.bincount(row[known], minlength=rows)), pa.array(np.bincount(row, base, minlength=rows)),
                    pa.array(np.bincount(row, score, minlength=rows)),
                    _lists(h, row, ~known, rows), _lists(pair, row, look, rows)], schema=_SCORED)
                number += rows
    return run


def score(docs: DataFrame, fold: int = 1, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document; rows with crc32(doc_id) mod ``folds`` = ``fold`` are
    held out, all others are learnt from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold)
    model = train(rows.where(~F.col("held_out")))
    cast = docs.sparkSession.sparkContext.broadcast((model.cache, model.bits))
    walked = materialize(map_arrow(
        rows, _scorer(cast), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
        "score double, rest array<long>, pairs array<long>"), "walked")
    rest = walked.select("row", F.explode("rest").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("tf"))
    weight = F.col("tf") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(model.floor))
    found = rest.join(model.words, "key", "left").select(
        "row", F.when(F.col("n").isNotNull(), F.col("tf")).alias("k"), weight.alias("base"),
        (weight + F.col("tf") * F.log10(F.coalesce("rest", F.lit(1.0)))).alias("score"))
    if model.arcs is not None:
        gains = walked.select("row", F.explode("pairs").alias("key")).join(model.arcs, "key")
        found = found.unionByName(gains.select("row", F.lit(None).cast("long").alias("k"), F.lit(0.0).alias("base"),
                                               F.col("gain").alias("score")))
    found = found.groupBy("row").agg(F.sum("base").alias("_b"), F.sum("score").alias("_s"), F.sum("k").alias("_k"))
    out = walked.drop("rest", "pairs").join(found, "row", "left")
    return out.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "n_tokens",
                      (F.col("known") + F.coalesce("_k", F.lit(0))).alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("_b", F.lit(0.0))).alias("base_score"),
                      (F.col("score") + F.coalesce("_s", F.lit(0.0))).alias("score"))
