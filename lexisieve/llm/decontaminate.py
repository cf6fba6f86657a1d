"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` cuts the documents into segments of about a million words;
a segment is one stored row with the document table and, for every test term
that occurs, its sorted list of word positions (documents are laid end to end
with a gap, so a phrase never crosses documents). ``phrase_hits`` answers all
windows of the test items on each segment: the list of a window's rarest term,
shifted by the term's offset, is intersected with the shifted lists of the
next rarer terms until it is empty or every term has been used.
``proximity_hits`` finds places where all words of a query lie within a span.

Segments are written once to the shared folder and read from there, so a lost
executor repeats only its own segments. Work needs no shuffle with one slice
of the test set. The test set goes to the tasks in slices of at most
``slice_bytes`` of text; the index keeps only the terms of the test set if that is
one slice of at most ``MAX_TERMS`` terms, otherwise all terms.

Defined results: null or wordless texts have no words and no hits; an item
without words, or with a null id, is ignored; rows sharing an ``item_id`` are
one item, rows sharing a ``doc_id`` stay separate rows; with an empty
benchmark nothing is hit. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.tasks import batch_rows, map_arrow
from lexisieve.session import scratch_path

WINDOW = 13
SEGMENT_WORDS = 1 << 20
MAX_TERMS = 1 << 21
SLICE_BYTES = 32 << 20

SEGMENT = "block long, doc_ids array<long>, bases binary, size long, terms binary, starts binary, deltas binary"
_SEGMENT_ARROW = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("bases", pa.binary()),
                            ("size", pa.int64()), ("terms", pa.binary()), ("starts", pa.binary()),
                            ("deltas", pa.binary())])


def _segment(block: int, ids: list[int], lens: list[int], h: np.ndarray, terms: np.ndarray | None) -> pa.RecordBatch:
    """Invert one run of documents. ``bases`` are the documents' first
    positions (one gap after each document) and the end."""
    n = np.array(lens, np.int64)
    bases = np.concatenate([[0], np.cumsum(n + 1)])
    at = np.arange(len(h), dtype=np.int64) + np.repeat(np.arange(len(n)), n)
    if terms is not None:
        slot = np.searchsorted(terms, h)
        slot[slot == len(terms)] = 0
        known = terms[slot] == h if len(terms) else np.zeros(len(h), bool)
        h, at = h[known], at[known]
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    delta = np.diff(at, prepend=0)
    delta[new] = at[new]
    return batch_rows(_SEGMENT_ARROW, [(
        block, ids, bases.tobytes(), int(bases[-1]), h[new].tobytes(),
        np.append(new, len(h)).astype(np.int64).tobytes(), delta.astype(np.uint32).tobytes())])


def _inverter(terms_cast, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = terms_cast.value if terms_cast is not None else None
        block = TaskContext.get().partitionId() << 32
        ids, lens, parts, held = [], [], [], 0
        for batch in batches:
            column = batch.column("doc_id").to_pylist()
            for i, h in enumerate(W.row_words(batch.column("text"), "alnum")):
                if ids and held + len(h) > limit:
                    yield _segment(block, ids, lens, np.concatenate(parts), terms)
                    block, ids, lens, parts, held = block + 1, [], [], [], 0
                ids.append(column[i])
                lens.append(len(h))
                parts.append(h)
                held += len(h) + 1
        if ids:
            yield _segment(block, ids, lens, np.concatenate(parts), terms)
    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()) \
        .select(F.col("item_id").cast("string").alias("item_id"), "text")


def _slices(benchmark: DataFrame, slice_bytes: int) -> list[DataFrame]:
    items = _items(benchmark)
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = 1 + 2 * total // slice_bytes
    if count == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k) for k in range(count)]


def _collect_items(part: DataFrame) -> list[tuple[str, np.ndarray]]:
    """The word hashes of one slice's items."""
    rows = part.collect()
    found = W.row_words(pa.array([r["text"] for r in rows], pa.string()), "alnum")
    return [(r["item_id"], h.copy()) for r, h in zip(rows, found) if len(h)]


def build_index(docs: DataFrame, terms: np.ndarray | None = None, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Write the segments of ``docs`` (doc_id, text) and return them as read
    back. ``terms``: sorted word hashes to index; None indexes every word."""
    spark = docs.sparkSession
    cast = spark.sparkContext.broadcast(terms) if terms is not None else None
    location = scratch_path(spark, "positions")
    map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _inverter(cast, segment_words), SEGMENT) \
        .write.option("compression", "zstd").parquet(location)
    return spark.read.schema(SEGMENT).parquet(location)


class _Lists:
    """The term lists of one stored segment."""

    def __init__(self, row: dict):
        self.block, self.size = row["block"], row["size"]
        self.ids = row["doc_ids"]
        self.bases = np.frombuffer(row["bases"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.deltas = np.frombuffer(row["deltas"], np.uint32)
        self._read: dict[int, np.ndarray] = {}

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Index of each term's list, -1 without one."""
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def lengths(self, slots: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(slots), np.int64)
        return np.where(slots < 0, 0, np.diff(self.starts)[slots])

    def positions(self, slot: int) -> np.ndarray:
        if slot not in self._read:
            part = self.deltas[self.starts[slot]:self.starts[slot + 1]]
            self._read[slot] = np.cumsum(part.astype(np.int64))
        return self._read[slot]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, at, "right") - 1


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The values of sorted a that are in sorted b."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return a[b[at] == a]


def phrase_starts(lists: _Lists, slots: np.ndarray) -> np.ndarray:
    """Positions where the phrase stands: offset-adjusted lists, rarest first."""
    order = np.argsort(lists.lengths(slots), kind="stable")
    found = lists.positions(int(slots[order[0]])) - order[0]
    for k in order[1:]:
        if not len(found):
            break
        found = _within(found, lists.positions(int(slots[k])) - k)
    return found


def windows(items: list[tuple[str, np.ndarray]], size: int) -> tuple[list[np.ndarray], list[list[int]], list[str]]:
    """(distinct windows, the items each belongs to, item ids)."""
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    found: dict[bytes, set[int]] = {}
    for name, h in items:
        for i in range(max(1, len(h) - size + 1)):
            found.setdefault(h[i:i + size].tobytes(), set()).add(number[name])
    return [np.frombuffer(k, np.uint64) for k in found], [sorted(v) for v in found.values()], names


_HIT = "block long, row int, doc_id long, n_words long, hits array<int>, items array<string>"
_HIT_ARROW = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])


def _phrase_task(cast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wins, owners, names = cast.value
        cuts = np.cumsum([0] + [len(w) for w in wins])
        flat = np.concatenate(wins) if wins else np.zeros(0, np.uint64)
        for batch in batches:
            for i in range(batch.num_rows):
                lists = _Lists(batch.slice(i, 1).to_pylist()[0])
                rows, n = len(lists.ids), np.diff(lists.bases) - 1
                hit, pairs = np.zeros(lists.size + 1, bool), []
                if wins:
                    slots = lists.slots(flat)
                    whole = np.minimum.reduceat(lists.lengths(slots), cuts[:-1]) > 0
                    for w in np.flatnonzero(whole):
                        at = phrase_starts(lists, slots[cuts[w]:cuts[w + 1]])
                        if len(at):
                            for k in range(len(wins[w])):
                                hit[at + k] = True
                            doc = np.unique(lists.doc_of(at))
                            pairs += [np.stack([doc, np.full(len(doc), o)]) for o in owners[w]]
                spots = np.flatnonzero(hit)
                doc = lists.doc_of(spots)
                cut = np.searchsorted(doc, np.arange(rows + 1))
                inside = (spots - lists.bases[doc]).astype(np.int32)
                mine: dict[int, list[str]] = {}
                if pairs:
                    for d, o in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
                        mine.setdefault(d, []).append(names[o])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, lists.block)), pa.array(np.arange(rows, dtype=np.int32)),
                    pa.array(lists.ids, pa.int64()), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(inside)),
                    pa.array([mine.get(d, []) for d in range(rows)], pa.list_(pa.string()))], schema=_HIT_ARROW)
    return run


def phrase_hits(index: DataFrame, items: list[tuple[str, np.ndarray]], size: int = WINDOW) -> DataFrame:
    """(block, row, doc_id, n_words, hits, items) of every document: the word
    positions inside any occurrence of a window, and the items that occur."""
    cast = index.sparkSession.sparkContext.broadcast(windows(items, size))
    return map_arrow(index, _phrase_task(cast), _HIT)


def _proximity_task(cast, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lists, out = _Lists(batch.slice(i, 1).to_pylist()[0]), []
                for name, h in cast.value:
                    slots = lists.slots(np.unique(h))
                    lens = lists.lengths(slots)
                    if not lens.all():
                        continue
                    # First words near the rarest term, then the end of the smallest stretch with all terms.
                    rare = lists.positions(int(slots[np.argmin(lens)]))
                    near = [p[np.searchsorted(rare, p - span + 1) < np.searchsorted(rare, p + span - 1, "right")]
                            for p in (lists.positions(int(s)) for s in slots)]
                    first = np.unique(np.concatenate(near))
                    last = first.copy()
                    for s in slots:
                        p = lists.positions(int(s))
                        at = np.searchsorted(p, first)
                        last = np.maximum(last, np.where(at < len(p), p[np.minimum(at, len(p) - 1)], 1 << 62))
                    ok = (last - first < span) & (lists.doc_of(first) == lists.doc_of(np.minimum(last, lists.size)))
                    doc = lists.doc_of(first[ok])
                    out += [(lists.ids[d], name, int(x)) for d, x in zip(doc, first[ok] - lists.bases[doc])]
                yield batch_rows(pa.schema([("doc_id", pa.int64()), ("item_id", pa.string()), ("at", pa.int64())]), out)
    return run


def proximity_hits(index: DataFrame, items: list[tuple[str, np.ndarray]], span: int) -> DataFrame:
    """(doc_id, item_id, at): first word of every stretch of at most ``span``
    words, starting at one of the item's words, that holds all its distinct words."""
    cast = index.sparkSession.sparkContext.broadcast(items)
    return map_arrow(index, _proximity_task(cast, span), "doc_id long, item_id string, at long")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slice_bytes: int = SLICE_BYTES,
                  percent: int = 5) -> DataFrame:
    """(doc_id, n_words, hits, items, contaminated) of every document row.
    Contaminated: at least ``percent`` of its words lie inside occurrences."""
    parts = _slices(benchmark, slice_bytes)
    items = _collect_items(parts[0])
    terms = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
    index = build_index(docs, terms if len(parts) == 1 and len(terms) <= MAX_TERMS else None)
    found = [phrase_hits(index, items, size)] + [phrase_hits(index, _collect_items(p), size) for p in parts[1:]]
    out = found[0]
    if len(found) > 1:
        for other in found[1:]:
            out = out.unionByName(other)
        out = out.groupBy("block", "row", "doc_id", "n_words").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    n_hit = F.size("hits").cast("long")
    return out.select("doc_id", "n_words", "hits", F.array_sort("items").alias("items"),
                      ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"))
