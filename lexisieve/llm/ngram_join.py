"""Near-duplicate documents by an exact n-gram Jaccard join.

A document's set holds its distinct 5-word shingles (64-bit hashes); two
documents link when intersection / union >= 0.75.

1. Documents with equal sets form a class; its smallest id stands for it.
2. Quick links: representatives that share one of their eight smallest hashes
   are compared with two documents holding that hash, its hubs. True links found here
   join most copies into provisional components, in work linear in the input.
3. Complete candidates, between different provisional components only. Order
   the tokens by (frequent, hash). If two sets link, they share at least
   k = 2 tokens within the first n - ceil(3n/4) + k of each (the extended
   prefix). A rare token of an extended prefix is indexed alone; frequent
   tokens are indexed as combinations of k. Whatever the k shared tokens are,
   a rare one is a common key, or else their combination is. Frequent tokens
   (in the prefixes of ``FREQUENT`` components or more) thus never open a
   list of their own, and the order moves them out of most prefixes. A pair
   is made only where the tokens before its key leave enough to link, and where
   the parity bits that travel with the keys do not show too large a difference.
4. Verify: a longer parity bitmap bounds the symmetric difference from below and
   drops hopeless pairs without losing one; the rest are compared as sets.

Which tokens count as frequent changes the work, not the result, so the
broadcast list of them may be bounded (``MAX_FREQUENT``, the most frequent
first). A bitmap of fixed size tells which tokens occur in more than one
component; its false positives cost work only. Only these two go to all
tasks, and document labels if they are measured small; pairs, links and sets
stay distributed.

Defined results: no words: empty set, linked with nothing; fewer than five
words: the whole sequence is the one shingle; rows sharing a ``doc_id`` are
one node with several texts; a null ``doc_id`` has a null component; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm import words as W
from lexisieve.llm.components import components
from lexisieve.llm.tasks import batch_rows, map_arrow
from lexisieve.session import broadcast_if_small, materialize

SHINGLE = 5
HEADS = 8
K = 2
FREQUENT = 50
MAX_FREQUENT = 200_000
BITMAP_BITS = 1 << 27
#: Parity bits that travel with an index key, as longs.
KEY_BITS = 512
_PARITY = [f"p{i}" for i in range(KEY_BITS // 64)]
_SLOT = np.uint64(BITMAP_BITS - 1)

_DOCUMENT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("sig2", pa.int64()),
                       ("heads", pa.list_(pa.int64())), ("parity", pa.binary())])


def sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    for h in W.row_words(column, "space"):
        yield np.unique(W.shingles(h, SHINGLE))


def parity(s: np.ndarray) -> bytes:
    """Bit i: whether an odd number of hashes fall on i. The size is the next
    power of two of twice the set, so bitmaps fold onto each other."""
    size = max(64, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64
    counts = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def key_parity(s: np.ndarray) -> np.ndarray:
    """The parity bitmap of KEY_BITS bits, whatever the size of the set."""
    counts = np.bincount((s & np.uint64(KEY_BITS - 1)).astype(np.int64), minlength=KEY_BITS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def difference_bound(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    small = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, small), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both) > 0


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, s in zip(batch.column("doc_id").to_pylist(), sets(batch.column("text"))):
            i = s.view(np.int64)
            out.append((doc_id, len(s), int(i.sum()), int(np.bitwise_xor.reduce(W.mix(s)).view(np.int64)) if len(s) else 0,
                        i[:HEADS].tolist(), parity(s)))
        yield batch_rows(_DOCUMENT, out)


def _pass_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.array(batch.column("na")) + np.array(batch.column("nb"))
        low = [difference_bound(a, b) for a, b in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())]
        keep = pa.array(7 * np.array(low, np.int64) <= n)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = pa.array([linked(x, y) for x, y in zip(sets(batch.column("ta")), sets(batch.column("tb")))], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["u", "v"])


def verify(docs: DataFrame, described: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v): the pairs (a, b) that link. Sizes and bitmaps are joined first;
    texts travel only for pairs that the bound lets through."""
    side = described.select("doc_id", "n", "parity")
    a, b = (side.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}")) for k in "ab")
    wide = pairs.join(a, "a").join(b, "b").where(4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb"))
    near = materialize(map_arrow(wide.select("a", "b", "na", "nb", "pa", "pb"), _pass_bound, "a long, b long").distinct(),
                       "near-pairs")
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    texts = materialize(docs.join(broadcast_if_small(ids), "doc_id", "left_semi"), "near-texts")
    ta, tb = (texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"t{k}")) for k in "ab")
    full = near.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    return materialize(map_arrow(full, _compare, "u long, v long").distinct(), "links")


def prefix_length(n: int, k: int = K) -> int:
    return min(n, n - (3 * n + 3) // 4 + k)


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def ordered_prefix(s: np.ndarray, frequent: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(rare, frequent) tokens of the extended prefix under (frequent, hash)."""
    length = prefix_length(len(s), k)
    often = _member(frequent, s)
    rare = s[~often][:length]
    return rare, s[often][:length - len(rare)]


def _token_rows(batch: pa.RecordBatch, tokens: list[np.ndarray], extra: list[str]) -> pa.RecordBatch:
    lens = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
    rows = pa.array(np.repeat(np.arange(len(tokens)), lens))
    return pa.RecordBatch.from_arrays([pa.array(flat)] + [batch.column(c).take(rows) for c in extra], ["key", *extra])


def _placed(rows: pa.RecordBatch, skipped: list[np.ndarray]) -> pa.RecordBatch:
    """Adds how many of the set's tokens are not shared if this key is the first shared one."""
    flat = np.concatenate(skipped).astype(np.int64) if skipped else np.zeros(0, np.int64)
    return rows.append_column("skipped", pa.array(flat))


def _with_parities(rows: pa.RecordBatch, parities: list[np.ndarray]) -> pa.RecordBatch:
    for name, bits in zip(_PARITY, np.stack(parities, axis=1)):
        rows = rows.append_column(name, pa.array(bits))
    return rows


def _halves(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def _plain_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _halves(batch):
            yield _token_rows(part, [s[:prefix_length(len(s))] for s in sets(part.column("text"))], ["component", "leads"])


def _moved_tokens(frequent_cast):
    """Tokens that enter a prefix because frequent ones left it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s in sets(batch.column("text")):
                old = s[:prefix_length(len(s))]
                if _member(frequent_cast.value, old).any():
                    rare, _ = ordered_prefix(s, frequent_cast.value)
                    out.append(rare[~_member(old, rare)])
            flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(flat & _SLOT).astype(np.int64))], ["slot"])
    return run


def _combinations(tokens: np.ndarray, rows: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all pairs of the tokens (they are sorted) and the index of the
    later token, in bounded arrays."""
    n = len(tokens)
    salted = W.mix(tokens)
    at = 0
    while at < n - 1:
        to = at + 1
        while to < n - 1 and (to - at) * n < rows:
            to += 1
        i, j = np.nonzero(np.arange(at, to)[:, None] < np.arange(n)[None, :])
        yield W.mix(salted[i + at] * np.uint64(3) + tokens[j]), j
        at = to


def _index_keys(frequent_cast, bitmap_cast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = frequent_cast.value
        bitmap = np.frombuffer(bitmap_cast.value, np.uint8)
        extra = ["doc_id", "component", "n", *_PARITY]
        for batch in batches:
            for part in _halves(batch):
                singles, places, parities = [], [], []
                for i, s in enumerate(sets(part.column("text"))):
                    parities.append(key_parity(s))
                    rare, often = ordered_prefix(s, frequent)
                    slot = rare & _SLOT
                    hit = np.flatnonzero((bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                    singles.append(rare[hit])
                    places.append(hit)  # tokens before it
                    if len(often) > 1:
                        one = _with_parities(part.slice(i, 1), parities[-1:])
                        for keys, second in _combinations(often):
                            # Of two shared tokens the later one's place counts, less the earlier one.
                            yield _placed(_token_rows(one, [keys], extra), [second + len(rare) - 1])
                yield _placed(_token_rows(_with_parities(part, parities), singles, extra), places)
    return run


def _bitmap(slots: DataFrame) -> bytearray:
    """The slots as one bitmap: at most BITMAP_BITS / 32,768 rows of 4 KB."""
    # The bitmap functions count from 1: value v is bit v - 1.
    value = F.col("slot") + 1
    rows = slots.groupBy(F.bitmap_bucket_number(value).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
    out = bytearray(BITMAP_BITS // 8)
    for r in rows.toLocalIterator():
        at = (r["bucket"] - 1) * 4096
        out[at:at + 4096] = r["bits"]
    return out


def _text_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Representatives' texts with their labels."""
    return docs.join(broadcast_if_small(labels), "doc_id")


def candidates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) of different components that share an index key. ``labels``:
    (doc_id, n, component, leads) of the representatives."""
    spark = docs.sparkSession
    texts = _text_of(docs, labels)
    counts = map_arrow(texts.select("component", F.col("leads").cast("int").alias("leads"), "text"), _plain_prefixes,
                       "key long, component long, leads int") \
        .groupBy("key").agg(F.sum("leads").alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    shared = materialize(counts.where(F.col("lo") != F.col("hi")).select("key", "df"), "shared-tokens")
    top = shared.where(F.col("df") >= FREQUENT).orderBy(F.desc("df"), "key").limit(MAX_FREQUENT).select("key").collect()
    frequent = np.unique(np.array([r["key"] for r in top], np.int64).view(np.uint64))
    frequent_cast = spark.sparkContext.broadcast(frequent)
    slots = shared.select((F.col("key").bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("slot"))
    if len(frequent):
        slots = slots.unionByName(map_arrow(texts.select("text"), _moved_tokens(frequent_cast), "slot long"))
    bitmap_cast = spark.sparkContext.broadcast(bytes(_bitmap(slots)))
    carried = ["doc_id", "component", "n", *_PARITY, "skipped"]
    keys = materialize(map_arrow(texts.select("doc_id", "component", "n", "text"), _index_keys(frequent_cast, bitmap_cast),
                                 "key long, " + ", ".join(f"{c} long" for c in carried)), "index-keys")
    x, y = (keys.select("key", *[F.col(c).alias(f"{c}_{s}") for c in carried]) for s in "xy")
    # If the pair links, its intersection is at least 3/7 of both sizes' sum. At its first common key (the first
    # shared token, or the first two) the tokens skipped so far are not shared; so that key passes this bound.
    most = F.least(F.col("n_x") - F.col("skipped_x"), F.col("n_y") - F.col("skipped_y"))
    # The sets differ in at least as many tokens as their parities in bits; in a pair that links, in a seventh of both
    # sizes' sum at most.
    apart = sum((F.bit_count(F.col(f"{p}_x").bitwiseXOR(F.col(f"{p}_y"))) for p in _PARITY), F.lit(0))
    pairs = x.join(y, "key").where(
        (F.col("component_x") < F.col("component_y")) & (4 * F.least("n_x", "n_y") >= 3 * F.greatest("n_x", "n_y"))
        & (7 * most >= 3 * (F.col("n_x") + F.col("n_y"))) & (7 * apart <= F.col("n_x") + F.col("n_y")))
    return pairs.select(F.col("doc_id_x").alias("a"), F.col("doc_id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = materialize(map_arrow(
        docs, _describe, "doc_id long, n long, sig long, sig2 long, heads array<long>, parity binary"), "shingle-sets")
    named = described.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Only sets held more than once are joined back.
    classes = named.groupBy("sig", "sig2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("_n")) \
        .where("_n > 1").drop("_n")
    member = materialize(named.select("doc_id", "sig", "sig2", "n")
                         .join(broadcast_if_small(classes), ["sig", "sig2", "n"], "left")
                         .select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "n"), "classes")
    reps = member.where(F.col("doc_id") == F.col("rep")).select("doc_id", "n").distinct()
    rep_rows = named.join(reps, ["doc_id", "n"], "left_semi")

    heads = rep_rows.select("doc_id", "n", F.explode("heads").alias("key"))
    # Two hubs for every hash: the smallest id, which gathers a group, and one
    # that differs between hashes, for members that the first is too far from.
    hubs = heads.groupBy("key").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("_n"),
                                    F.min_by("doc_id", F.xxhash64("doc_id", "key")).alias("any")).where("_n > 1")
    hubs = hubs.select("key", F.explode(F.array_distinct(F.array("low", "any"))).alias("hub"))
    quick = heads.join(hubs, "key").where(F.col("doc_id") != F.col("hub")) \
        .select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct()
    links = verify(docs, rep_rows, quick)
    copies = member.where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    first = materialize(components(links), "first-components")
    labels = reps.join(first, reps["doc_id"] == first["node"], "left").select(
        "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    labels = materialize(labels.withColumn("leads", F.col("component") == F.col("doc_id")), "first-labels")

    more = verify(docs, rep_rows, candidates(docs, labels))
    edges = links.unionByName(more).unionByName(copies)
    final = components(edges)
    return described.select("doc_id", "n").join(final, F.col("doc_id") == F.col("node"), "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
