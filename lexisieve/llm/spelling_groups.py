"""Groups of spelling variants by searches on FM-indexes of the vocabulary.

Two words are near when one inserted, deleted or replaced code point turns one
into the other. Then either the first half of a word starts its near word, or
its second half ends it. So there are two search schemes: match one half
exactly, from the delimiter inwards, then extend across the other half
allowing one error, up to the other delimiter. The index is bidirectional: the
suffix ranks of the delimited vocabulary serve the scheme that grows to the
left, those of the reversed vocabulary the one that grows to the right, and
all words of a shard are searched together, an array of rank intervals each
step.

Halves have ``anchor`` code points or more, so near words that share a half
also share its outermost ``anchor`` code points: the vocabulary is sharded by
these, once for each direction, and a word meets each near word in its shard.
A shard above ``block`` words is cut into blocks of target words, and each
slice of its query words is searched in every block: the index of a task stays
bounded, no pair of words is made but the near ones, and none is lost.

Defined results: a null text has no words; a null doc_id counts as an empty
string before the colon; repeated rows count as often as they occur; ties go to
the word that is smaller by code points; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexisieve.llm.tasks import ship_package
from lexisieve.session import broadcast_if_small, materialize

MIN_CHARS, MIN_COUNT, SHARE, DELETE_EVERY = 6, 5, 5, 199
BLOCK = 1 << 16
QUERIES_AT_ONCE = 1 << 13
_RUNS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the runs of letters with A-Z lowered; one code point is
    deleted from the runs whose checksum with the doc_id 199 divides."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(_RUNS), F.lit(0))).alias("run")) \
        .where(F.length("run") >= min_chars).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    at = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", at.alias("at"), (at % F.length("run")).cast("int").alias("k"))
    cut = F.concat(F.substring(F.col("run"), F.lit(1), F.col("k")), F.substring(F.col("run"), F.col("k") + 2, F.length("run")))
    return runs.select(F.when(F.col("at") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word")) \
        .where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class WordIndex:
    """FM-index of distinct words given as Latin-1 bytes, delimited by zeros."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\0" + b"".join(w + b"\0" for w in words), np.uint8)
        n = len(text)
        stops = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(stops)
        rank[stops] = np.arange(len(stops))  # every delimiter is a letter of its own
        step = 1
        while True:
            shifted = np.zeros(n, np.int64)
            shifted[:n - step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + shifted
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank[order] = new
            if new[-1] == n - 1 or step >= n:
                break
            step *= 2
        self.suffix, self.before = order, text[order - 1]
        self.n, self.words = n, len(words)
        ranks = np.argsort(self.before, kind="stable")
        self.keys = self.before[ranks].astype(np.int64) * n + ranks
        self.letters = np.unique(self.before[self.before > 0]).astype(np.int64)
        self.word_at = np.full(n, -1, np.int64)
        self.word_at[stops[:-1] + 1] = np.arange(len(words))

    def extend(self, letter, lo, hi) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of a letter followed by what the intervals stand for."""
        return np.searchsorted(self.keys, letter * self.n + lo), np.searchsorted(self.keys, letter * self.n + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter) of all letters that precede an interval."""
        size = hi - lo
        small = np.flatnonzero(size <= len(self.letters))
        each = np.repeat(small, size[small])
        at = np.arange(len(each)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + lo[each]
        found = np.unique(each * 256 + self.before[at])
        large = np.flatnonzero(size > len(self.letters))
        found = np.concatenate([found[found % 256 > 0], (large[:, None] * 256 + self.letters[None, :]).ravel()])
        return found // 256, found % 256

    def near(self, words: list[bytes], exact: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for all words that end with the last ``exact`` letters
        of a query and differ by one error before them. ``own``: whether the
        query is one of the indexed words."""
        found = [np.zeros((2, 0), np.int64)]
        for a in range(0, len(words), QUERIES_AT_ONCE):
            part = words[a:a + QUERIES_AT_ONCE]
            letters = np.frombuffer(b"".join(part) + b"\0", np.uint8).astype(np.int64)
            ends = np.cumsum([len(w) for w in part])
            begin = ends - [len(w) for w in part]
            q, at, stop = np.arange(len(part)), ends.copy(), ends - exact[a:a + len(part)]
            lo, hi = np.zeros(len(part), np.int64), np.full(len(part), self.words + 1, np.int64)  # all delimiters
            mine = own[a:a + len(part)].astype(np.int64)

            def kept(pick):
                return q[pick], at[pick], lo[pick], hi[pick]

            waiting = []
            while len(q):  # the exact half
                ready = at == stop[q]
                waiting.append(kept(ready))
                q, at, lo, hi = kept(~ready)
                at = at - 1
                lo, hi = self.extend(letters[at], lo, hi)
                q, at, lo, hi = kept(hi - lo > mine[q])
            q, at, lo, hi = (np.concatenate(x) for x in zip(*waiting))
            while len(q):  # the other half: an error here, then letters that match
                left = at > begin[q]
                each, letter = self.branches(lo, hi)
                xlo, xhi = self.extend(letter, lo[each], hi[each])
                change = left[each] & (letter != letters[at[each] - 1])
                states = [(q[left], at[left] - 1, lo[left], hi[left]), (q[each], at[each], xlo, xhi),
                          (q[each][change], at[each][change] - 1, xlo[change], xhi[change])]
                found.append(self._finish(*(np.concatenate(x) for x in zip(*states)), letters, begin) + [[a], [0]])
                q, at, lo, hi = kept(left)
                at = at - 1
                lo, hi = self.extend(letters[at], lo, hi)
                q, at, lo, hi = kept(hi - lo > mine[q])
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]

    def _finish(self, q, at, lo, hi, letters, begin) -> np.ndarray:
        found = [np.zeros((2, 0), np.int64)]
        while len(q):
            done = at == begin[q]
            a, b = self.extend(0, lo[done], hi[done])
            size = b - a
            each = np.repeat(np.arange(len(a)), size)
            place = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size) + a[each]
            word = self.word_at[self.suffix[self.keys[place]]]  # keys of letter 0 are places of the rank order
            found.append(np.stack([q[done][each], word])[:, word >= 0])
            q, at, lo, hi = q[~done], at[~done] - 1, lo[~done], hi[~done]
            lo, hi = self.extend(letters[at], lo, hi)
            more = hi > lo
            q, at, lo, hi = q[more], at[more], lo[more], hi[more]
        return np.concatenate(found, axis=1)


_PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _search(rows: pa.Table) -> pa.Table:
    """The near words of a shard's queries among its targets."""
    left = rows.column("side")[0].as_py() == 1  # the second half is exact, the search grows to the left
    words = [w.encode("latin-1") if left else w.encode("latin-1")[::-1] for w in rows.column("word").to_pylist()]
    target, query = (rows.column(c).to_numpy() for c in ("target", "query"))
    count = rows.column("n").to_numpy()
    targets, queries = np.flatnonzero(target), np.flatnonzero(query)
    if not len(targets) or not len(queries):
        return _PAIRS.empty_table()
    asked = [words[i] for i in queries]
    exact = np.array([len(w) - len(w) // 2 if left else len(w) // 2 for w in asked])
    q, t = WordIndex([words[i] for i in targets]).near(asked, exact, target[queries])
    pairs = [(asked[i], words[targets[j]], int(count[targets[j]])) for i, j in zip(q.tolist(), t.tolist())]
    if left:  # what starts with the first half too is found by the other scheme
        pairs = [(a, b, n) for a, b, n in pairs if not b.startswith(a[:len(a) // 2])]
    turn = 1 if left else -1
    return pa.table([pa.array([a[::turn].decode("latin-1") for a, _, _ in pairs], pa.string()),
                     pa.array([b[::turn].decode("latin-1") for _, b, _ in pairs], pa.string()),
                     pa.array([n for _, _, n in pairs], pa.int64())], schema=_PAIRS)


def near_pairs(vocab: DataFrame, anchor: int = MIN_CHARS // 2, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for the near words of every word of ``vocab``
    (word, n), both ways round. Words are distinct, of U+0001 to U+00FF, and
    have ``2 * anchor`` code points or more."""
    spark = vocab.sparkSession
    ship_package(spark)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * vocab.count() // block))
    sided = vocab.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    outer = F.when(F.col("side") == 0, F.substring("word", 1, anchor)).otherwise(F.substring("word", -anchor, anchor))
    sided = sided.withColumn("shard", F.pmod(F.xxhash64(outer), F.lit(shards)))
    blocks = materialize(sided.groupBy("side", "shard").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "shards")
    sided = sided.join(broadcast_if_small(blocks), ["side", "shard"])
    all_of = F.sequence(F.lit(0), F.col("blocks") - 1)

    def one(seed: int):
        return F.array(F.pmod(F.xxhash64("word", F.lit(seed)), F.col("blocks")).cast("int"))

    def role(target: bool, query: bool, where, block_ids, slices):
        rows = sided.where(where).select("side", "shard", "word", "n", F.explode(block_ids).alias("block"), slices.alias("s"))
        return rows.select("side", "shard", "block", F.explode("s").alias("slice"), "word", "n",
                           F.lit(target).alias("target"), F.lit(query).alias("query"))

    rows = role(True, True, F.col("blocks") == 1, all_of, all_of) \
        .unionByName(role(True, False, F.col("blocks") > 1, one(1), all_of)) \
        .unionByName(role(False, True, F.col("blocks") > 1, all_of, one(2)))
    return rows.groupBy("side", "shard", "block", "slice").applyInArrow(_search, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by joining
    the pointers with themselves until none moves. Counts grow along a chain,
    so there are no cycles, and few rounds."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        moved = Observation()
        step = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        step = step.observe(moved, F.count("next").alias("n")).select("word", F.coalesce("next", "root").alias("root"))
        now = materialize(step, "roots")
        if not moved.get["n"]:
            return now


def spelling_groups(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, share: int = SHARE,
                    block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with ``min_chars``
    code points and ``min_count`` occurrences."""
    vocab = materialize(vocabulary(docs, min_chars, min_count), "vocabulary")
    near = near_pairs(vocab, min_chars // 2, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    words = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.n") >= share * F.col("n"), F.col("best")).alias("best"))
    words = materialize(words.select("word", F.col("best.word").alias("form"), "n", "n_near",
                                     (-F.col("best.n")).alias("form_n")), "spelling")
    last = roots(words.where("form is not null"))
    return words.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
