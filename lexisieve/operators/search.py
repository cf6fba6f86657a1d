"""Boolean search over postings: one word, all words (AND), any word (OR).

Query words are split on white space and lower-cased (A-Z only) but never
tokenised, so a query word holding any other character matches nothing (R5).
Results are paths of live documents, sorted by byte order (R9, R10).

Against stored postings (with a ``bucket`` column) the word filter also
names its bucket; the bucket expression folds to a literal, so Spark prunes
partitions and Parquet row groups before reading.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.text import lower_ascii_py
from lexisieve.operators.index import DEFAULT_BUCKETS, bucket_of, stored_buckets
from lexisieve.session import BROADCAST_MAX_ROWS, broadcast_if_small, deal, is_small, materialize

# Size bounds (rows) for the two broadcast candidates of a batch search.
REQUEST_WORDS_BROADCAST_ROWS = BROADCAST_MAX_ROWS
VOCABULARY_BROADCAST_ROWS = BROADCAST_MAX_ROWS
# A word in more documents is split over several tasks where a join shuffles.
HOT_DOCS = 1 << 18

SEARCH_ONE, SEARCH_ALL, SEARCH_ANY = "SEARCH_ONE", "SEARCH_ALL", "SEARCH_ANY"


def _normalise(words: Iterable[str]) -> list[str]:
    """Lower-case, drop empty words and repeats (R7)."""
    return sorted({lower_ascii_py(w) for w in words if w and lower_ascii_py(w)})


def _buckets(postings: DataFrame, buckets: int) -> int:
    """The stored bucket count wins over the argument (a fallback for
    postings written without it)."""
    return stored_buckets(postings) or buckets


def _word_filter(postings: DataFrame, words: list[str], buckets: int) -> DataFrame:
    cond = F.col("word").isin(words)
    if "bucket" in postings.columns:
        b = _buckets(postings, buckets)
        cond = F.col("bucket").isin([bucket_of(F.lit(w), b) for w in words]) & cond
    return postings.where(cond)


def _empty(postings: DataFrame) -> DataFrame:
    return postings.select("path").where(F.lit(False))


def search_one(postings: DataFrame, word: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Paths holding ``word``, sorted."""
    words = _normalise([word])
    if not words:
        return _empty(postings)
    return _word_filter(postings, words, buckets).select("path").orderBy("path")


def search_all(postings: DataFrame, words: Iterable[str], buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Paths holding every word (relational division by counting).

    Postings are sets, so a path matching all n distinct words has exactly n
    matching rows; an unknown word makes n unreachable, as it should (R7).
    Only matching rows reach the (path) aggregation, each path at most n.
    """
    ws = _normalise(words)
    if not ws:
        return _empty(postings)
    hits = _word_filter(postings, ws, buckets).groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    return hits.where(F.col("_n") == len(ws)).select("path").orderBy("path")


def search_any(postings: DataFrame, words: Iterable[str], buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Paths holding at least one word; unknown words are skipped (R8)."""
    ws = _normalise(words)
    if not ws:
        return _empty(postings)
    return _word_filter(postings, ws, buckets).select("path").distinct().orderBy("path")


def postings_intersect(postings: DataFrame, word_a: str, word_b: str,
                       buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Pairwise step of AND: paths in both lists (a semi join)."""
    a = search_one(postings, word_a, buckets)
    b = search_one(postings, word_b, buckets)
    return a.join(b, "path", "left_semi").orderBy("path")


def postings_union(postings: DataFrame, word_a: str, word_b: str,
                   buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Step of OR: paths in either list."""
    a = search_one(postings, word_a, buckets)
    b = search_one(postings, word_b, buckets)
    return a.union(b).distinct().orderBy("path")


def resolve_sorted(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Doc ids to paths through the live document table; ids without a live
    path (removed documents) drop out (R9). Sorted by path."""
    return hits.join(documents.select("doc_id", "path"), "doc_id", "inner").orderBy("path")


def salted(postings: DataFrame, probe: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a shuffle join on words with a ``_salt`` column: the
    postings of a word in more than HOT_DOCS documents are split by path into
    parts of about HOT_DOCS, its probe rows are repeated for each part. The
    split words are few (HOT_DOCS postings each, at least)."""
    hot = materialize(known.where(F.col("n_docs") > HOT_DOCS).select(
        "word", F.ceil(F.col("n_docs") / HOT_DOCS).cast("int").alias("_parts")), "hot-words")
    hot = broadcast_if_small(hot)
    one = F.coalesce("_parts", F.lit(1))
    left = postings.join(hot, "word", "left").withColumn("_salt", F.pmod(F.xxhash64("path"), one).cast("int")).drop("_parts")
    right = probe.join(hot, "word", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("_parts")
    return left, right


def _matches(postings: DataFrame, probe: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """The postings of the probe's words, with its columns. A small probe is
    broadcast; a large one is met in a shuffle, with hot words split."""
    if is_small(probe, REQUEST_WORDS_BROADCAST_ROWS):
        return postings.join(F.broadcast(probe), keys)
    asked = broadcast_if_small(known.select(*keys), VOCABULARY_BROADCAST_ROWS)
    left, right = salted(postings.join(asked, keys, "left_semi"), probe, known)
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def batch_search(postings: DataFrame, queries: DataFrame, buckets: int = DEFAULT_BUCKETS,
                 terms: DataFrame | None = None) -> DataFrame:
    """Answer a whole table of parsed requests.

    queries: (req_id, cmd, words ARRAY<STRING>, error) from ``parse_requests``;
    terms: (word, n_docs), with ``bucket`` where the postings have it, counted
    from the postings where it is not given. Returns (req_id, path) hits
    (unsorted; render or sort downstream).

    The term statistics tell the known words and each AND request's rarest one
    without a look at the postings; a request with an unknown word ends there.
    One join over the postings then gives the documents of every ANY word and
    of the rarest words, and the latter are verified in a second one: the other
    words of candidates only. So no row is made for a common word's other
    documents, and the postings are read twice.
    """
    keys = ["bucket", "word"] if "bucket" in postings.columns else ["word"]

    def with_keys(words: DataFrame) -> DataFrame:
        return words.withColumn("bucket", bucket_of("word", _buckets(postings, buckets))) if len(keys) == 2 else words
    valid = materialize(queries.where(F.col("error").isNull() & (F.size("words") > 0)).select(
        "req_id", (F.col("cmd") == SEARCH_ANY).alias("any"), F.array_distinct("words").alias("words")), "requests")
    asked = broadcast_if_small(with_keys(valid.select(F.explode("words").alias("word")).distinct()), VOCABULARY_BROADCAST_ROWS)
    if terms is None:
        terms = postings.join(asked, keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"))
    known = materialize(terms.join(asked, keys, "left_semi").select(*keys, "n_docs"), "known-words")

    counted = broadcast_if_small(known)
    either = valid.where("any").select("req_id", "any", F.explode("words").alias("word")).join(counted.select("word"), "word")
    every = valid.where(~F.col("any")).select("req_id", F.size("words").alias("_n"), F.explode("words").alias("word"))
    lead = every.join(counted, "word").groupBy("req_id", "_n").agg(
        F.min_by("word", F.struct("n_docs", "word")).alias("word"), F.count(F.lit(1)).alias("_known")) \
        .where(F.col("_known") == F.col("_n"))
    probe = either.select("req_id", "word", F.lit(0).alias("_n")).unionByName(lead.select("req_id", "word", "_n"))
    probe = materialize(with_keys(probe), "probe")
    # A request's word meets each of its documents: so many rows, before they are made distinct.
    met = probe.join(counted.select("word", "n_docs"), "word").agg(F.sum("n_docs")).first()[0] or 0
    found = _matches(postings.select(*keys, "path"), probe, known, keys) \
        .select("req_id", "path", "_n", F.when(F.col("_n") > 0, F.col("word")).alias("lead"))
    candidates = materialize(deal(found, met, "req_id", "path").distinct(), "candidates")
    done = candidates.where(F.col("_n") < 2).select("req_id", "path")

    open_ = candidates.where(F.col("_n") > 1)
    others = valid.where(~F.col("any") & (F.size("words") > 1)).select("req_id", "words")
    asked = open_.join(broadcast_if_small(others), "req_id").select(
        "req_id", "path", "_n", F.explode(F.array_remove("words", F.col("lead"))).alias("word"))
    asked = materialize(with_keys(asked), "to-verify")
    if is_small(asked):
        held = postings.select(*keys, "path").join(F.broadcast(asked), [*keys, "path"])
    else:
        words = broadcast_if_small(known.select(*keys), VOCABULARY_BROADCAST_ROWS)
        held = postings.select(*keys, "path").join(words, keys, "left_semi").join(asked, [*keys, "path"])
    held = held.groupBy("req_id", "path", "_n").agg(F.count_distinct("word").alias("_held")) \
        .where(F.col("_held") == F.col("_n") - 1).select("req_id", "path")
    return done.unionByName(held)
