"""Postings: the forward and the inverted index as one (path, word) table.

A document's word set and a word's document set are the same relation laid
out two ways, so the table is stored once, as rows (never as one array per
word: a common word's list grows with the corpus). On disk it is partitioned
by ``bucket = pmod(xxhash64(word), B)`` and sorted by word inside each file,
so a search touches one bucket directory and, through Parquet min/max
statistics on ``word``, only the row groups that can hold the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.text import distinct_tokens, tokens
from lexisieve.session import deal

DEFAULT_BUCKETS = 64
# Bytes of text to a distinct word of a row: few, so that rows are not underrated.
WORD_BYTES = 8
# Field-metadata key under which stored postings record their bucket count
# (kept in the Parquet footer), so a reader never needs to be told B.
BUCKETS_KEY = "lexisieve.buckets"


def suggest_buckets(postings_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Bucket count for an expected postings size: a power of two giving
    buckets of about ``target_bytes``, so a one-word search opens about one
    file of its bucket and reads only the row groups holding the word."""
    need = max(1, -(-postings_bytes // target_bytes))
    return max(16, 1 << (need - 1).bit_length())


def stored_buckets(postings: DataFrame) -> int | None:
    """Bucket count recorded by ``write_postings``; None when not stored."""
    if "word" not in postings.columns:
        return None
    value = postings.schema["word"].metadata.get(BUCKETS_KEY)
    return int(value) if value is not None else None


def bucket_of(word: Column | str, buckets: int = DEFAULT_BUCKETS) -> Column:
    w = F.col(word) if isinstance(word, str) else word
    return F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")


def tokenize(corpus: DataFrame) -> DataFrame:
    """Every word occurrence: (path, pos, word); pos counts from 0."""
    return corpus.select("path", F.posexplode(tokens("text")).alias("pos", "word")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def doc_words(corpus: DataFrame, unique_paths: bool = False) -> DataFrame:
    """Distinct (path, word) postings of a corpus (sets: R4).

    Repeats inside a document are removed in the row itself. When a path can
    occur in several rows (the same file added twice), the union of their
    word sets is the reference's outcome, so a ``distinct`` follows; it is
    skipped when the caller knows paths are unique.
    """
    rows = corpus.where(F.col("text").isNotNull()) \
        .select("path", F.explode(distinct_tokens("text")).alias("word"))
    if unique_paths:
        return rows
    size = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return deal(rows, size // WORD_BYTES, "path", "word").distinct()


def forward_index(postings: DataFrame) -> DataFrame:
    """Grouped view path -> sorted word set. One document's set is bounded by
    that document's own text, which is already a single row."""
    return postings.groupBy("path").agg(F.array_sort(F.collect_set("word")).alias("words"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """word -> number of documents (the length of its inverted list).
    Partial aggregation before the shuffle keeps a hot word cheap."""
    return postings.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def inverted_index(postings: DataFrame, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Word-clustered layout: rows hash-distributed by bucket and sorted by
    (bucket, word, path) inside each task, ready to be written.

    The REBALANCE hint lets AQE size the write tasks from the real shuffle
    sizes: small buckets are coalesced into one task, and a bucket holding a
    hot word (say a third of all postings) is split over several tasks, each
    writing its own sorted file into the same bucket folder.
    """
    with_bucket = postings.withColumn("bucket", bucket_of("word", buckets))
    return with_bucket.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "path")


def write_postings(postings: DataFrame, location: str, buckets: int = DEFAULT_BUCKETS,
                   mode: str = "errorifexists") -> None:
    """Store postings partitioned by bucket. Write each snapshot to a new
    location: Spark cannot safely overwrite a table it is reading."""
    tagged = postings.select("path", F.col("word").alias("word", metadata={BUCKETS_KEY: buckets}))
    (inverted_index(tagged, buckets)
     .write.mode(mode).partitionBy("bucket").parquet(location))


def read_postings(spark, location: str) -> DataFrame:
    return spark.read.parquet(location)


def write_terms(postings: DataFrame, location: str) -> None:
    """Store the term statistics (word, bucket, n_docs) of stored postings,
    sorted by (bucket, word), so that a reader knows unknown and rare words
    without the postings."""
    counts = postings.groupBy("bucket", "word").agg(F.count(F.lit(1)).alias("n_docs"))
    counts.select("word", "bucket", "n_docs").sortWithinPartitions("bucket", "word").write.parquet(location)


def write_index(postings: DataFrame, location: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Stored postings and their term statistics in one folder."""
    write_postings(postings, f"{location}/postings", buckets)
    write_terms(read_postings(postings.sparkSession, f"{location}/postings"), f"{location}/terms")


def read_index(spark, location: str) -> tuple[DataFrame, DataFrame]:
    """(postings, terms) written by ``write_index``."""
    return read_postings(spark, f"{location}/postings"), spark.read.parquet(f"{location}/terms")


def postings_merge(postings: DataFrame, more: DataFrame) -> DataFrame:
    """Union of two posting sets. ``postings`` is a set already (R4): where the
    new rows are small by measure they go to the base, which is filtered for
    them in place, and only the new rows not found there are added; the base is
    not moved. Larger ones meet it in a shuffle."""
    from lexisieve.session import broadcast_if_small, is_small, materialize

    cols = ["path", "word"]
    base, new = postings.select(*cols), materialize(more.select(*cols).distinct(), "new-postings")
    if not is_small(new):
        return base.unionByName(new).distinct()
    there = materialize(base.join(F.broadcast(new), cols, "left_semi"), "known-postings")
    return base.unionByName(new.join(broadcast_if_small(there), cols, "left_anti"))


def forward_add(postings: DataFrame, more: DataFrame) -> DataFrame:
    """Add (doc, word) pairs; the same set union seen from the document side."""
    return postings_merge(postings, more)


def forward_replace(postings: DataFrame, new_postings: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Set the word sets of some documents: their old pairs are dropped and
    the new ones added. ``paths`` names the documents being set (default: the
    paths in ``new_postings``; pass it to set a document to an empty set)."""
    target = (paths if paths is not None else new_postings).select("path").distinct()
    kept = postings.select("path", "word").join(target, "path", "left_anti")
    return kept.unionByName(new_postings.select("path", "word"))


def forward_lookup(postings: DataFrame, paths: DataFrame) -> DataFrame:
    """Words of the given documents (paths: a one-column ``path`` table)."""
    return postings.join(paths.select("path").distinct(), "path", "left_semi")


def forward_remove(postings: DataFrame, paths: DataFrame) -> DataFrame:
    """Drop every pair of the given documents."""
    return postings.join(paths.select("path").distinct(), "path", "left_anti")


def postings_lookup(postings: DataFrame, words: DataFrame) -> DataFrame:
    """(word, path) pairs of the given words. The word table is broadcast only
    after its size is checked; the postings are never shuffled then."""
    from lexisieve.session import broadcast_if_small

    probe = broadcast_if_small(words.select("word").distinct())
    return postings.join(probe, "word", "inner").select("word", "path")


def postings_remove(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """Drop single (word, path) pairs; a word without pairs disappears."""
    return postings.join(pairs.select("word", "path").distinct(), ["word", "path"], "left_anti")


def has_word(probe: DataFrame, postings: DataFrame) -> DataFrame:
    """probe(word) -> (word, has_word): the word has at least one posting."""
    from lexisieve.session import broadcast_if_small

    asked = broadcast_if_small(probe.select("word").distinct())
    known = postings.select("word").join(asked, "word", "left_semi").distinct().withColumn("_hit", F.lit(True))
    return probe.join(known, "word", "left") \
        .withColumn("has_word", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def index_stats(postings: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: live documents (empty ones count, R16), words holding at
    least one posting, and postings."""
    if "text" in documents.columns:  # unreadable documents are never registered (R14)
        documents = documents.where(F.col("text").isNotNull())
    n_docs = documents.agg(F.countDistinct("path")).scalar()
    return postings.agg(
        n_docs.cast("bigint").alias("n_documents"),
        F.countDistinct("word").cast("bigint").alias("n_words"),
        F.count(F.lit(1)).cast("bigint").alias("n_postings"),
    )
