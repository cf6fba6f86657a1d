"""The index in id form: postings as pairs of numbers, with both dictionaries.

Postings (word_id, doc_id) are stored by word bucket and sorted by word_id;
the word table (word, word_id, n_docs) by the word's bucket, so a query word
reads one bucket of each; the document table (doc_id, path) in ranges of ids.
A search turns its words into ids, does all set work on longs, and meets the
document table only with its hits.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.operators.dictionary import doc_table, id_postings, tokenized, word_table
from lexisieve.operators.index import BUCKETS_KEY, DEFAULT_BUCKETS, bucket_of, stored_buckets
from lexisieve.operators.search import _normalise
from lexisieve.session import broadcast_if_small, materialize


class IdIndex(NamedTuple):
    postings: DataFrame   # word_id, doc_id, bucket
    words: DataFrame      # word, word_id, n_docs, bucket
    documents: DataFrame  # doc_id, path


def write_id_index(corpus: DataFrame, location: str, buckets: int = DEFAULT_BUCKETS, unique_paths: bool = False) -> None:
    """Number the words and documents of a corpus in first-seen order (R17,
    R19) and store the id form. A posting belongs to its word's bucket."""
    rows = tokenized(corpus)
    words, docs = materialize(word_table(rows), "word-ids"), materialize(doc_table(rows), "doc-ids")
    pairs = id_postings(rows, words, docs, unique_paths) \
        .select("word_id", "doc_id", bucket_of("word", buckets).alias("bucket"))
    pairs.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word_id", "doc_id") \
        .write.partitionBy("bucket").parquet(f"{location}/postings")
    counts = corpus.sparkSession.read.parquet(f"{location}/postings").groupBy("word_id").agg(F.count(F.lit(1)).alias("n_docs"))
    words.join(counts, "word_id").select(F.col("word").alias("word", metadata={BUCKETS_KEY: buckets}), "word_id", "n_docs",
                                         bucket_of("word", buckets).alias("bucket")) \
        .hint("rebalance", "bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{location}/words")
    docs.select("doc_id", "path").repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(f"{location}/documents")


def read_id_index(spark: SparkSession, location: str) -> IdIndex:
    return IdIndex(*(spark.read.parquet(f"{location}/{t}") for t in ("postings", "words", "documents")))


def word_ids(index: IdIndex, words: Iterable[str]) -> dict[str, int]:
    """The ids of known words: at most one row a word, from their buckets."""
    asked = _normalise(words)
    buckets = stored_buckets(index.words) or DEFAULT_BUCKETS
    rows = index.words.where(F.col("bucket").isin([bucket_of(F.lit(w), buckets) for w in asked]) & F.col("word").isin(asked))
    return {r["word"]: r["word_id"] for r in rows.select("word", "word_id").collect()} if asked else {}


def _listed(index: IdIndex, ids: dict[str, int]) -> DataFrame:
    """The postings of some words: their buckets and ids are literals."""
    if not ids:
        return index.postings.where(F.lit(False))
    buckets = stored_buckets(index.words) or DEFAULT_BUCKETS
    return index.postings.where(F.col("bucket").isin([bucket_of(F.lit(w), buckets) for w in ids])
                                & F.col("word_id").isin(list(ids.values())))


def resolve(index: IdIndex, hits: DataFrame) -> DataFrame:
    """Paths of hits (doc_id), sorted; hits are broadcast where small, and the
    document table is filtered for them in place."""
    return index.documents.join(broadcast_if_small(hits.select("doc_id")), "doc_id").select("path").orderBy("path")


def search_one_ids(index: IdIndex, word: str) -> DataFrame:
    return resolve(index, _listed(index, word_ids(index, [word])))


def search_all_ids(index: IdIndex, words: Iterable[str]) -> DataFrame:
    """Paths with every word; with an unknown word there are none (R7)."""
    asked = _normalise(words)
    ids = word_ids(index, asked)
    if not asked or len(ids) < len(asked):
        return resolve(index, _listed(index, {}))
    hits = _listed(index, ids).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(asked))
    return resolve(index, hits)


def search_any_ids(index: IdIndex, words: Iterable[str]) -> DataFrame:
    """Paths with at least one word; unknown ones are skipped (R8)."""
    return resolve(index, _listed(index, word_ids(index, words)).select("doc_id").distinct())
