"""Two-way id <-> value dictionaries as tables: (id BIGINT, value STRING).

Ids are dense, from 1, in first-seen order; a removed value's id is never
handed out again (the counter is kept apart from ``max(id)``), and only a
full clear restarts the numbering (R17, R19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.text import distinct_tokens
from lexisieve.operators.ordinal import dense_ordinal
from lexisieve.session import broadcast_if_small, materialize


def tokenized(corpus: DataFrame) -> DataFrame:
    """(path, seq, words): the distinct words of every readable row, written
    once for the readers below, which take it in place of a corpus."""
    return materialize(corpus.where(F.col("text").isNotNull())
                       .select("path", "seq", distinct_tokens("text").alias("words")), "tokens")


def _word_arrays(corpus: DataFrame) -> tuple[DataFrame, Column]:
    """Rows of a corpus, or of ``tokenized``, and their array of words."""
    if "words" in corpus.columns:
        return corpus, F.col("words")
    return corpus.where(F.col("text").isNotNull()), distinct_tokens("text")


def first_sightings(corpus: DataFrame) -> DataFrame:
    """word -> earliest (seq, pos) it occurs at.

    ``array_distinct`` keeps first occurrences in order, so the position in
    the deduplicated array orders a document's new words exactly like the
    token position does, with fewer rows. The aggregate runs partially in
    every task before the shuffle, so a frequent word costs one row per task.
    Requires ``seq`` to be unique per corpus row (the add order).
    """
    rows, words = _word_arrays(corpus)
    rows = rows.select("seq", F.posexplode(words).alias("pos", "word"))
    # A word occurs once per row of the deduplicated array and seq is unique
    # per row, so the position at the smallest seq is the first sighting.
    # Both buffers are fixed-width longs: a hash aggregate, not a sort.
    return rows.groupBy("word").agg(F.min("seq").alias("seq"),
                                    F.min_by("pos", "seq").cast("bigint").alias("pos"))


def word_table(corpus: DataFrame, start: int | Column = 1) -> DataFrame:
    """(word_id, word), ids in first-seen order (document order, then position)."""
    return dense_ordinal(first_sightings(corpus), ["seq", "pos"], "word_id", start=1) \
        .select(_shift("word_id", start), "word")


def doc_table(corpus: DataFrame) -> DataFrame:
    """(doc_id, path), ids in add order (the first ``seq`` of each path).
    Unreadable documents (null text) are never registered (R14)."""
    if "text" in corpus.columns:
        corpus = corpus.where(F.col("text").isNotNull())
    first = corpus.groupBy("path").agg(F.min("seq").alias("seq"))
    return dense_ordinal(first, ["seq", "path"], "doc_id").select("doc_id", "path")


def id_postings(corpus: DataFrame, words: DataFrame, docs: DataFrame, unique_paths: bool = False) -> DataFrame:
    """(word_id, doc_id, word) postings of a corpus. Document ids meet the rows
    before their words are exploded, so the wide rows of postings are moved
    for the words only, and not at all where the word table is small. Pass
    tables that are cheap to read twice (``materialize``)."""
    rows, held = _word_arrays(corpus)
    pairs = rows.select("path", held.alias("_words")).join(broadcast_if_small(docs), "path") \
        .select("doc_id", F.explode("_words").alias("word"))
    if not unique_paths:
        pairs = pairs.distinct()
    return pairs.join(broadcast_if_small(words), "word").select("word_id", "doc_id", "word")


def _shift(id_col: str, start: int | Column) -> Column:
    if isinstance(start, int) and start == 1:
        return F.col(id_col)
    base = start if isinstance(start, Column) else F.lit(start)
    return (F.col(id_col) + base - 1).cast("bigint").alias(id_col)


def next_id(table: DataFrame, id_col: str) -> Column:
    """Counter of a table that never lost a row: max(id) + 1, as a scalar
    subquery (lazy; no value comes back to the driver)."""
    return F.coalesce(table.agg(F.max(id_col)).scalar(), F.lit(0)).cast("bigint") + 1


def extend_word_table(table: DataFrame, corpus: DataFrame, counter: Column | int | None = None) -> DataFrame:
    """Intern the words of ``corpus`` into ``table``: known words keep their
    ids, unseen ones get the next ids in first-seen order.

    ``counter`` is the next free id; by default max(id) + 1, which is only
    right when nothing was ever removed from the table.
    """
    start = next_id(table, "word_id") if counter is None else counter
    fresh = first_sightings(corpus).join(table.select("word"), "word", "left_anti")
    numbered = dense_ordinal(fresh, ["seq", "pos"], "word_id").select(_shift("word_id", start), "word")
    return table.select("word_id", "word").unionByName(numbered)


def lookup_ids(probe: DataFrame, table: DataFrame, value_col: str = "word") -> DataFrame:
    """value -> id for the probe values that are known (inner join)."""
    return probe.join(table, value_col, "inner")


def lookup_values(probe: DataFrame, table: DataFrame, id_col: str = "word_id") -> DataFrame:
    """id -> value for the probe ids that are known (inner join); a table that
    is small by measure is broadcast, so the probe is not moved."""
    return probe.join(broadcast_if_small(table), id_col, "inner")


def _membership(probe: DataFrame, table: DataFrame, key: str, flag: str) -> DataFrame:
    # Only the asked-for keys of the table are made distinct.
    asked = broadcast_if_small(probe.select(key).distinct())
    known = table.select(key).join(asked, key, "left_semi").distinct().withColumn("_hit", F.lit(True))
    return probe.join(known, key, "left").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def has_id(probe: DataFrame, table: DataFrame, id_col: str = "word_id") -> DataFrame:
    return _membership(probe, table, id_col, "has_id")


def has_value(probe: DataFrame, table: DataFrame, value_col: str = "word") -> DataFrame:
    return _membership(probe, table, value_col, "has_value")


def remove_by_id(table: DataFrame, ids: DataFrame, id_col: str = "word_id") -> DataFrame:
    return table.join(ids.select(id_col).distinct(), id_col, "left_anti")


def remove_by_value(table: DataFrame, values: DataFrame, value_col: str = "word") -> DataFrame:
    return table.join(values.select(value_col).distinct(), value_col, "left_anti")


def dictionary_size(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).cast("bigint").alias("size"))
