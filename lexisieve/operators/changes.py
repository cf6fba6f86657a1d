"""Index maintenance as a change log: (seq, op, path, text), ops ADD,
REINDEX, REMOVE, CLEAR, applied in ``seq`` order (seq unique over the log).

The index is a function of the whole log, so it is derived, not mutated:

1. rows at or before the last CLEAR are gone; ADD/REINDEX rows whose text
   is null (unreadable file) change nothing (R14);
2. a path's current life is its rows after its last REMOVE (R15, R17);
3. a word is findable for the path iff, in the current life, the row right
   after the last row containing the word is not a REINDEX (R11, R12): an
   ADD never takes postings away, a REINDEX drops exactly the words of the
   row before it.

Neighbouring rows of a path are found without one window over the whole
path (a hot path may hold a third of the log): rows are cut into blocks of
consecutive ``seq``; ``lead``/``lag`` run inside each (path, block), and a
block-level table (one row per block) bridges block borders. Blocks hold a
bounded number of rows because ``seq`` values are unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisieve.functions.text import distinct_tokens
from lexisieve.operators.dictionary import word_table
from lexisieve.operators.ordinal import dense_ordinal, prefix_count
from lexisieve.schemas import ADD, CLEAR, REINDEX, REMOVE

# Average rows per seq block; bounds the work of one window partition.
BLOCK_ROWS = 1 << 17


def _seq_stats(log: DataFrame) -> tuple[int, int]:
    """(span of seq, rows): one small aggregate job, scalars to the driver."""
    r = log.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("seq").alias("n")).first()
    if not r or not r["n"]:
        return 1, 0
    return int(r["hi"]) - int(r["lo"]) + 1, int(r["n"])


def _with_blocks(rows: DataFrame, keys: list[str], width: int | None) -> DataFrame:
    """Add ``_blk``. By seq value (``seq div width``) when the fullest
    (keys, block) group stays within a few times the target; otherwise, for
    seq values clustered so densely that one block would swell, by rank:
    ``ordinal(seq) div BLOCK_ROWS``, which bounds every block exactly."""
    if width is not None:
        return rows.withColumn("_blk", F.expr(f"seq div {width}"))
    span, n = _seq_stats(rows)
    width = min(1 << 62, max(1, math.ceil(span * BLOCK_ROWS / max(n, 1))))
    by_value = rows.withColumn("_blk", F.expr(f"seq div {width}"))
    if n <= 8 * BLOCK_ROWS:  # no block can exceed the bound: skip the check
        return by_value
    fullest = by_value.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if fullest is None or fullest <= 8 * BLOCK_ROWS:
        return by_value
    ranks = dense_ordinal(rows.select("seq"), ["seq"], "_rank")
    return rows.join(ranks, "seq").withColumn("_blk", F.expr(f"_rank div {BLOCK_ROWS}")).drop("_rank")


def after_last_clear(log: DataFrame) -> Column:
    last_clear = log.where(F.col("op") == CLEAR).agg(F.max("seq")).scalar()
    # One reference to the subquery: without a CLEAR the comparison is null.
    return F.coalesce(F.col("seq") > last_clear, F.lit(True))


def effective(log: DataFrame) -> Column:
    """Rows that act: REMOVE, and ADD/REINDEX with readable text."""
    return F.col("path").isNotNull() & F.col("seq").isNotNull() & (
        (F.col("op") == REMOVE) | (F.col("op").isin(ADD, REINDEX) & F.col("text").isNotNull()))


# Integer codes of the ops inside the neighbour computation (fixed-width
# aggregation buffers); 0 is "no row".
_CODES = {ADD: 1, REINDEX: 2, REMOVE: 3}


def _code(c: Column) -> Column:
    """Op name -> code (0 for anything else)."""
    return (F.when(c == ADD, F.lit(_CODES[ADD])).when(c == REINDEX, F.lit(_CODES[REINDEX]))
            .when(c == REMOVE, F.lit(_CODES[REMOVE])).otherwise(F.lit(0)))


def _name(c: Column) -> Column:
    """Code -> op name (null for 0 / no row)."""
    return (F.when(c == _CODES[ADD], F.lit(ADD)).when(c == _CODES[REINDEX], F.lit(REINDEX))
            .when(c == _CODES[REMOVE], F.lit(REMOVE)))


def neighbours(rows: DataFrame, keys: list[str], width: int | None = None) -> DataFrame:
    """Add ``prev_op``, ``next_op`` (the op of the previous / next row of the
    same ``keys`` group by seq) and ``last_remove`` (the group's last REMOVE).
    ``width`` fixes the seq block width; by default it is chosen from the data
    (see ``_with_blocks``). Blocks must only be monotone in seq."""
    rows = _with_blocks(rows, keys, width).withColumn("_c", _code(F.col("op")))
    inside = Window.partitionBy(*keys, "_blk").orderBy("seq")
    rows = rows.withColumn("_next_in", F.lead("_c").over(inside)) \
        .withColumn("_prev_in", F.lag("_c").over(inside))
    # One row per block. Catalyst prunes the window and the token arrays out
    # of this branch, so it reads and shuffles only narrow (key, seq, op)
    # rows; texts are tokenised once, on the row side.
    blocks = rows.groupBy(*keys, "_blk").agg(
        F.min_by("_c", "seq").alias("_first"),
        F.max_by("_c", "seq").alias("_last"),
        F.max(F.when(F.col("_c") == _CODES[REMOVE], F.col("seq"))).alias("_blk_rm"))
    by_block = Window.partitionBy(*keys).orderBy("_blk")
    whole = Window.partitionBy(*keys)
    blocks = blocks.select(
        *keys, "_blk",
        F.lead("_first").over(by_block).alias("_next_blk"),
        F.lag("_last").over(by_block).alias("_prev_blk"),
        F.max("_blk_rm").over(whole).alias("last_remove"))
    out = rows.join(blocks, [*keys, "_blk"], "inner")
    return out.withColumn("next_op", _name(F.coalesce("_next_in", "_next_blk"))) \
        .withColumn("prev_op", _name(F.coalesce("_prev_in", "_prev_blk"))) \
        .drop("_blk", "_c", "_next_in", "_prev_in", "_next_blk", "_prev_blk")


def _current(log: DataFrame, with_words: bool) -> DataFrame:
    rows = log.where(after_last_clear(log) & effective(log))
    if with_words:
        rows = rows.select("path", "seq", "op", distinct_tokens("text").alias("words"))
    else:
        rows = rows.select("path", "seq", "op")
    return neighbours(rows, ["path"])


def _in_life() -> Column:
    return F.col("last_remove").isNull() | (F.col("seq") > F.col("last_remove"))


def _life(log: DataFrame) -> DataFrame:
    """Rows of the current lives: (path, seq, op, words, next_op)."""
    return _current(log, with_words=True).where(_in_life() & (F.col("op") != REMOVE))


def _live_postings(life: DataFrame, lone: bool = False) -> DataFrame:
    killed = F.coalesce(F.col("next_op") == REINDEX, F.lit(False))
    if lone:
        # A path with one row in its life has the words of that row, a set
        # already: only other paths' words meet in a shuffle.
        alone = F.col("next_op").isNull() & (F.col("prev_op").isNull() | (F.col("prev_op") == REMOVE))
        single = life.where(alone).select("path", F.explode("words").alias("word"))
        return single.unionByName(_live_postings(life.where(~alone)))
    cand = life.select("path", "seq", killed.alias("killed"), F.explode("words").alias("word"))
    last = cand.groupBy("path", "word").agg(F.max_by("killed", "seq").alias("killed"))
    return last.where(~F.col("killed")).select("path", "word")


def apply_changes(log: DataFrame, lone: bool = False) -> DataFrame:
    """Live postings (path, word) after the whole log. ``lone`` is for logs
    where most paths have one row: their words are not moved."""
    return _live_postings(_life(log), lone)


def live_documents(log: DataFrame) -> DataFrame:
    """(doc_id, path) of live documents. A document id is the ordinal of its
    life start among all life starts after the last CLEAR, dead ones
    included, so a removed and re-added path gets a new id (R17)."""
    n = _current(log, with_words=False)
    starts = n.where((F.col("op") != REMOVE) & (F.col("prev_op").isNull() | (F.col("prev_op") == REMOVE)))
    numbered = dense_ordinal(starts.select("path", "seq", "last_remove"), ["seq"], "doc_id")
    return numbered.where(_in_life()).select("doc_id", "path")


def has_file(probe: DataFrame, log: DataFrame) -> DataFrame:
    """probe(path) -> (path, has_file, doc_id); exact path match (R20)."""
    docs = live_documents(log)
    return probe.join(docs, "path", "left").withColumn("has_file", F.col("doc_id").isNotNull())


def log_word_table(log: DataFrame) -> DataFrame:
    """Word ids of the log: first sighting after the last CLEAR, by (seq,
    position); words of removed documents keep their ids (R18, R19)."""
    rows = log.where(after_last_clear(log) & effective(log) & (F.col("op") != REMOVE))
    return word_table(rows.select("path", "seq", "text"))


def change_outcomes(log: DataFrame) -> DataFrame:
    """(seq, op, path, outcome): the boolean each call would have returned.

    ADD/REINDEX: the text was readable. REMOVE: the path was live, i.e. the
    previous acting row of the path in the same CLEAR epoch added it. CLEAR
    (and unknown ops): null. The epoch is a distributed prefix count of
    CLEAR rows by seq.
    """
    narrow = log.select("seq", "op", "path", F.col("text").isNotNull().alias("has_text"),
                        (F.col("op") == CLEAR).alias("_is_clear"))
    narrow = prefix_count(narrow, ["seq"], "_is_clear", "epoch")
    acting = F.col("path").isNotNull() & (
        (F.col("op") == REMOVE) | (F.col("op").isin(ADD, REINDEX) & F.col("has_text")))
    eff = narrow.where(acting)
    n = neighbours(eff.select("path", "epoch", "seq", "op"), ["path", "epoch"])
    removes = n.where(F.col("op") == REMOVE).select(
        "seq", "op", "path", F.coalesce(F.col("prev_op").isin(ADD, REINDEX), F.lit(False)).alias("outcome"))
    others = narrow.where(~F.coalesce(acting & (F.col("op") == REMOVE), F.lit(False))).select(
        "seq", "op", "path",
        F.when(F.col("op").isin(ADD, REINDEX), F.col("has_text") & F.col("path").isNotNull())
        .when(F.col("op") == REMOVE, F.lit(False))
        .otherwise(F.lit(None).cast("boolean")).alias("outcome"))
    return removes.unionByName(others)


def duplicate_seqs(log: DataFrame) -> DataFrame:
    """Rows whose ``seq`` is not unique: the log's order would be ambiguous.
    Empty for a valid log (partial aggregation; no row reaches the driver)."""
    dup = log.groupBy("seq").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("seq")
    return log.join(dup, "seq", "left_semi")


def compact_log(log: DataFrame) -> DataFrame:
    """An equivalent, shorter log: for every live path, at most two ADD rows
    that rebuild its live postings and its current word set.

    - at the life's first seq: the live words that are not in the current
      word set (left over from earlier ADDs, R11), space-separated;
    - at the life's last seq: the text of the last row (the current set).

    Any later log (seqs above this one's) applied after the compacted rows
    gives the same postings as after the full log: a later REINDEX removes
    exactly the current set, leaving the left-overs, as it would have. Dead
    paths, CLEAR rows and no-op rows disappear. Dense ids (doc and word) are
    not kept: store ``live_documents`` / ``log_word_table`` first if needed.
    """
    from lexisieve.session import materialize

    # The life rows feed three consumers: written once, read three times.
    life = materialize(_life(log).select("path", "seq", "words", "next_op"), "life")
    ends = life.groupBy("path").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("seq"))
    last = life.join(ends, ["path", "seq"], "inner")
    current = last.select("path", F.explode("words").alias("word"))
    leftover = _live_postings(life).join(current, ["path", "word"], "left_anti")
    # One document's left-over words: bounded by that document's own postings.
    left_rows = leftover.groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("word")), " ").alias("text")) \
        .join(ends, "path").select(F.col("first_seq").alias("seq"), F.lit(ADD).alias("op"), "path", "text")
    texts = log.select("path", "seq", "text").join(last.select("path", "seq"), ["path", "seq"], "left_semi")
    last_rows = texts.select("seq", F.lit(ADD).alias("op"), "path", "text")
    return left_rows.unionByName(last_rows)
