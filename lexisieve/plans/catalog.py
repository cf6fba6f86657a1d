"""Registered queries: one per operator, each over the given tables.

Every query reads whole tables (documents, pages, benchmark, labels,
conversations) and derives its inputs from them with Spark, so its work
grows with the data. Search parameters are fixed literals, like the
substitution parameters of a benchmark query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.operators import changes as chg
from lexisieve.operators import dictionary as dic
from lexisieve.operators import id_index as idi
from lexisieve.operators import index as idx
from lexisieve.operators import search as srch
from lexisieve.operators.ordinal import dense_ordinal
from lexisieve.operators.stored_dictionary import StoredDictionary
from lexisieve.plans import requests as rq
from lexisieve.schemas import ADD, REMOVE
from lexisieve.session import materialize, scratch_path
from lexisieve.sources.corpus import (
    conversation_changes,
    corpus_changes,
    document_corpus,
    page_corpus,
    read_table,
)
from lexisieve.sources.requests import benchmark_requests, passage_requests
from lexisieve.sources.snapshots import folder_changes, read_shards, snapshot, write_shards
from lexisieve.streaming.ingest import (
    latest_outcomes, latest_postings, latest_terms, merge_producers, read_log, read_merged, stream_changes, stream_index,
    stream_ingest, stream_merge, stream_outcomes,
)

# Fixed query parameters.
ONE_WORD = "License"
ALL_WORDS = ["the", "Nicht", "zu"]
ANY_WORDS = ["schst", "ouen", "trash", "café"]
PAIR_AND = ("nicht", "zu")
PAIR_OR = ("license", "trash")

Query = Callable[[SparkSession, str], DataFrame]


def _doc_postings(spark, sf):
    return idx.doc_words(document_corpus(spark, sf), unique_paths=True)


_stored: dict[tuple, str] = {}


def _files_now(table: DataFrame) -> int:
    """A sum over a table's files: names, sizes and times of change."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return files.agg(F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))).first()[0] or 0


def _state_of_documents(spark, sf) -> tuple:
    """Application, folder and state of the documents' files."""
    return spark.sparkContext.applicationId, sf, _files_now(read_table(spark, sf, "documents"))


def _stored_index(spark, sf):
    """(postings, terms) of the documents, written in the stored, bucketed
    layout as searches read them; once per application, folder and state of
    the folder's files."""
    key = _state_of_documents(spark, sf)
    if key not in _stored:
        location = scratch_path(spark, "index")
        idx.write_index(_doc_postings(spark, sf), location)
        _stored[key] = location
    return idx.read_index(spark, _stored[key])


def _stored_postings(spark, sf):
    return _stored_index(spark, sf)[0]


def _page_postings(spark, sf):
    return idx.doc_words(page_corpus(spark, sf))


def _toxic_paths(spark, sf):
    lab = read_table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    return document_corpus(spark, sf).join(lab.withColumnRenamed("doc_id", "seq"), "seq", "left_semi").select("path")


def _request_words(spark, sf):
    parsed = rq.parse_requests(benchmark_requests(spark, sf))
    return parsed.where(F.col("error").isNull()).select(F.explode("words").alias("word")).distinct()


# 2.1 scans, sources, sinks ---------------------------------------------------

def q_scan_corpus(spark, sf):
    return document_corpus(spark, sf).unionByName(page_corpus(spark, sf))


def _document_files(spark, sf):
    """Documents as files: (path, content, modified); the times are all one."""
    return document_corpus(spark, sf).select("path", F.col("text").cast("binary").alias("content"),
                                             F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modified"))


def _shards(spark) -> int:
    return max(8, spark.sparkContext.defaultParallelism)


def q_scan_files(spark, sf):
    """The documents' files, stored in shards, read back whole and indexed."""
    folder = scratch_path(spark, "files")
    write_shards(_document_files(spark, sf), folder, _shards(spark))
    files = read_shards(spark, folder).select("path", F.col("content").cast("string").alias("text"))
    return idx.doc_words(files, unique_paths=True)


def _two_snapshots(spark, sf):
    """Two stored states of a folder: the documents; then without the toxic
    ones, with every seventh one's text between stars, and with the pages."""
    old, new = scratch_path(spark, "folder"), scratch_path(spark, "folder")
    files = _document_files(spark, sf)
    write_shards(files, old, _shards(spark))
    number = F.regexp_extract("path", "[0-9]+$", 0).cast("bigint")
    edited = F.when(number % 7 == 0, F.concat(F.lit(b"*"), "content", F.lit(b"*"))).otherwise(F.col("content"))
    later = files.join(_toxic_paths(spark, sf), "path", "left_anti").select("path", edited.alias("content"), "modified")
    pages = page_corpus(spark, sf).groupBy("path").agg(F.min("text").alias("text")).select(
        "path", F.col("text").cast("binary").alias("content"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("modified"))
    write_shards(later.unionByName(pages), new, _shards(spark))
    return read_shards(spark, old), read_shards(spark, new)


def q_folder_changes(spark, sf):
    """The change log between two snapshots of a folder."""
    old, new = _two_snapshots(spark, sf)
    return folder_changes(materialize(snapshot(old), "manifest"), new)


def q_folder_rescan(spark, sf):
    """The first snapshot added file by file, then the changes of the second:
    the live postings."""
    old, new = _two_snapshots(spark, sf)
    # The ordinal is written as it is made: the texts are not written again.
    adds = dense_ordinal(old.select("path", F.lit(ADD).alias("op"), F.col("content").cast("string").alias("text")), ["path"], "seq") \
        .select("seq", "op", "path", "text")
    changes = materialize(folder_changes(snapshot(old), new, start=old.count() + 1), "folder-changes")
    return chg.apply_changes(adds.unionByName(changes), lone=True)


def q_parse_requests(spark, sf):
    p = rq.parse_requests(benchmark_requests(spark, sf))
    return p.select("req_id", "cmd", F.array_join("words", " ").alias("words"),
                    F.when(F.col("words").isNotNull(), F.size("words")).cast("bigint").alias("n_words"), "error")


def q_render_responses(spark, sf):
    parsed = rq.parse_requests(benchmark_requests(spark, sf))
    postings = materialize(_page_postings(spark, sf), "page-postings")
    return rq.render_responses(parsed, materialize(srch.batch_search(postings, parsed), "hits"))


def q_run_requests(spark, sf):
    postings, terms = _stored_index(spark, sf)
    return rq.run_requests(postings, benchmark_requests(spark, sf), terms=terms)


def q_run_passages(spark, sf):
    """Requests with punctuation, and some without words."""
    postings, terms = _stored_index(spark, sf)
    return rq.run_requests(postings, passage_requests(spark, sf), terms=terms)


def q_parse_responses(spark, sf):
    """Responses are rendered once and stored (the sink), then read back by
    the client-side parser, as a reader of a response stream would."""
    stored = materialize(q_run_requests(spark, sf), "responses")
    return rq.parse_responses(rq.number_lines(stored))


# 2.2 text functions ---------------------------------------------------------

def q_lower_ascii(spark, sf):
    from lexisieve.functions.text import lower_ascii
    return document_corpus(spark, sf).select("path", lower_ascii("text").alias("text"))


def q_alnum_chars(spark, sf):
    from lexisieve.functions.text import alnum_count
    return document_corpus(spark, sf).select("path", alnum_count("text").alias("n_alnum"))


def q_tokenize(spark, sf):
    return idx.tokenize(document_corpus(spark, sf))


def q_doc_words(spark, sf):
    return _doc_postings(spark, sf)


# 2.3 dictionaries -------------------------------------------------------------

def q_word_table(spark, sf):
    return dic.word_table(document_corpus(spark, sf))


def q_doc_table(spark, sf):
    return dic.doc_table(document_corpus(spark, sf))


def q_word_table_extend(spark, sf):
    base = dic.word_table(document_corpus(spark, sf))
    return dic.extend_word_table(base, page_corpus(spark, sf))


def q_lookup_ids(spark, sf):
    return dic.lookup_ids(_request_words(spark, sf), dic.word_table(document_corpus(spark, sf)))


def q_lookup_values(spark, sf):
    rows = dic.tokenized(document_corpus(spark, sf))
    words, docs = materialize(dic.word_table(rows), "word-ids"), materialize(dic.doc_table(rows), "doc-ids")
    id_form = dic.id_postings(rows, words, docs, unique_paths=True).select("doc_id", "word_id")
    return dic.lookup_values(dic.lookup_values(id_form, words, "word_id"), docs, "doc_id") \
        .select("doc_id", "word_id", "path", "word")


def q_has_id(spark, sf):
    docs = dic.doc_table(document_corpus(spark, sf))
    left = dic.remove_by_value(docs, _toxic_paths(spark, sf), "path")
    return dic.has_id(docs.select("doc_id"), left, "doc_id")


def q_has_value(spark, sf):
    return dic.has_value(_request_words(spark, sf), dic.word_table(document_corpus(spark, sf)), "word")


def q_remove_by_id(spark, sf):
    docs = dic.doc_table(document_corpus(spark, sf))
    gone = dic.lookup_ids(_toxic_paths(spark, sf), docs, "path").select("doc_id")
    return dic.remove_by_id(docs, gone, "doc_id")


def q_remove_by_value(spark, sf):
    words = dic.word_table(document_corpus(spark, sf))
    return dic.remove_by_value(words, _request_words(spark, sf), "word")


def q_dictionary_size(spark, sf):
    corpus = document_corpus(spark, sf)
    w = dic.dictionary_size(dic.word_table(corpus)).select(F.lit("word_table").alias("name"), "size")
    d = dic.dictionary_size(dic.doc_table(corpus)).select(F.lit("doc_table").alias("name"), "size")
    return w.unionByName(d)


def q_dictionary_store(spark, sf):
    """A stored dictionary over several runs: the documents' paths, without the
    toxic ones, then the pages', then the toxic ones again, under new ids."""
    base = scratch_path(spark, "dictionary")
    corpus, pages = document_corpus(spark, sf), page_corpus(spark, sf)
    toxic = corpus.join(_toxic_paths(spark, sf), "path", "left_semi")
    StoredDictionary(spark, base).intern(corpus, ["seq"], "path")
    StoredDictionary(spark, base).remove(toxic, "path")
    StoredDictionary(spark, base).intern(pages, ["seq"], "path")
    StoredDictionary(spark, base).intern(toxic, ["seq"], "path")
    return StoredDictionary(spark, base).table().select("id", F.col("value").alias("path"))


# 2.4 forward index ------------------------------------------------------------

def q_forward_index(spark, sf):
    fwd = idx.forward_index(_doc_postings(spark, sf))
    return fwd.select("path", F.size("words").cast("bigint").alias("n_words"),
                      F.array_join("words", " ").alias("words"))


def q_forward_add(spark, sf):
    return idx.forward_add(_stored_postings(spark, sf), _page_postings(spark, sf))


def q_forward_lookup(spark, sf):
    lab = read_table(spark, sf, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("seq"))
    paths = document_corpus(spark, sf).join(lab, "seq", "left_semi").select("path")
    return idx.forward_lookup(_doc_postings(spark, sf), paths)


def q_forward_replace(spark, sf):
    """The toxic documents' word sets become their request words, maybe none."""
    post, toxic = _doc_postings(spark, sf), _toxic_paths(spark, sf)
    new = post.join(toxic, "path", "left_semi").join(_request_words(spark, sf), "word", "left_semi")
    return idx.forward_replace(post, new, toxic)


def q_forward_remove(spark, sf):
    return idx.forward_remove(_doc_postings(spark, sf), _toxic_paths(spark, sf))


def q_index_stats(spark, sf):
    return idx.index_stats(_doc_postings(spark, sf), document_corpus(spark, sf))


# 2.5 inverted index -----------------------------------------------------------

def q_inverted_index(spark, sf):
    """The word-clustered layout, written and read back."""
    return _stored_postings(spark, sf).select("word", "path")


def q_term_statistics(spark, sf):
    """The document counts stored beside the postings."""
    return _stored_index(spark, sf)[1].select("word", "n_docs")


def q_postings_merge(spark, sf):
    return idx.postings_merge(_stored_postings(spark, sf), _page_postings(spark, sf))


def q_postings_lookup(spark, sf):
    return idx.postings_lookup(_doc_postings(spark, sf), _request_words(spark, sf))


def q_postings_remove(spark, sf):
    post = _doc_postings(spark, sf)
    pairs = post.join(_toxic_paths(spark, sf), "path", "left_semi") \
        .join(_request_words(spark, sf), "word", "left_semi")
    return idx.postings_remove(post, pairs)


def q_has_word(spark, sf):
    left = idx.forward_remove(_doc_postings(spark, sf), _toxic_paths(spark, sf))
    return idx.has_word(_request_words(spark, sf), left)


# 2.6 index maintenance ----------------------------------------------------------

def q_has_file(spark, sf):
    log = conversation_changes(spark, sf)
    return chg.has_file(log.select("path").distinct(), log).select("path", "has_file", "doc_id")


def q_changes_add(spark, sf):
    return chg.apply_changes(conversation_changes(spark, sf, "add"))


def q_changes_reindex(spark, sf):
    return chg.apply_changes(conversation_changes(spark, sf, "reindex"))


def _add_then_remove_toxic(spark, sf):
    corpus = document_corpus(spark, sf)
    adds = corpus_changes(corpus.withColumn("seq", F.col("seq") * 2), ADD)
    toxic = corpus.join(_toxic_paths(spark, sf), "path", "left_semi")
    removes = toxic.select((F.col("seq") * 2 + 1).alias("seq"), F.lit(REMOVE).alias("op"), "path",
                           F.lit(None).cast("string").alias("text"))
    return adds.unionByName(removes)


def q_changes_remove(spark, sf):
    return chg.apply_changes(_add_then_remove_toxic(spark, sf))


def q_changes_clear(spark, sf):
    return chg.apply_changes(conversation_changes(spark, sf, "clear"))


def q_apply_changes(spark, sf):
    return chg.apply_changes(conversation_changes(spark, sf))


def q_compact_log(spark, sf):
    return chg.compact_log(conversation_changes(spark, sf, "clear"))


def q_live_documents(spark, sf):
    return chg.live_documents(conversation_changes(spark, sf))


def q_change_outcomes(spark, sf):
    return chg.change_outcomes(conversation_changes(spark, sf, "clear"))


# 2.7 search -----------------------------------------------------------------------

def q_search_one(spark, sf):
    return srch.search_one(_stored_postings(spark, sf), ONE_WORD)


def q_search_all(spark, sf):
    return srch.search_all(_stored_postings(spark, sf), ALL_WORDS)


def q_search_any(spark, sf):
    return srch.search_any(_stored_postings(spark, sf), ANY_WORDS)


def q_postings_intersect(spark, sf):
    return srch.postings_intersect(_stored_postings(spark, sf), *PAIR_AND)


def q_postings_union(spark, sf):
    return srch.postings_union(_stored_postings(spark, sf), *PAIR_OR)


_ids: dict[tuple, str] = {}


def _id_index(spark, sf):
    """The documents' index in id form, stored as often as ``_stored_index``
    is, but without it: it is written from the corpus."""
    key = _state_of_documents(spark, sf)
    if key not in _ids:
        location = scratch_path(spark, "id-index")
        idi.write_id_index(document_corpus(spark, sf), location, unique_paths=True)
        _ids[key] = location
    return idi.read_id_index(spark, _ids[key])


def q_search_one_ids(spark, sf):
    return idi.search_one_ids(_id_index(spark, sf), ONE_WORD)


def q_search_all_ids(spark, sf):
    return idi.search_all_ids(_id_index(spark, sf), ALL_WORDS)


def q_search_any_ids(spark, sf):
    return idi.search_any_ids(_id_index(spark, sf), ANY_WORDS)


def q_resolve_sorted(spark, sf):
    corpus = document_corpus(spark, sf)
    docs = dic.doc_table(corpus)
    hits = srch.search_one(_stored_postings(spark, sf), ONE_WORD).join(docs, "path").select("doc_id")
    live = dic.remove_by_value(docs, _toxic_paths(spark, sf), "path")
    return srch.resolve_sorted(hits, live).select("doc_id", "path")


def q_batch_search(spark, sf):
    parsed = rq.parse_requests(benchmark_requests(spark, sf))
    postings, terms = _stored_index(spark, sf)
    return srch.batch_search(postings, parsed, terms=terms)


# 2.8 streaming ----------------------------------------------------------------------

def q_merge_producers(spark, sf):
    conv = conversation_changes(spark, sf)
    docs = corpus_changes(document_corpus(spark, sf), ADD)
    return merge_producers(conv, docs).select("producer", "seq", "op", "path", "text")


def q_stream_merge(spark, sf):
    """The same two producers as file streams. The first run takes in the
    earlier half of each one's rows; then both send all their rows again."""
    base = scratch_path(spark, "stream-merge")
    producers = [conversation_changes(spark, sf).select("seq", "op", "path", "text"),
                 corpus_changes(document_corpus(spark, sf), ADD)]
    middle = [p.agg((F.min("seq") + F.max("seq")) / 2).first()[0] for p in producers]  # two scalars
    for again in (False, True):
        for i, (p, half) in enumerate(zip(producers, middle)):
            (p if again else p.where(F.col("seq") <= half)).write.mode("append").parquet(f"{base}/in{i}")
        merged = merge_producers(*[stream_changes(spark, f"{base}/in{i}") for i in range(2)])
        stream_merge(merged, f"{base}/merged", f"{base}/checkpoint").awaitTermination()
    return read_merged(spark, f"{base}/merged").select("producer", "seq", "op", "path", "text")


def _conversation_stream(spark, sf):
    """The conversations table as a file stream of change rows."""
    conv_schema = read_table(spark, sf, "conversations").schema
    src = spark.readStream.schema(conv_schema).parquet(f"{sf.rstrip('/')}/conversations*.parquet")
    seq = (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint")
    op = (F.when((F.col("conv_id") + F.col("turn")) % 5 == 4, F.lit(REMOVE))
          .when(F.col("role") == "assistant", F.lit("REINDEX")).otherwise(F.lit(ADD)))
    return src.select(seq.alias("seq"), op.alias("op"),
                      F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("path"), "text")


def q_stream_ingest(spark, sf):
    """Stream the conversations change rows into a fresh log folder
    (availableNow), then derive the live postings from the log."""
    base = scratch_path(spark, "stream-ingest")
    q = stream_ingest(_conversation_stream(spark, sf), f"{base}/log", f"{base}/checkpoint")
    q.awaitTermination()
    return chg.apply_changes(read_log(spark, f"{base}/log"))


def _shuffled_stream(spark, sf, base, mode="mixed", batches=4):
    """The conversations' log as a stream of some micro-batches, many files
    each. Rows are dealt by seq, so most paths are touched by every batch, and
    batches are out of order."""
    log = conversation_changes(spark, sf, mode).select("seq", "op", "path", "text")
    width = max(batches, spark.sparkContext.defaultParallelism)
    log.repartition(width, F.xxhash64("seq")).write.parquet(f"{base}/in")
    files = spark.read.parquet(f"{base}/in").select("_metadata.file_path").distinct().count()
    return stream_changes(spark, f"{base}/in", max_files_per_trigger=max(1, -(-files // batches)))


def q_stream_outcomes(spark, sf):
    """The outcomes of the log with a CLEAR, kept while it streams in."""
    base = scratch_path(spark, "stream-outcomes")
    stream_outcomes(_shuffled_stream(spark, sf, base, "clear"), base, f"{base}/checkpoint").awaitTermination()
    return latest_outcomes(spark, base)


def _streamed_index(spark, sf):
    """The folder of an index kept by the stream over four micro-batches."""
    base = scratch_path(spark, "stream-index")
    changes = _shuffled_stream(spark, sf, base)
    stream_index(changes, base, f"{base}/checkpoint", compact_every=2, buckets=16).awaitTermination()
    return base


def q_stream_index(spark, sf):
    """The streaming consumer keeps the stored postings itself."""
    return latest_postings(spark, _streamed_index(spark, sf)).select("path", "word")


def q_stream_search(spark, sf):
    """A batch of requests on the index that the stream keeps, with its own
    term statistics: one AND and one ANY request for each pair of words that
    follow each other among the request words in byte order."""
    base = _streamed_index(spark, sf)
    words = dense_ordinal(_request_words(spark, sf), ["word"], "n")
    pairs = words.join(words.select((F.col("n") - 1).alias("n"), F.col("word").alias("next")), "n")
    asked = pairs.select("n", F.array("word", "next").alias("words"), F.lit(None).cast("string").alias("error"))
    queries = asked.select((F.col("n") * 2).alias("req_id"), F.lit(srch.SEARCH_ALL).alias("cmd"), "words", "error") \
        .unionByName(asked.select((F.col("n") * 2 + 1).alias("req_id"), F.lit(srch.SEARCH_ANY).alias("cmd"), "words", "error"))
    return srch.batch_search(latest_postings(spark, base), queries, terms=latest_terms(spark, base))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
