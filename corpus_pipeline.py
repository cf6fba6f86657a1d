"""Corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, masking of personal data, byte-level BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Verdicts are joined back by what
decides them (id and text hash, or text hash alone); only the rows to drop, or
the spans to mask, are joined, broadcast when measured small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.llm.byte_bpe import encode, load_ranks
from lexisieve.llm.decontaminate import contamination
from lexisieve.llm.names import free
from lexisieve.llm.ngram_join import near_duplicates
from lexisieve.llm.pii_bootstrap import find_pii, mask
from lexisieve.llm.quality_risk import judge, learn_cutoffs, measure
from lexisieve.session import broadcast_if_small, materialize

ALPHA, DELTA = 0.03, 0.05


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that no quality rule rejects."""
    features = materialize(measure(docs), "quality-features")
    judged = judge(features, learn_cutoffs(features, _table(spark, sf_dir, "labels"), ALPHA, DELTA))
    id_, hash_ = free(docs, "_id", "_h")
    out = judged.where(~F.col("kept")).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    return docs.join(broadcast_if_small(out), F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col(hash_)), "left_anti")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each component of near-duplicates (documents
    without an id stay). With repeated ids the components are of texts: a row
    goes only for its own text, or for an equal text of its id."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        return _near_duplicate_texts(docs)
    found, (id_,) = near_duplicates(docs), free(docs, "_id")
    out = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(broadcast_if_small(materialize(out, "duplicates")), F.col("doc_id").cast("long") == F.col(id_),
                     "left_anti")


def _near_duplicate_texts(docs: DataFrame) -> DataFrame:
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    texts = materialize(docs.where("doc_id is not null").select(
        key.alias("_id"), F.xxhash64(text).alias("_h"), F.xxhash64(key, text).alias("node"), "text")
        .dropDuplicates(["_id", "_h"]), "texts")
    found = near_duplicates(texts.select(F.col("node").alias("doc_id"), "text"))
    placed = materialize(found.select(F.col("doc_id").alias("node"), "component_id")
                         .join(texts.drop("text"), "node"), "text-components")
    first = placed.groupBy("component_id").agg(F.min(F.struct("_id", "_h")).alias("first"), F.count(F.lit(1)).alias("_n")) \
        .where("_n > 1").drop("_n")
    out = placed.join(broadcast_if_small(first), "component_id").where(F.struct("_id", "_h") != F.col("first"))
    id_, hash_ = free(docs, "_id", "_h")
    out = out.select(F.col("_id").alias(id_), F.col("_h").alias(hash_))
    kept = docs.join(broadcast_if_small(materialize(out, "duplicates")),
                     (key == F.col(id_)) & (F.xxhash64(text) == F.col(hash_)), "left_anti")
    return kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]) \
        .unionByName(kept.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain benchmark passages."""
    key = F.xxhash64(F.col("text").cast("string"))
    found = contamination(docs.select(key.alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark"))
    (hash_,) = free(docs, "_h")
    out = materialize(found.where("contaminated").select(F.col("doc_id").alias(hash_)).distinct(), "contaminated")
    return docs.join(broadcast_if_small(out), key == F.col(hash_), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; ``n_chars`` follows the text."""
    return mask(docs, materialize(find_pii(docs), "pii-spans"), "n_chars")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids of every text, and the text decoded from them."""
    import public_tokenizers

    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    out = encode(docs, ranks, public_tokenizers.PATTERN, decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.col("decoded").cast("string").alias("text"))


STAGES = [("quality", quality), ("near_duplicate", near_duplicate), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("byte_bpe", byte_bpe)]
#: The learnt thresholds, the bootstrap and the encoding are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
