"""The registered queries of the operators: each applies its operator to its
whole table and derives the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lexisieve.llm import token_blocks as T
    spec = T.tokenizer_spec(public_tokenizers.path("word_bpe_49k.json"))
    manifest = T.write_token_shards(_table(spark, sf_dir, "documents"), spec, T.token_folder(spark))
    return T.read_token_shards(manifest).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.language_fusion import identify
    return identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.license_scan import scan
    out = scan(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op4_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.pii_bootstrap import KINDS, find_pii, spans_text
    out = find_pii(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in KINDS], F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
                      spans_text(F.col("spans")).alias("spans"))


def op5_warc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.warc_convert import arc_archives, convert, read_warc
    return read_warc(convert(arc_archives(_table(spark, sf_dir, "pages")))) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.ngram_join import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.decontaminate import contamination
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lexisieve.llm.byte_bpe import encode, load_ranks
    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    out = encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decode=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.backoff_lm import score
    return score(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.quality_risk import COUNTS, quality_rules
    out = quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.window_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.spelling_groups import spelling_groups
    return spelling_groups(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexisieve.llm.collocations import collocations
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_blocks, op2_language_fusion, op3_license_scan, op4_pii_bootstrap, op5_warc_convert, op6_ngram_join,
    op7_decontamination, op8_byte_bpe, op9_backoff_lm, op10_quality_rules, op11_substring_dedup, op12_spelling_groups,
    op13_collocations)}
