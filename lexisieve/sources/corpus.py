"""Corpus and change-log sources: files or table rows to (path, seq, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.schemas import ADD, CLEAR, REINDEX, REMOVE
from lexisieve.session import spread


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_corpus(df: DataFrame, path: Column, seq: Column, text: Column) -> DataFrame:
    """Any table as a corpus. ``seq`` orders the adds (call order)."""
    out = df.select(path.alias("path"), seq.cast("bigint").alias("seq"), text.cast("string").alias("text"))
    return spread(out, "path", "seq")


def document_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``: path = source/doc_id, added in doc_id order."""
    d = read_table(spark, sf_dir, "documents")
    return table_corpus(d, F.concat("source", F.lit("/"), F.col("doc_id").cast("string")),
                        F.col("doc_id"), F.col("text"))


def page_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages``: path = url, raw html as text, added in page_id order."""
    p = read_table(spark, sf_dir, "pages")
    return table_corpus(p, F.col("url"), F.col("page_id"), F.col("html"))


def binary_corpus(spark: SparkSession, location: str, recursive: bool = False,
                  glob: str | None = None, path: Column | None = None,
                  seq: Column | None = None) -> DataFrame:
    """Whole files as documents (one row per file, like a whole-file read).

    Bytes are decoded as UTF-8; invalid bytes turn into U+FFFD and therefore
    separate words, as any non-ASCII byte does. Files that vanish between
    listing and reading are skipped when ``spark.sql.files.ignoreMissingFiles``
    is set. Without ``recursive``, partition-style folders (``key=value``)
    are discovered in parallel and come back as columns usable in ``path`` /
    ``seq`` expressions. Without ``seq``, files are numbered in path order by
    a distributed ordinal over the paths alone (contents are not read for it).
    """
    from lexisieve.operators.ordinal import dense_ordinal

    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(location)
    text = F.col("content").cast("string").alias("text")
    if seq is not None:
        out = files.select((path if path is not None else F.col("path")).alias("path"),
                           seq.cast("bigint").alias("seq"), text)
        return spread(out, "path", "seq")
    numbered = dense_ordinal(files.select("path"), ["path"], "seq")
    out = files.select("path", text).join(numbered, "path")
    if path is not None:
        out = out.withColumn("path", path)
    return out.select("path", "seq", "text")


def conversation_changes(spark: SparkSession, sf_dir: str, mode: str = "mixed") -> DataFrame:
    """Change log derived from ``conversations``.

    mode: ``mixed`` (REMOVE when (conv_id + turn) % 5 = 4, REINDEX for the
    assistant, else ADD), ``add`` / ``reindex`` (every op set to that value),
    ``clear`` (mixed, with the row at the middle ``seq`` turned into CLEAR).
    """
    c = read_table(spark, sf_dir, "conversations")
    seq = (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint")
    mixed = (F.when((F.col("conv_id") + F.col("turn")) % 5 == 4, F.lit(REMOVE))
             .when(F.col("role") == "assistant", F.lit(REINDEX))
             .otherwise(F.lit(ADD)))
    op = {"mixed": mixed, "clear": mixed, "add": F.lit(ADD), "reindex": F.lit(REINDEX)}[mode]
    log = c.select(seq.alias("seq"), op.alias("op"),
                   F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("path"),
                   F.col("text"))
    log = spread(log, "path", "seq")
    if mode == "clear":
        # The middle row: rank ceil(n / 2) by seq (percentile_disc(0.5)),
        # found with a distributed ordinal instead of buffering every seq.
        from lexisieve.operators.ordinal import dense_ordinal

        seqs = c.select(seq.alias("seq"))
        ranked = dense_ordinal(seqs, ["seq"], "_rank")
        middle = ranked.where(F.col("_rank") == (seqs.count() + 1) // 2).agg(F.min("seq")).first()[0]  # one scalar
        log = log.withColumn("op", F.when(F.col("seq") == F.lit(middle), F.lit(CLEAR)).otherwise(F.col("op")))
    return log


def corpus_changes(corpus: DataFrame, op: str = ADD) -> DataFrame:
    """A corpus as a change log of one operation per document."""
    return corpus.select("seq", F.lit(op).alias("op"), "path", "text")
