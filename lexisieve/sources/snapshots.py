"""A folder as a source of changes: snapshots of its files, and what differs.

A snapshot is a manifest table (path, length, modified, hash), one row a file.
Files are read whole, either as they lie in a folder or from shards: Parquet
files of many (path, content, modified) rows, as a corpus of very many small
files should be kept, since a listing then is as long as the shards are many.
The difference of two snapshots is a change log: ADD for new paths, REINDEX for
changed contents, REMOVE for paths that went. A file that is listed but cannot
be read gives a null text, which changes nothing (R14).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.operators.ordinal import dense_ordinal
from lexisieve.schemas import ADD, REINDEX, REMOVE
from lexisieve.session import broadcast_if_small, materialize


def write_shards(files: DataFrame, location: str, shards: int) -> None:
    """Store (path, content BINARY, modified TIMESTAMP) rows in ``shards``
    sets of files, dealt by path."""
    files.select("path", "content", "modified").repartition(shards, F.xxhash64("path")).write.parquet(location)


def read_shards(spark: SparkSession, location: str) -> DataFrame:
    """(path, length, modified, content) of the stored files."""
    return spark.read.parquet(location).select(
        "path", F.octet_length("content").cast("bigint").alias("length"), "modified", "content")


def folder_files(spark: SparkSession, location: str, glob: str | None = None) -> DataFrame:
    """(path, length, modified, content) of the files in a folder tree. The
    listing is kept apart from the contents, so a file that vanishes or breaks
    after it was listed stays, with null content. Spark's scan passes over empty
    files; they come from its file index (R16), without a time."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(location)
    listed = materialize(files.select("path", "length", F.col("modificationTime").alias("modified")), "listing")
    contents = reader.option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true").load(location)
    read = listed.join(contents.select("path", "content"), "path", "left")
    names = [re.sub("^file:/+", "file:/", unquote(n)) for n in files.inputFiles()]
    if len(names) == listed.count():
        return read
    empty = spark.createDataFrame([(n,) for n in names], "path string").join(listed, "path", "left_anti")
    return read.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified"),
                                         F.lit(b"").alias("content")))


def snapshot(files: DataFrame) -> DataFrame:
    """The manifest (path, length, modified, hash) of some files; the hash is
    null for a file that could not be read."""
    return files.select("path", "length", "modified", F.sha2("content", 256).alias("hash"))


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, op) between two manifests: one full outer join of narrow rows. A
    file whose length and hash agree is unchanged, whatever its time says. One
    that cannot be read now is a REINDEX, or an ADD where it is new."""
    old = before.select("path", F.col("length").alias("_old_length"), F.col("hash").alias("_old"), F.lit(True).alias("_was"))
    new = after.select("path", "length", F.col("hash").alias("_new"), F.lit(True).alias("_is"))
    same = F.col("_old").eqNullSafe(F.col("_new")) & F.col("_new").isNotNull() & (F.col("_old_length") == F.col("length"))
    return old.join(new, "path", "full_outer").where(~F.coalesce(same, F.lit(False))).select(
        "path", F.when(F.col("_was").isNull(), F.lit(ADD)).when(F.col("_is").isNull(), F.lit(REMOVE))
        .otherwise(F.lit(REINDEX)).alias("op"))


def folder_changes(before: DataFrame, files: DataFrame, start: int = 1) -> DataFrame:
    """The change log (seq, op, path, text) that leads from a manifest to the
    files as they are, numbered from ``start`` in byte order of paths. Only
    changed files' contents are joined; they are not moved where the changes
    are small by measure. Bytes are decoded as UTF-8."""
    changed = differences(before, snapshot(files))
    numbered = dense_ordinal(changed, ["path"], "seq", start)
    # What is to be read is in ``files``; a removed or nameless file has no text.
    absent = (F.col("op") == REMOVE) | F.col("path").isNull()
    contents = files.select("path", F.col("content").cast("string").alias("text"))
    read = contents.join(broadcast_if_small(numbered.where(~absent)), "path").select("seq", "op", "path", "text")
    return read.unionByName(numbered.where(absent).select("seq", "op", "path", F.lit(None).cast("string").alias("text")))
