"""The stored, searchable index that a stream keeps: segments in levels.

A segment holds changes of the index, (path, word, change): +1 for a posting
that came, -1 for one that went; postings are live where the changes sum to
one. A segment is laid out like stored postings (by word bucket, sorted by
word), so a search prunes every segment to the buckets and row groups of its
words and sums only what it matched. A bucket of its own holds the segment's
document counts by word, which add up over segments in the same way.

``fanout`` segments of a level are merged into one of the next, bucket by
bucket, postings that came and went cancelling out; so a reader meets at most
``fanout - 1`` segments a level, and a posting is rewritten once a level. The
newest manifest row names the live segments; it is written last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisieve.operators.index import BUCKETS_KEY, bucket_of
from lexisieve.schemas import POSTINGS
from lexisieve.session import materialize

FANOUT = 8
_CHANGES = T.StructType([*POSTINGS.fields, T.StructField("change", T.LongType()), T.StructField("segment", T.StringType()),
                         T.StructField("bucket", T.IntegerType())])
TERMS_BUCKET = -1  # holds a segment's document counts, as rows without a path
_VERSIONS = "version bigint, buckets int, segments array<struct<name: string, level: int>>"


def _read(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    root = f"{base.rstrip('/')}/segments"
    return spark.read.schema(_CHANGES).option("basePath", root).parquet(*[f"{root}/segment={n}" for n in names])


def manifest(spark: SparkSession, base: str, before: int | None = None) -> tuple[int, list[tuple[str, int]]] | None:
    """(buckets, [(segment, level)]) of the newest complete version, or of the
    newest one before a batch; None when there is none yet."""
    try:
        rows = spark.read.schema(_VERSIONS).parquet(f"{base.rstrip('/')}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        rows = rows.where(F.col("version") < before)
    last = rows.orderBy(F.desc("version")).first()
    return last and (last["buckets"], [(s["name"], s["level"]) for s in last["segments"]])


def _write_segment(changes: DataFrame, base: str, name: str, buckets: int) -> None:
    """The postings' changes by bucket, their sums by word in a bucket of its own; computed once for both."""
    changes = materialize(changes.select("path", "word", F.col("change").cast("long").alias("change")), "changes")
    terms = changes.groupBy("word").agg(F.sum("change").alias("change")).where("change <> 0") \
        .select(F.lit(None).cast("string").alias("path"), "word", "change", F.lit(TERMS_BUCKET).alias("bucket"))
    changes.withColumn("bucket", bucket_of("word", buckets)).unionByName(terms) \
        .hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "path") \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{base.rstrip('/')}/segments/segment={name}")


def _merged(spark: SparkSession, base: str, names: list[str]) -> DataFrame:
    """The changes of some segments, summed: what came and went is gone."""
    rows = _read(spark, base, names).where(F.col("bucket") > TERMS_BUCKET)
    return rows.groupBy("bucket", "word", "path").agg(F.sum("change").alias("change")).where("change <> 0")


def add_segment(spark: SparkSession, base: str, version: int, changes: DataFrame, buckets: int, fanout: int = FANOUT,
                afresh: bool = False) -> None:
    """Write the changes of a version, merge the levels that are full, and
    list what is live. ``afresh``: the changes are the whole index."""
    known = manifest(spark, base, version)
    live = [] if afresh or known is None else known[1]
    level = max((n for _, n in known[1]), default=0) if afresh and known else 0
    live = [*live, (f"{version}-{level}", level)]
    _write_segment(changes, base, live[-1][0], buckets)
    while sum(n == level for _, n in live) >= fanout:
        full = [s for s, n in live if n == level]
        level += 1
        live = [(s, n) for s, n in live if n != level - 1] + [(f"{version}-{level}", level)]
        _write_segment(_merged(spark, base, full), base, live[-1][0], buckets)
    listed = F.array(*[F.struct(F.lit(s).alias("name"), F.lit(n).alias("level")) for s, n in live])
    spark.range(1).coalesce(1).select(F.lit(version).cast("long").alias("version"), F.lit(buckets).alias("buckets"),
                                      listed.alias("segments")).write.mode("append").parquet(f"{base.rstrip('/')}/versions")


def live_postings(spark: SparkSession, base: str) -> DataFrame:
    """(path, word, bucket) of the newest version, to be searched like stored
    postings: filters on bucket and word reach every segment's scan."""
    known = manifest(spark, base)
    if known is None:
        return spark.createDataFrame([], POSTINGS).withColumn("bucket", F.lit(None).cast("int"))
    buckets, segments = known
    if len(segments) == 1:
        rows = _read(spark, base, [segments[0][0]]).where(F.col("bucket") > TERMS_BUCKET)
    else:
        rows = _merged(spark, base, [s for s, _ in segments])
    return rows.where("change > 0").select("path", F.col("word").alias("word", metadata={BUCKETS_KEY: buckets}), "bucket")


def live_terms(spark: SparkSession, base: str) -> DataFrame:
    """(word, bucket, n_docs) of the newest version, without its postings."""
    known = manifest(spark, base)
    if known is None:
        return spark.createDataFrame([], "word string, n_docs long, bucket int")
    rows = _read(spark, base, [s for s, _ in known[1]]).where(F.col("bucket") == TERMS_BUCKET)
    return rows.groupBy("word").agg(F.sum("change").alias("n_docs")).where("n_docs > 0") \
        .withColumn("bucket", bucket_of("word", known[0]))
