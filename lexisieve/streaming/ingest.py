"""Continuous ingest of change rows with Structured Streaming.

The many-producer / one-consumer hand-over becomes a union of streams; the
consumer appends each micro-batch to the change log. The index is a pure
function of the log, so late rows need no watermark: a row is placed by its
``seq``, not by its arrival, and ``apply_changes`` over the log equals the
batch result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexisieve.schemas import CHANGE_LOG, CLEAR
from lexisieve.session import broadcast_if_small, materialize
from lexisieve.streaming.levels import FANOUT, add_segment, live_postings, live_terms, manifest


def merge_producers(*producers: DataFrame) -> DataFrame:
    """Multiset union of several producers (batch or streaming DataFrames)
    with a ``producer`` column (1, 2, ...). Order is only kept per producer,
    through each row's own ``seq``."""
    tagged = [p.withColumn("producer", F.lit(i).cast("bigint")) for i, p in enumerate(producers, start=1)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out


_MARKS = "producer bigint, seq bigint, batch_id bigint"


def _append_once(base: str):
    root = base.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = materialize(batch, "producers")
        try:
            marks = spark.read.schema(_MARKS).parquet(f"{root}/marks").where(F.col("batch_id") < batch_id)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            marks = spark.createDataFrame([], _MARKS)
        marks = materialize(marks.groupBy("producer").agg(F.max("seq").alias("_mark")), "marks")
        new = batch.join(broadcast_if_small(marks), "producer", "left") \
            .where(F.col("_mark").isNull() | (F.col("seq") > F.col("_mark"))).drop("_mark").dropDuplicates(["producer", "seq"])
        new.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")
        marks = batch.groupBy("producer").agg(F.max("seq").alias("seq"))
        marks.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch_id={batch_id}")
    return write


def stream_merge(merged: DataFrame, base: str, checkpoint_location: str) -> StreamingQuery:
    """Take in merged producers (``producer``, ``seq`` and more columns) so
    that each row is there once, even where a producer starts anew and sends
    rows again. A producer's rows come in the order of its ``seq`` (not null,
    unique), as from a queue: its mark, the largest seq seen in finished
    batches, tells what is new. State is a row per producer and batch, not per
    row; batches overwrite their own folders on a retry."""
    return (merged.writeStream.foreachBatch(_append_once(base))
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())


def read_merged(spark: SparkSession, base: str) -> DataFrame:
    """The rows that ``stream_merge`` has taken in."""
    return spark.read.parquet(f"{base.rstrip('/')}/rows").drop("batch_id")


def stream_changes(spark: SparkSession, location: str, schema=CHANGE_LOG, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of change rows (one folder, or a glob)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(location)


# Path buckets of the stored log; CLEAR rows, which cut every history whatever
# their path, and rows without a path go to -1.
LOG_BUCKETS = 64
# Word buckets of a streamed index, unless told: every batch writes to each.
STREAM_BUCKETS = 16
STORED_LOG = T.StructType([*CHANGE_LOG.fields, T.StructField("pbucket", T.IntegerType())])


def _path_bucket(buckets: int = LOG_BUCKETS):
    return F.when((F.col("op") == CLEAR) | F.col("path").isNull(), F.lit(-1)) \
        .otherwise(F.pmod(F.xxhash64("path"), F.lit(buckets))).cast("int")


def _write_batch(batch: DataFrame, log_dir: str, batch_id: int) -> str:
    """One folder per micro-batch, overwritten on retry (a replayed batch id
    leaves exactly one copy), partitioned by path bucket so that the history
    of a few paths, or the CLEAR rows, can be read without the whole log."""
    here = f"{log_dir.rstrip('/')}/batch_id={batch_id}"
    rows = batch.select("seq", "op", "path", "text").withColumn("pbucket", F.coalesce(_path_bucket(), F.lit(-1)))
    (rows
     .write.mode("overwrite").partitionBy("pbucket").parquet(here))
    return here


def _append_batch(log_dir: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, log_dir, batch_id)
    return write


def stream_ingest(changes: DataFrame, log_dir: str, checkpoint_location: str,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append a stream of change rows to the log under ``log_dir``.

    ``checkpoint_location`` must be on shared storage; the query resumes
    from it after a restart and re-runs unfinished batches idempotently.
    """
    writer = (changes.select("seq", "op", "path", "text").writeStream
              .foreachBatch(_append_batch(log_dir))
              .option("checkpointLocation", checkpoint_location))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_log(spark: SparkSession, log_dir: str, with_buckets: bool = False) -> DataFrame:
    """The change log written by ``stream_ingest`` / ``stream_index`` (all
    batches so far); ``with_buckets`` keeps the partition columns ``pbucket``
    and ``batch_id``. An empty log has no rows."""
    schema = T.StructType([*STORED_LOG.fields, T.StructField("batch_id", T.LongType())])
    log = spark.read.schema(schema).parquet(log_dir)
    cols = ["seq", "op", "path", "text"] + (["pbucket", "batch_id"] if with_buckets else [])
    return log.select(*cols)


def _index_batch(base: str, fanout: int, buckets: int):
    from lexisieve.operators.changes import apply_changes

    log_dir = f"{base.rstrip('/')}/log"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = _write_batch(batch, log_dir, batch_id)
        rows = spark.read.schema(STORED_LOG).parquet(here)  # read back: the batch is not recomputed
        known = manifest(spark, base, batch_id)
        log = read_log(spark, log_dir, with_buckets=True)
        clears = rows.where(F.col("op") == CLEAR).limit(1).count() > 0
        if known is None or clears:
            # The first batch, or a CLEAR, which reaches every path.
            changes = apply_changes(log).withColumn("change", F.lit(1))
        else:
            # Only the touched paths change; their history is applied with (+)
            # and without (-) the batch, as two paths each, so a late row lands
            # by its seq, and the difference is what changes. The semi join on (pbucket, path)
            # prunes log partitions to the touched buckets; CLEAR rows
            # (bucket -1) are kept, as they cut every history.
            touched = rows.where(F.col("path").isNotNull()).select("pbucket", "path").distinct()
            history = log.join(touched, ["pbucket", "path"], "left_semi") \
                .unionByName(log.where((F.col("pbucket") == -1) & (F.col("op") == CLEAR)))
            tag = F.when(F.col("batch_id") < batch_id, F.array(F.lit("-"), F.lit("+"))).otherwise(F.array(F.lit("+")))
            both = history.select("seq", "op", "path", "text", F.explode(tag).alias("tag")) \
                .select("seq", "op", F.concat("tag", "path").alias("path"), "text")
            change = F.when(F.col("path").startswith("+"), F.lit(1)).otherwise(F.lit(-1))
            changes = apply_changes(both).groupBy(F.substring("path", 2, 1 << 30).alias("path"), "word") \
                .agg(F.sum(change).alias("change")).where("change <> 0")
        add_segment(spark, base, batch_id, changes, known[0] if known else buckets, fanout, afresh=known is None or clears)

    return apply


def stream_index(changes: DataFrame, base: str, checkpoint_location: str, compact_every: int = FANOUT,
                 buckets: int = STREAM_BUCKETS, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Keep the live, searchable postings current while change rows stream in.

    Every micro-batch appends its rows to ``base/log`` and writes one segment:
    the postings that its rows make come or go, in the bucketed layout of
    stored postings (see ``levels``). What a batch writes follows the batch,
    not the index; ``compact_every`` segments of a level are merged into one
    of the next. A CLEAR writes the index afresh. Folders are per batch id and
    overwritten on a retry, so replays are idempotent.
    """
    writer = (changes.select("seq", "op", "path", "text").writeStream
              .foreachBatch(_index_batch(base, compact_every, buckets))
              .option("checkpointLocation", checkpoint_location))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_postings(spark: SparkSession, base: str) -> DataFrame:
    """(path, word, bucket): the newest complete version written by
    ``stream_index`` (no rows before the first batch)."""
    return live_postings(spark, base)


def latest_terms(spark: SparkSession, base: str) -> DataFrame:
    """(word, bucket, n_docs) of the same version."""
    return live_terms(spark, base)


_OUTCOMES = "seq bigint, op string, path string, outcome boolean, batch_id bigint"


def _outcome_batch(base: str):
    from lexisieve.operators.changes import change_outcomes

    root = base.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = _write_batch(batch, f"{root}/log", batch_id)
        rows = spark.read.schema(STORED_LOG).parquet(here)
        log = read_log(spark, f"{root}/log", with_buckets=True)
        log = log.where(F.col("batch_id") <= batch_id)
        if not rows.where(F.col("op") == CLEAR).limit(1).count():
            # Outcomes depend on the path's own rows and on the CLEAR rows, so
            # only touched paths can have new ones; a CLEAR reaches every path.
            touched = rows.select("pbucket", "path").where("path is not null").distinct()
            log = log.join(touched, ["pbucket", "path"], "left_semi").unionByName(log.where(
                (F.col("pbucket") == -1) & ((F.col("op") == CLEAR) | (F.col("batch_id") == batch_id))))
        log = materialize(log, "history")
        now, then = change_outcomes(log), change_outcomes(log.where(F.col("batch_id") < batch_id))
        now.subtract(then).select("seq", "op", "path", "outcome") \
            .write.mode("overwrite").parquet(f"{root}/outcomes/batch_id={batch_id}")
    return apply


def stream_outcomes(changes: DataFrame, base: str, checkpoint_location: str) -> StreamingQuery:
    """Say for every change row of a stream what its call would have returned
    (see ``change_outcomes``). A batch writes the outcomes of its own rows, and
    again those of earlier rows that its late rows or its CLEAR have changed;
    the newest one of a ``seq`` counts. Batches overwrite their own folders on
    a retry."""
    return (changes.select("seq", "op", "path", "text").writeStream.foreachBatch(_outcome_batch(base))
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())


def emitted_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """Every outcome written, (seq, op, path, outcome, batch_id)."""
    return spark.read.schema(_OUTCOMES).parquet(f"{base.rstrip('/')}/outcomes")


def latest_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """(seq, op, path, outcome) as the newest batch has them."""
    rows = emitted_outcomes(spark, base)
    newest = rows.groupBy("seq").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, ["seq", "batch_id"]).select("seq", "op", "path", "outcome")
