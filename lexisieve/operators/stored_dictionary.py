"""Dictionaries that outlive a job: a stored id <-> value table with its counter.

Every call that changes the dictionary writes one version: the entries that it
adds or the ids that it removes, and last a manifest row with the counter. Ids
are dense from 1 in first-seen order and are never handed out twice (R17); a
removed value that is interned again gets a new id; only ``clear`` restarts the
numbering. Nothing is renumbered or rewritten: a version is as large as what it
changes, and every ``compact_every``-th one writes the live entries whole.

One writer at a time. A version whose manifest row is missing was not finished:
readers pass over it and the next call writes it anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.operators.ordinal import dense_ordinal
from lexisieve.session import broadcast_if_small, is_small, materialize

COMPACT_EVERY = 16
_ENTRIES = "id bigint, value string, live boolean"
_MANIFEST = "version bigint, start bigint, counter bigint"


class StoredDictionary:
    """``StoredDictionary(spark, base)`` opens what ``base`` holds, or starts
    an empty dictionary there."""

    def __init__(self, spark: SparkSession, base: str, compact_every: int = COMPACT_EVERY):
        self.spark, self.base, self.compact_every = spark, base.rstrip("/"), compact_every

    def _state(self) -> tuple[int, int, int]:
        """(version, first version that counts, counter) of the newest one."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.base}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, 1, 0
        return tuple(rows.orderBy(F.desc("version")).first())

    def _rows(self, first: int, last: int) -> DataFrame:
        if last < first:
            return self.spark.createDataFrame([], _ENTRIES)
        return self.spark.read.schema(_ENTRIES).parquet(*[f"{self.base}/entries/{v}" for v in range(first, last + 1)])

    def table(self) -> DataFrame:
        """The live entries (id, value). Removed ids are met only with the ids
        of removals, broadcast where small."""
        version, start, _ = self._state()
        rows = self._rows(start, version)
        gone = rows.where(~F.col("live")).select("id")
        return rows.where("live").select("id", "value").join(broadcast_if_small(gone), "id", "left_anti")

    def counter(self) -> int:
        """The last id handed out."""
        return self._state()[2]

    def _write(self, rows: DataFrame, start: int, version: int, counter: int) -> None:
        rows.select("id", "value", "live").write.mode("overwrite").parquet(f"{self.base}/entries/{version}")
        self.spark.range(1).coalesce(1).select(*[F.lit(x).cast("long").alias(n) for n, x in (
            ("version", version), ("start", start), ("counter", counter))]).write.mode("append").parquet(f"{self.base}/manifest")
        if version - start >= self.compact_every:
            live = materialize(self.table(), "dictionary").withColumn("live", F.lit(True))
            self._write(live, version + 1, version + 1, counter)

    def _known(self, values: DataFrame) -> DataFrame:
        """The entries of some distinct values: the table is filtered for them
        in place where they are few."""
        table = self.table()
        return table.join(F.broadcast(values) if is_small(values) else values, "value", "left_semi")

    def intern(self, values: DataFrame, order: list[str], value: str = "value") -> None:
        """Give every unknown value an id, by its first row in ``order``
        (columns that no two rows share). Nulls are not values."""
        first = values.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")) \
            .agg(F.min(F.struct(*order)).alias("_first"))
        first = materialize(first, "values")
        known = materialize(self._known(first.select("value")), "known-values")
        new = first.join(broadcast_if_small(known.select("value")), "value", "left_anti")
        version, start, counter = self._state()
        new = materialize(dense_ordinal(new, ["_first"], "id", counter + 1).select("id", "value", F.lit(True).alias("live")), "entries")
        added = new.count()
        if added:
            self._write(new, start, version + 1, counter + added)

    def remove(self, values: DataFrame, value: str = "value") -> None:
        """Drop the entries of some values; unknown ones change nothing."""
        known = self._known(materialize(values.select(F.col(value).alias("value")).where("value is not null").distinct(), "values"))
        gone = materialize(known.select("id", "value", F.lit(False).alias("live")), "entries")
        version, start, counter = self._state()
        if gone.limit(1).count():
            self._write(gone, start, version + 1, counter)

    def clear(self) -> None:
        """Forget every entry and number from 1 again."""
        version = self._state()[0]
        self._write(self.spark.createDataFrame([], _ENTRIES), version + 1, version + 1, 0)

    def lookup(self, values: DataFrame, value: str = "value") -> DataFrame:
        """(id, value) of the known ones among some values."""
        return self._known(values.select(F.col(value).alias("value")).distinct())
