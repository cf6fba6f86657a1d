"""Distributed dense numbering and prefix counts, without a one-task sort.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Here the
rows are range-partitioned by the (unique) order key, which balances the
partitions whatever the key skew, then numbered inside each partition; a
table with one row per partition (bounded by the partition count) supplies
the offsets. The sorted, tagged rows are written once to the shared
checkpoint folder, so the partition assignment is fixed before it is
counted, and a lost executor re-reads the same numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexisieve.session import materialize

_MID, _PID, _LOCAL = "_mid", "_pid", "_local"
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | row index


def _tagged(df: DataFrame, order_cols: list[str]) -> DataFrame:
    tagged = df.orderBy(*order_cols).withColumn(_MID, F.monotonically_increasing_id())
    tagged = materialize(tagged, "ordinal")
    return (tagged.withColumn(_PID, F.shiftrightunsigned(F.col(_MID), 33))
            .withColumn(_LOCAL, F.col(_MID).bitwiseAND(F.lit(_LOW_BITS))))


def _partition_offsets(tagged: DataFrame, weight) -> DataFrame:
    """Sum of ``weight`` over all earlier partitions, one row per partition."""
    sizes = tagged.groupBy(_PID).agg(F.sum(weight).cast("bigint").alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_off"))


def dense_ordinal(df: DataFrame, order_cols: list[str], id_col: str, start: int = 1) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in the order of ``order_cols``.

    The order key must be unique for the ids to be deterministic.
    """
    tagged = _tagged(df, order_cols)
    offsets = _partition_offsets(tagged, F.lit(1))
    out = tagged.join(F.broadcast(offsets), _PID)  # one row per partition: bounded
    return out.withColumn(id_col, (F.col("_off") + F.col(_LOCAL) + F.lit(start)).cast("bigint")) \
        .drop(_MID, _PID, _LOCAL, "_off")


def prefix_count(df: DataFrame, order_cols: list[str], flag: str, out_col: str) -> DataFrame:
    """``out_col`` = number of rows before this one (by ``order_cols``) whose
    ``flag`` is true. Window work stays inside balanced range partitions."""
    tagged = _tagged(df, order_cols)
    weight = F.col(flag).cast("bigint")
    offsets = _partition_offsets(tagged, weight)
    inside = Window.partitionBy(_PID).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, -1)
    out = tagged.join(F.broadcast(offsets), _PID)
    return out.withColumn(out_col, (F.col("_off") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).cast("bigint")) \
        .drop(_MID, _PID, _LOCAL, "_off")
