"""Request tables: one search command line per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.sources.corpus import read_table


def benchmark_commands(items: DataFrame) -> DataFrame:
    """``items`` with a column ``cmd`` by ``item_id % 4``."""
    return items.withColumn("cmd", F.when(F.col("item_id") % 4 == 0, F.lit("SEARCH_ONE"))
                            .when(F.col("item_id") % 4 == 1, F.lit("SEARCH_ALL"))
                            .when(F.col("item_id") % 4 == 2, F.lit("SEARCH_ANY"))
                            .otherwise(F.lit("FIND")))


def benchmark_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` passages as request lines.

    The command comes from ``item_id % 4`` (SEARCH_ONE, SEARCH_ALL, SEARCH_ANY,
    and the unknown command FIND); the words are the whole passage with every
    run of non-alphanumeric characters turned into one space.
    """
    b = benchmark_commands(read_table(spark, sf_dir, "benchmark"))
    words = F.regexp_replace(F.col("text"), "[^A-Za-z0-9]+", " ")
    return b.select(F.col("item_id").cast("bigint").alias("req_id"),
                    F.concat("cmd", F.lit(" "), words).alias("request"))


def passage_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` passages as they are, punctuation and all, behind the same
    commands; where ``item_id % 8`` is 0 or 1 the command stands alone, which
    gives both errors of missing words."""
    b = benchmark_commands(read_table(spark, sf_dir, "benchmark"))
    words = F.when(F.col("item_id") % 8 < 2, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("text")))
    return b.select(F.col("item_id").cast("bigint").alias("req_id"), F.concat("cmd", words).alias("request"))
