"""Connected components by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexisieve.session import materialize


def _write(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges written and read back, with their count and a hash sum
    observed on the way."""
    seen = Observation()
    kept = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
    return kept, seen.get


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v): the smallest node
    reachable. Each round points neighbours at the smallest one (large star,
    then small star); rounds grow with the logarithm of the longest path. The
    edges of a round are written once, so lineage stays short; no edge or
    label comes to the driver."""
    now, state = _write(edges.where(F.col("u") != F.col("v"))
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while state["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join reads plain shuffles and AQE can split a node with very many neighbours.
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "smallest")
        large = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        now, after = _write(small)
        if after == state:
            break
        state = after
    stars = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
