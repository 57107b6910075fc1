"""Connected components of an edge table by alternating large-star and small-star steps, each a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Rounds after which we give up; the number needed grows with the logarithm of the longest path.
MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b): node and root, the smallest node of its component; nodes without an edge to another are absent.

    Nulls are no nodes; repeated and self edges add nothing. Each round is written to the shared folder, so nothing is
    computed twice and nothing goes through the driver. A node's neighbours are never gathered: their least is an
    aggregate, and it comes back by a join whose hot keys adaptive execution splits.
    """
    spark = edges.sparkSession
    now, path = materialise(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        after, after_path = materialise(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        discard(spark, path)
        before, now, path, state = state, after, after_path, _state(after)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
