"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.plans.materialize import release, stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the least node it reaches.

    Each round is stored, so lineage stays short; rounds grow with the logarithm of the longest
    chain. Nulls and self-links are ignored; no edges give no rows.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    now = stored(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _digest(now)
    while seen[0]:
        before, now = now, stored(_small_star(_large_star(now)), "stars")
        release(before)
        if (found := _digest(now)) == seen:
            break
        seen = found
    roots = now.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias("v"))
    return now.union(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
